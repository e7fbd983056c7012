import hashlib
import re

from pyspark.sql import functions as F

from tallyhour.llm import phrase_index

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items, size=10):
    wins = {}
    for item, t in items:
        w = words(t)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add(item)
    lengths = {len(w) for w in wins}
    out = []
    for d, t in rows:
        w = words(t)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wins:
                    hit |= set(range(i, i + n))
                    found |= wins[tuple(w[i:i + n])]
        names = sorted(str(x) for x in found)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=str)


P = "the quick brown fox jumps over the lazy dog again and again until dusk falls on the hill"
ROWS = [(1, None), (2, ""), (3, P), (4, "Start. " + P.upper() + "! End"), (5, "the quick brown fox jumps over the lazy dog"),
        (6, "short one"), (7, "x short one y short, one"), (7, "x short one y short, one"), (8, ("the " * 5000) + P + " the" * 5000),
        (None, P), (9, "the quick brown fox leaps jumps over the lazy dog again and again"), (10, "été naïve ÀB")]
ITEMS = [(10, P), (2, "Short one"), (3, None), (4, ""), (5, "!!"), (11, P), (2, "the the the"), (6, "été naïve"),
         (7, "fox jumps over the lazy dog again and again until dusk")]


def test_matches_brute_force(spark, docs_of, monkeypatch):
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, doc_id string")
    for words_per_shard, block in ((1_000_000, 8 << 20), (20, 8 << 20), (30, 60)):
        monkeypatch.setattr(phrase_index, "BLOCK_BYTES", block)
        docs = docs_of(ROWS).coalesce(2)
        assert got(phrase_index.contamination(docs, items)) == brute(ROWS, ITEMS), (words_per_shard, block)


def test_small_shards_in_process():
    import pyarrow as pa
    terms, numbers = phrase_index._Numbering(), []
    for _, t in ROWS:
        numbers.append([terms[w] for w in phrase_index.words(t)])
    b = phrase_index._shard(pa.array([r[0] for r in ROWS], pa.int64()), numbers, terms)
    s = phrase_index.Shard(*(b.column(c)[0].as_py() for c in range(1, 5)))
    w = phrase_index.Windows([("p", "quick fox")])
    assert not len(s.matches(w, 0)[0])
    near = s.matches(w, 1)
    assert len(near[0]) and all(numbers[d] for d in near[2])


def test_proximity_finds_displaced_words(spark, docs_of):
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = docs_of([(1, "alpha beta gamma delta"), (2, "alpha then beta gamma delta"), (3, "alpha x x x x x beta gamma delta"),
                    (4, "delta")])
    r = {x["doc_id"]: (x["n_items"], x["n_near_items"]) for x in phrase_index.contamination(docs, items, slop=1).collect()}
    assert r == {1: (1, 1), 2: (0, 1), 3: (0, 0), 4: (0, 0)}


def test_empty_tables_and_filter(spark, docs_of):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs_of(ROWS)
    assert phrase_index.contamination(docs.where(F.lit(False)), items).count() == 0
    none = phrase_index.contamination(docs, items.where(F.lit(False)))
    assert none.count() == len(ROWS) and none.where("contaminated").count() == 0
    kept = phrase_index.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    bad = {b[0] for b in brute(ROWS, ITEMS) if b[5]}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d) for d, _ in ROWS if d not in bad)


def test_query_matches_brute_force_on_the_table(spark, sf_small):
    from tallyhour.llm.entry_queries import op9_phrase_index
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    assert got(op9_phrase_index(spark, sf_small)) == brute(docs, items)
