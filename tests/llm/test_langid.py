import numpy as np
from pyspark.sql import functions as F

from tallyhour.llm import langid
from tallyhour.llm.common import fold

EN = ["the quick brown fox and the lazy dog", "this is what they have in the house", "with that and those of them there"]
DE = ["der schnelle braune fuchs und der faule hund", "das ist was sie haben in dem haus", "mit dem und den von ihnen über"]


def corpus(docs_of, n=200):
    return docs_of([(i, " ".join((EN if i % 2 else DE)[(i + j) % 3] for j in range(4)), "en" if i % 2 else "de")
                    for i in range(n)])


def test_windows_fold_case_and_signs():
    a, b = langid.windows("The  dog!!"), langid.windows("the... DOG")
    assert np.array_equal(a, b)
    assert len(langid.windows("")) == 0
    assert len(langid.windows("x")) == 1


def test_filters_hold_all_members_and_correct_for_false_positives():
    rng = np.random.default_rng(0)
    members = [np.unique(rng.integers(0, 1 << 32, 3000, dtype=np.uint32)) for _ in range(10)]
    f = langid.build_filters([f"l{i}" for i in range(10)], 0, members)
    assert f.slots.shape[1] == 2
    for l, m in enumerate(members):
        assert ((f.masks(m)[:, l // 8] >> (l % 8)) & 1).all()
    other = rng.integers(0, 1 << 32, 200_000, dtype=np.uint32)
    rate = ((f.masks(other)[:, 1] >> 1) & 1).mean()  # language 9
    assert abs(rate - f.fp[9]) < 0.01 + 0.3 * f.fp[9]


def test_predictions_and_edge_cases(docs_of):
    docs = corpus(docs_of)
    f = langid.fit(docs)
    assert f.langs == ["de", "en"]
    got = langid.predict(docs, f).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("lang <> lang_pred").count() == 0
    assert got.where("held_out").count() == docs.where(fold("doc_id", 4) == 2).count()
    odd = docs_of([(1, None), (2, ""), (3, "12345 !?"), (4, "x"), (5, "the " * 50_000), (None, EN[0]), (6, EN[1]), (6, EN[1])])
    by = {(r["doc_id"], r["lang_pred"], r["held_out"]) for r in langid.predict(odd, f).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (5, "en"), (None, "en"), (6, "en")} <= {b[:2] for b in by}
    assert not [b for b in by if b[0] is None and b[2]]
    assert all(0 <= r["score"] <= 1 for r in langid.predict(odd, f).collect())
    kept = langid.keep_identified(odd, f, 0.15)
    assert kept.columns == odd.columns and {5, 6, None} <= {r["doc_id"] for r in kept.collect()}
    assert not {1, 2, 3} & {r["doc_id"] for r in kept.collect()}


def test_nothing_to_learn_from(docs_of):
    docs = corpus(docs_of)
    for empty in (docs.where(F.lit(False)), docs.withColumn("lang", F.lit(None).cast("string"))):
        f = langid.fit(empty)
        assert f.langs == [] and {r["lang_pred"] for r in langid.predict(docs, f).collect()} == {"und"}


def test_held_out_rows_and_other_columns_are_not_learned_from(docs_of):
    docs = corpus(docs_of)
    changed = docs.withColumn("lang", F.when(fold("doc_id", 4) == 2, F.lit("xx")).otherwise(F.col("lang")))
    a, b = langid.fit(docs), langid.fit(changed)
    assert a.langs == b.langs and np.array_equal(a.slots, b.slots)


def test_query_is_right_on_held_out_rows(spark, sf_small):
    from tallyhour.llm.entry_queries import op7_language_filters
    got = op7_language_filters(spark, sf_small).where("held_out").join(
        spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.where("lang = lang_pred").count() >= 0.95 * got.count()


def plain_reference(rows, sample_docs):
    """The whole fit and prediction by plain loops over sets: (prediction, score) by row."""
    import regex
    import xxhash  # noqa: F401  (hashes of the sample come from Spark, below)
    letter, learned = regex.compile(r"\p{L}"), {}
    for _, text, lang in rows["sample"]:
        learned.setdefault(lang, []).append(text or "")

    def grams(text):
        out = bytearray()
        for c in (" " + (text if text.isascii() else text.lower()) + " ").encode():
            c = c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32
            if c != 32 or not out or out[-1] != 32:
                out.append(c)
        out.append(32)
        return [bytes(out[i:i + 4]) for i in range(len(out) - 3)]
    langs = sorted(rows["counts"])
    rates = {}
    for lang in langs:
        seen = {}
        for text in learned.get(lang, []):
            for g in grams(text):
                seen[g] = seen.get(g, 0) + 1
        total = sum(seen.values())
        rates[lang] = {g: n / total for g, n in seen.items() if n / total >= langid.MIN_RATE}
    top = {}
    for r in rates.values():
        for g, x in r.items():
            top[g] = max(top.get(g, 0), x)
    members = {l: {g for g, x in r.items() if x >= langid.MIN_RELATIVE * top[g]} for l, r in rates.items()}
    bits = max(10, int(np.ceil(np.log2(max(1, max(map(len, members.values()), default=1)) * 10))))
    place = lambda g, h: (int.from_bytes(g, "little") * h & 0xFFFFFFFF) >> 32 - bits
    slots = {l: {place(g, h) for g in m for h in langid.HASHES} for l, m in members.items()}
    fp = {l: min(0.999, (len(s) / 2 ** bits) ** len(langid.HASHES)) for l, s in slots.items()}
    prior = max(langs, key=lambda l: (rows["counts"][l], [-ord(c) for c in l])) if langs else None
    out = []
    for text in rows["texts"]:
        if not text or not langs or not letter.search(text):
            out.append(("und", 0.0))
            continue
        gs = grams(text)
        c = {}
        for l in langs:
            hits = sum(all(place(g, h) in slots[l] for h in langid.HASHES) for g in gs)
            c[l] = max(hits - len(gs) * fp[l], 0) / (1 - fp[l])
        best = max(langs, key=lambda l: (c[l], [-ord(x) for x in l]))
        if c[best] <= 0:
            out.append((prior, 0.0))
            continue
        rest = max((c[l] for l in langs if l != best), default=0.0)
        out.append((best, c[best] / (c[best] + rest)))
    return out


def test_query_equals_plain_reference(spark, sf_small):
    """Fit and prediction of the registered query, row by row, against loops over sets of windows."""
    from tallyhour.llm.entry_queries import op7_language_filters
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "lang")
    known = docs.where((fold("doc_id", 4) != 2) & F.col("lang").isNotNull())
    rows = docs.orderBy("doc_id").collect()
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    assert known.count() < langid.SAMPLE_DOCS  # all are learned from
    sample = [tuple(r) for r in known.dropDuplicates(["doc_id", "text"]).collect()]
    want = plain_reference({"sample": sample, "counts": counts, "texts": [r["text"] for r in rows]}, langid.SAMPLE_DOCS)
    got = {r["doc_id"]: r for r in op7_language_filters(spark, sf_small).collect()}
    for r, (lang, score) in zip(rows, want):
        assert got[r["doc_id"]]["lang_pred"] == lang and abs(got[r["doc_id"]]["score"] - score) < 1e-9


def test_numerals_are_no_letters(docs_of):
    f = langid.fit(corpus(docs_of))
    for text in ("½", "²", "①", "Ⅷ", "5 ½ ②", "٣", "_"):
        assert f.predict(text)[0] == "und"
    for text in ("x", "é", "ª", "日", "ʰ"):
        assert f.predict(text)[0] != "und"


def test_sample_takes_the_least_hashes_and_copies_once(spark, docs_of):
    rows = [(i, f"text {i}", "en") for i in range(500)] + [(7, "copy", "en")] * 3000 + [(i, f"t {i}", "de") for i in range(20)]
    known = docs_of(rows).select("doc_id", "text", "lang")
    h = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1)
    for k in (5, 100, 5000):
        got = sorted(map(tuple, langid.pick(known, {"en": 3500, "de": 20}, k).collect()))
        want = []
        for lang in ("en", "de"):
            want += [(r["text"], lang) for r in known.where(F.col("lang") == lang).withColumn("h", h).distinct().orderBy("h").limit(k).collect()]
        assert got == sorted(want)
