import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhour.llm import spelling_groups as sg
from tallyhour.llm.entry_queries import op13_spelling_groups

LETTERS = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | {chr(c) for c in range(0xC0, 0x100)}


def brute_words(rows, min_length=5, min_count=3):
    """Character by character, every occurrence on its own."""
    count = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c in LETTERS:
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
            elif run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode()) & 0xFFFFFFFF
                if h % 97 == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                count[run] += 1
                run = ""
    return {w: n for w, n in count.items() if len(w) >= min_length and n >= min_count}


def brute_near(words):
    """Words with one position starred, or one deleted, that agree."""
    near = defaultdict(set)
    shapes = defaultdict(list)
    for w in words:
        for i in range(len(w)):
            shapes[w[:i] + "*" + w[i + 1:]].append(w)
            if w[:i] + w[i + 1:] in words:
                near[w].add(w[:i] + w[i + 1:])
                near[w[:i] + w[i + 1:]].add(w)
    for group in shapes.values():
        for a in group:
            near[a] |= {b for b in group if b != a}
    return near


def brute_groups(words):
    near, form = brute_near(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def got(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_query_equals_brute_force(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    df = op13_spelling_groups(spark, sf_small)
    want = brute_groups(brute_words(rows))
    assert got(df) == want and df.count() == len(want) > 1000
    assert any(f and r != f for _, f, r, *_ in want), "the table has chains of forms"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abé", min_size=5, max_size=7), min_size=2, max_size=60, unique=True))
def test_blocks_find_all_pairs_one_edit_apart(words):
    near = brute_near(set(words))
    by = defaultdict(list)
    for w in words:
        by[len(w)].append(w)
    matrix = {k: np.frombuffer("".join(v).encode("latin-1"), np.uint8).reshape(-1, k) for k, v in by.items()}
    found = set()
    for k in by:
        i, j = sg.compare(matrix[k], matrix[k], True)
        found |= {frozenset((by[k][x], by[k][y])) for x, y in zip(i, j)}
        if k + 1 in by:
            i, j = sg.compare(matrix[k], matrix[k + 1], False)
            found |= {frozenset((by[k][x], by[k + 1][y])) for x, y in zip(i, j)}
    assert found == {frozenset((a, b)) for a in words for b in near[a]}


def test_hot_blocks_are_split_and_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(sg, "BLOCK_WORDS", 7)
    rng = np.random.default_rng(3)
    words = {"".join(rng.choice(list("edlvz"), 6)): int(n) for n in rng.integers(3, 500, 400)}
    words |= {w + "x": 5 for w in list(words)[:100]} | {"q" * 2000: 9, "q" * 1999: 3, "q" * 1999 + "a": 30}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    _, several = sg.blocks(df)
    assert several.agg(F.max("parts")).first()[0] > 3
    assert got(sg.group_variants(df)) == brute_groups(words)
    pairs = [frozenset((r["a"], r["b"])) for r in sg.near_pairs(df).collect()]
    assert len(pairs) == len(set(pairs))


def test_long_chains_ties_and_repeats(spark):
    chain = {"aaaaa" + "b" * i: 3 * 2 ** i for i in range(40)}  # each the form of the one before
    tie = {"xyzzya": 4, "xyzzyc": 10, "xyzzyb": 10}
    words = chain | tie
    out = {r["word"]: r for r in sg.group_variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert out["aaaaa"]["root"] == "aaaaa" + "b" * 39 and out["xyzzya"]["form"] == "xyzzyb"
    assert {tuple(r) for r in out.values()} == brute_groups(words)


def test_edge_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "Straße straße STRAßE"), (None, "hello Hello hello"), (5, "word1word2 " * 3),
            (6, "hello"), (6, "hello"), (7, "abcdefgh" * 30000 + " " + "× ÷ ÀÉÿ " * 3), (8, "hallo hällo " * 4)]
    words = brute_words(rows)
    assert {tuple(r) for r in sg.count_words(docs_of(rows)).collect()} == set(words.items())
    assert got(sg.group_variants(sg.count_words(docs_of(rows)))) == brute_groups(words)
    assert sg.group_variants(sg.count_words(docs_of([]))).count() == 0
