import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyhour.llm import token_alignment as ta
from tallyhour.llm.entry_queries import op12_token_alignment, vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
TEXTS = ["", "a", " ", "  two  spaces ", "x<|endoftext|>y", "don't I'll", "é ñandú 日本語 😀 한국어", "A" * 3000, "tab\there\nline\n\n",
         "the cat sat on the mat", "½ ﬁ ligature", "<s> </s> <unk> <0x41>", "▁ already", "nul \x00 x", "words " * 500]


def byte_table():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {}, 256
    for b in range(256):
        if b in plain:
            table[chr(b)] = b
        else:
            table[chr(extra)] = b
            extra += 1
    return table


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), byte_table()


def spans(text, tools):
    """[(id, begin, end)] of A and of B, one token after the other; none where bytes differ."""
    a, b, table = tools
    if not text:
        return [], []
    out, joined = [], []
    for kind in "ab":
        rows, whole = [], b""
        if kind == "a":
            e = a.encode(" " + text, add_special_tokens=False)
            pieces = [(i, bytes(table[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
        else:
            pieces = []
            for i in b.encode(text):
                p = b.id_to_piece(i)
                pieces.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        for i, x in pieces:
            rows.append((i, len(whole), len(whole) + len(x)))
            whole += x
        out.append(rows)
        joined.append(whole)
    return out if joined[0] == joined[1] == (" " + text).encode() else ([], [])


def brute(rows, tools):
    docs = [(d, *spans(t, tools)) for d, t in rows]
    linked = [[(x[0], y[0]) for x in a for y in b if x[2] == y[2]] for _, a, b in docs]
    count = Counter(p for link in linked for p in link)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for (d, a, b), link in zip(docs, linked):
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, before = [], 0
        for c in cuts:
            groups.append(",".join(str(x[0]) for x in a if before < x[2] <= c) + "|"
                          + ",".join(str(y[0]) for y in b if before < y[2] <= c))
            before = c
        out.append((d, len(a), len(b), len(cuts), len(link), sum(count[p] == best[p[1]] for p in link),
                    sum(count[p] for p in link), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_query_equals_brute_force(spark, sf_small, tools):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    rows = [(d, t) for d, t in rows if len(t or "") < 3000]  # the plain loops are quadratic
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(rows) > 120
    assert got(ta.align(df, A, B)) == brute(rows, tools)


def test_query_covers_the_table(spark, sf_small):
    df = op12_token_alignment(spark, sf_small)
    rows = df.collect()
    assert len(rows) == spark.read.parquet(f"{sf_small}/documents.parquet").count()
    assert all(r["n_links"] == r["n_groups"] <= min(r["n_a"], r["n_b"]) and r["n_shared"] >= r["n_links"] for r in rows)


def test_edge_rows(spark, docs_of, tools, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (3, None), (4, "twice"), (4, "twice")]
    assert got(ta.align(docs_of(rows), A, B)) == brute(rows, tools)
    monkeypatch.setattr(ta, "SLICE_BYTES", 40)
    monkeypatch.setattr(ta, "ENCODE_CHARS", 30)
    assert got(ta.align(docs_of(rows), A, B)) == brute(rows, tools)
    assert ta.align(docs_of([]), A, B).count() == 0
    assert got(ta.align(docs_of([(1, None)]), A, B)) == [(1, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("kind", ["overlap", "group", "end"])
def test_links_equal_plain_loops(spark, docs_of, tools, kind):
    rows = list(enumerate(TEXTS[:-1]))
    want = []
    for d, t in rows:
        if t == "A" * 3000:
            t = "A" * 3000
        a, b = spans(t, tools)
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        for i, (x, p, q) in enumerate(a):
            for j, (y, r, s) in enumerate(b):
                w = max(0, min(q, s) - max(p, r)) if kind == "overlap" else int(q == s) if kind == "end" else \
                    int(sum(c < q for c in cuts) == sum(c < s for c in cuts))
                if w:
                    want.append((d, i, j, x, y, w))
    assert sorted(tuple(r) for r in ta.links(docs_of(rows), A, B, kind).collect()) == sorted(want)


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(1, 400))
def test_product_of_any_sparse_matrices(seed, flops):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 4, (7, 9)) * (rng.random((7, 9)) < .3)
    y = rng.integers(0, 4, (9, 5)) * (rng.random((9, 5)) < .4)

    def rows(m):
        r, c = np.nonzero(m)
        return ta.Rows(np.concatenate([[0], np.cumsum(np.bincount(r, minlength=len(m)))]), c, m[r, c], m.shape[1])
    before = ta.FLOPS
    ta.FLOPS = flops
    try:
        out = np.zeros((7, 5), np.int64)
        for r, c, v in ta.product(rows(x), rows(y)):
            assert not out[r, c].any()
            out[r, c] = v
        t = ta.transpose(rows(x))
    finally:
        ta.FLOPS = before
    assert (out == x @ y).all() and len(t.start) == 10
    assert (ta.work(rows(x), rows(y)) == ((x > 0).astype(int) @ (y > 0).sum(1))).all()
