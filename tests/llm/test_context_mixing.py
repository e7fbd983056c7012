import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhour.llm import context_mixing as cm


def words(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    for s in "\t\n\x0b\x0c\r":
        t = t.replace(s, " ")
    return [x.encode() for x in t.split(" ") if x]


def base(rows):
    """doc_id -> (n_tokens, n_known, N, base score)."""
    learns = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 != 1
    c = Counter()
    for d, t in rows:
        if learns(d):
            c.update(words(t) + [None])
    n, v = sum(c.values()), len(c)
    out = []
    for d, t in rows:
        tok = words(t) + [None]
        out.append((d, d is not None and not learns(d), len(tok), sum(c[x] > 0 for x in tok), n,
                    sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tok)))
    return out


def test_windows_and_streams():
    w, ends = cm.windows([b"ab\n", b"\n", b"c \n"])
    assert ends.tolist() == [3, 4, 7] and len(w) == 7
    assert (w & np.uint64(255)).tolist() == list(b"ab\n\nc \n")
    alone = np.concatenate([cm.windows([s])[0] for s in (b"ab\n", b"\n", b"c \n")])
    assert np.array_equal(w, alone)
    assert cm.tokens(" A\x0bbÉ\x1c ") == [b"a", "bÉ\x1c".encode()] and cm.stream([]) == b"\n"


def test_costs_are_a_distribution():
    rng = np.random.default_rng(0)
    size = int(cm._BASE[-1])
    m = cm.Mixer.fresh(rng.integers(0, 5, size).astype(np.float32), rng.integers(0, 5, size).astype(np.float32))
    m.by_known += rng.normal(size=m.by_known.shape) * 0.2
    m.refine += rng.normal(size=m.refine.shape) * 0.2
    past = np.uint64(int.from_bytes(b"hello", "big")) << np.uint64(8)
    total = (10 ** m.costs(past | np.arange(256, dtype=np.uint64))).sum()
    assert total == pytest.approx(1)


def test_scorer_memory_changes_nothing():
    rng = np.random.default_rng(1)
    size = int(cm._BASE[-1])
    m = cm.Mixer.fresh(rng.integers(0, 5, size).astype(np.float32), rng.integers(0, 5, size).astype(np.float32))
    s = cm.Scorer(m)
    streams = [b"the cat \n", b"\n", b"the dog \n"]
    first, again = s.score(streams), s.score(streams)
    plain = [m.costs(cm.windows([x])[0]).sum() for x in streams]
    assert np.allclose(first, plain, rtol=1e-5) and np.allclose(again, plain, rtol=1e-5)


ROWS = [(i, " ".join(("the cat sat on a mat", "a dog ran to the sea")[(i + j) % 2] for j in range(3))) for i in range(40)] + [
    (100, None), (101, ""), (102, "The\tCAT unknownword\x0b"), (103, "zz " * 20_000), (None, "the cat"), (3, "the cat sat"), (3, "the cat sat")]


def test_scores_and_base(spark, docs_of):
    got = cm.score(docs_of(ROWS)).collect()
    want = base(ROWS)
    key = lambda r: tuple((x is None, x) if not isinstance(x, float) else (False, round(x, 6)) for x in r)
    assert sorted((key(tuple(r)[:6]) for r in got)) == sorted(map(key, want))
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    plain = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 40]
    assert sum(r["bits_per_byte"] for r in plain) / len(plain) < 1.5
    assert len({round(r["score"], 4) for r in got if r["doc_id"] in (100, 101)}) == 1


def test_empty_tables(spark, docs_of):
    docs = docs_of(ROWS)
    assert cm.score(docs.where(F.lit(False))).count() == 0
    got = cm.score(docs.where("doc_id is null")).collect()
    assert len(got) == 1 and got[0]["base_score"] == 0 and got[0]["train_tokens"] == 0
    assert got[0]["bits_per_byte"] == pytest.approx(8)


def test_query_base_matches_brute_force(spark, sf_small):
    from tallyhour.llm.entry_queries import op3_context_mixing
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = {r["doc_id"]: r for r in op3_context_mixing(spark, sf_small).collect()}
    for d, held, n, known, total, b in base(rows):
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(b)
    held = [r["bits_per_byte"] for r in got.values() if r["held_out"]]
    assert sum(held) / len(held) < 4


def exact(texts):
    """(context, predictor, first bits of a byte) -> how often, by brute force."""
    c = Counter()
    for t in texts:
        w = cm.windows([cm.stream(cm.tokens(t))])[0]
        for i, past in enumerate(cm.pasts(w)):
            for p, b in zip(past.tolist(), (w & np.uint64(255)).tolist()):
                c.update((i, p, level, b >> 8 - level) for level in range(9))
    return c


def test_counts_of_every_context_are_exact(spark, docs_of):
    rng = np.random.default_rng(5)
    texts = ["".join(chr(c) for c in rng.choice([32, 32, 97, 98, 99, 0, 233, 0x4E2D], 300)) for _ in range(12)]
    texts += [bytes(rng.integers(33, 127, 4000, np.uint8)).decode() for _ in range(4)] + ["zz " * 30_000]
    docs = [(i, t) for i, t in enumerate(texts)]
    learned = [t for d, t in docs if zlib.crc32(str(d).encode()) % 5 != 1]
    assert len(learned) < len(docs)
    want = exact(learned)
    gathered = cm.gather_windows(cm._blocks(docs_of(docs)))
    short = cm.Short(*cm.count_short(gathered))
    seen = 0
    for r in gathered.collect():
        w, n = np.frombuffer(r["windows"], np.uint64), np.frombuffer(r["n"], np.int64)
        counts = short.counts(w, n)
        for i, past in enumerate(cm.pasts(w)):
            for j, (p, b) in enumerate(zip(past.tolist(), (w & np.uint64(255)).tolist())):
                assert counts[i, :, j].tolist() == [want[i, p, level, b >> 8 - level] for level in range(9)]
        seen += len(w)
    assert seen == len(np.unique(np.concatenate([cm.windows([cm.stream(cm.tokens(t))])[0] for t in texts])))
    assert max(want.values()) > 60_000  # more than half precision holds
