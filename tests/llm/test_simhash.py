import random
from itertools import product

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tallyhour.llm import simhash


def brute_fp(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for s in "\t\n\x0b\x0c\r":
        t = t.replace(s, " ")
    w = [x for x in t.split(" ") if x]
    if not w:
        return 0
    sh = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits=4):
    """Smallest index reachable for every fingerprint."""
    a = np.array(fps, np.uint64)
    lab = list(range(len(a)))

    def find(i):
        while lab[i] != i:
            i = lab[i]
        return i
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[:i]) <= bits):
            x, y = find(i), find(int(j))
            lab[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(a))]


def test_block_pairs_cover_all_splits_of_four_bits():
    for d in product(range(5), repeat=3):
        if sum(d) <= 4:
            assert any((d[x] <= 1 and d[y] <= 1) or (d[x] == 0 and d[y] <= 2) for x, y in simhash.PAIRS)


def test_codes_are_perfect():
    for c, (_, n, _, radius, parity) in zip(simhash.codes(), simhash.BLOCKS):
        assert (c.upto[0] == 1).all()
        v = np.random.default_rng(0).integers(0, 1 << n, 1000)
        word = v ^ c.pat[c.start[c.syndrome(v)]]
        assert (c.syndrome(word) == 0).all() and np.bitwise_count(v ^ word).max() <= radius


def test_linked_pairs_meet_at_a_home_anchor():
    rng = random.Random(1)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 4)):
            y ^= 1 << b
        fp = np.array([x, y], np.uint64)
        homes = {int(h[0]) for h in simhash.home_anchors(fp)}
        mine = {int(a) for r, anc in simhash.member_anchors(fp) for a in anc[r == 1]}
        assert homes & mine


def test_fingerprints_match_brute_force(docs_of):
    texts = [None, "", " \t\n", "one", "One two", "a b c d", "a b c d e " * 50, "é ñ x\x0by z w", "x y z w v", "Z " * 9000]
    rows = simhash.fingerprints(docs_of([(i, t) for i, t in enumerate(texts)])).collect()
    assert {r["doc_id"]: r["fp"] & (1 << 64) - 1 for r in rows} == {i: brute_fp(t) for i, t in enumerate(texts)}


def clustered(n, seed=3):
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 30])):
            y = x
            for b in rng.sample(range(64), rng.randint(0, 6)):
                y ^= 1 << b
            out.append(y)
            x = rng.choice([x, y])
    return out[:n]


def test_components_match_all_pairs(spark, monkeypatch):
    for limit in (simhash.HOME_LIMIT, 1):
        monkeypatch.setattr(simhash, "HOME_LIMIT", limit)  # 1: every shared home is salted
        fps = sorted(set(clustered(1500)))
        signed = np.array(fps, np.uint64).view(np.int64).tolist()
        df = spark.createDataFrame([(f,) for f in signed], "fp long")
        roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(df)).collect()}
        want = brute_components(fps)
        got = [roots.get(f, f) for f in signed]
        classes = lambda lab: {frozenset(np.flatnonzero(np.array(lab, dtype=object) == v).tolist()) for v in set(lab)}
        assert classes(got) == classes(want)


def test_dense_group_yields_about_n_links(spark):
    base = random.Random(5).getrandbits(64)
    fps = {base}
    for a in range(64):
        for b in range(a):
            fps.add(base ^ 1 << a ^ 1 << b)
    signed = np.array(sorted(fps), np.uint64).view(np.int64).tolist()
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    assert edges.count() < 40 * len(signed)
    assert simhash.components(edges).select("root").distinct().count() == 1


def test_near_duplicates_and_keep_one(spark, docs_of):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(5, long), (3, long + " tail"), (9, None), (8, ""), (7, "quite another text of some words"), (7, "quite another text of some words"),
            (None, "alone with a null id here"), (2, "word " * 20000)]
    docs = docs_of(rows)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["fp"]): r["component_id"] for r in got}
    fps = [brute_fp(t) for _, t in rows]
    lab = brute_components(fps)
    for i, (d, _) in enumerate(rows):
        low = min((rows[j][0] for j in range(len(rows)) if lab[j] == lab[i] and rows[j][0] is not None), default=None)
        assert by[(d, int(np.uint64(fps[i]).view(np.int64)))] == low
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(
        {min(rows[j][0] for j in range(len(rows)) if lab[j] == lab[i]) for i in range(len(rows)) if rows[i][0]} | {-1})
    empty = docs.where(F.lit(False))
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_query_matches_brute_force_on_the_table(spark, sf_small):
    from tallyhour.llm.entry_queries import op10_simhash_anchors
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op10_simhash_anchors(spark, sf_small).collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect())
    fps = [brute_fp(t) for _, t in rows]
    lab = brute_components(fps)
    assert got == {d: (f"{fp:016x}", rows[l][0]) for (d, _), fp, l in zip(rows, fps, lab)}
