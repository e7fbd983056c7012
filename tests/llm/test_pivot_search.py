import random

import numpy as np
from pyspark.sql import functions as F

from tallyhour.llm import pivot_search as ps


def brute(rows, k=10, step=100, scale=1024.0):
    least = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        x = tuple(int(c) for c in np.floor(scale * np.array(v, np.float64)))
        least[i] = min(least.get(i, x), x)
    good = sorted(least.items())
    asked = {i: (None, x) for i, x in good if i % step == 0}
    out = []
    for q, (_, x) in asked.items():
        s = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q)[:k]
        out += [(q, r + 1, i, -n) for r, (n, i) in enumerate(s)]
    return sorted(out)


def run(spark, rows, k=10, step=100):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    v = ps.integer_vectors(df, 1024.0)
    return sorted(map(tuple, ps.top_k(v, v.where(F.col("vec_id") % step == 0), k).collect()))


def vectors(n, dim, seed, groups=5):
    rng = random.Random(seed)
    mid = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(groups)]
    return [(i, [float(np.float32(rng.choice(mid)[j] + rng.gauss(0, 0.3))) for j in range(dim)]) for i in range(n)]


def test_matches_brute_force(spark, monkeypatch):
    rows = vectors(900, 6, 1)
    assert run(spark, rows) == brute(rows)
    monkeypatch.setattr(ps, "BLOCK_ROWS", 16)
    monkeypatch.setattr(ps, "QUERY_BLOCK", 4)
    assert run(spark, rows) == brute(rows)


def test_odd_vectors_ties_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(ps, "BLOCK_ROWS", 8)
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(300)]  # one very common vector
    rows += [(1000, None), (1100, [1.0, None, 2.0]), (1200, [float("nan"), 0.0, 1.0]), (1300, [float("inf"), 0.0, 1.0]), (None, [1.0, 1.0, 1.0]),
             (1400, []), (1500, [0.0, 0.0, 0.0]), (1600, [3.0]), (1700, [-1.0, -2.0, -3.0, -4.0]), (5, [1.0, 2.0, 0.5]), (5, [9.0, 9.0, 9.0]),
             (100, [0.1, 0.2, 0.3])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, k=400) == brute(rows, k=400)


def test_large_components_use_integers(spark):
    rows = [(i, [float(np.float32(x * 1e5)) for x in v]) for i, v in vectors(300, 3, 4)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0])]) == []
    assert run(spark, [(100, [1.0])]) == []


def test_annuli_are_skipped():
    rng = np.random.default_rng(0)
    base = np.eye(4) * 1000
    x = np.rint(np.concatenate([base[i] + rng.normal(size=(50, 4)) for i in range(4)])).astype(np.int64)
    top = float((x * x).sum(1).max())
    q = ps.Queries(np.array([0]), x[:1], ps.lift(np.rint(base).astype(np.int64), top), top, True, 10)
    best = np.sort((x[1:] @ x[0]))[-10]
    d = ps.distances(ps.lift(x[150:], top), ps.lift(np.rint(base).astype(np.int64), top))[:, 3]
    assert q.bound(3, d.min(), d.max())[0] < best  # another cluster's annulus cannot hold a result


def test_rows_of_one_id_are_one_vector_as_in_the_sql(spark, tmp_path):
    import duckdb
    from tallyhour.llm.entry_queries import OP5_SQL, op5_pivot_search
    rng = np.random.default_rng(11)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, 3) / 4]) for i in rng.integers(0, 400, 900)]
    rows += rows[:50] + [(100, None), (200, [1.0, None, 0.0]), (300, [float("nan"), 0.0, 1.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = sorted(con.execute(OP5_SQL).fetchall())
    got = sorted(tuple(r) for r in op5_pivot_search(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect())
    assert got == want and len(want) >= 30


def test_values_that_leave_64_bits_are_an_error(spark):
    import pytest
    schema = "vec_id long, embedding array<double>"
    ok = spark.createDataFrame([(0, [2.0 ** 20, -2.0 ** 20]), (1, [2.0 ** 20, 0.0]), (2, [-2.0 ** 20, 1.0])], schema)
    v = ps.integer_vectors(ok, 1024.0)
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in ps.top_k(v, v.where("vec_id = 0"), 2).collect()}
    assert got == {(0, 1): 2 ** 60, (0, 2): -(2 ** 60) - 2 ** 40}
    for rows in ([(0, [2.0 ** 52])], [(0, [1e300]), (1, [0.0])]):
        with pytest.raises(Exception, match="2\\*\\*62"):
            ps.integer_vectors(spark.createDataFrame(rows, schema), 1024.0).collect()
    big = ps.integer_vectors(spark.createDataFrame([(0, [2.0 ** 30]), (1, [2.0 ** 30])], schema), 1024.0)
    with pytest.raises(OverflowError):
        ps.top_k(big, big, 1)
