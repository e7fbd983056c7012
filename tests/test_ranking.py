import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyhour.operators import ranking
from tallyhour.operators.ranking import largest_remainder, place_in_group


def brute(rows):
    """(group, id) -> share, by exact fractions."""
    out, groups = {}, {}
    for g, i, total, part, whole in rows:
        groups.setdefault(g, []).append((i, total, part, whole))
    for g, members in groups.items():
        shares = []
        for i, total, part, whole in members:
            good = whole is not None and whole > 0 and part is not None and total is not None
            shares.append((i, Fraction(total * part, whole) if good else Fraction(0)))
        due = (2 * sum(s for _, s in shares) + 1) // 2
        base = {i: int(s) for i, s in shares}
        more = int(due) - sum(base.values())
        for i, s in sorted(shares, key=lambda x: (-(x[1] - int(x[1])), x[0]))[:max(0, more)]:
            base[i] += 1
        out |= {(g, i): n for i, n in base.items()}
    return out


def shares(spark, rows):
    df = spark.createDataFrame(rows, "g string, id long, total long, part long, whole long")
    got = largest_remainder(df, ["g"], "total", "part", "whole", [F.col("id").asc()], "share")
    return {(r["g"], r["id"]): r["share"] for r in got.collect()}


def group(g, total, parts):
    return [(g, i, total, p, sum(parts)) for i, p in enumerate(parts)]


@pytest.mark.parametrize("buckets", [1, 3, 4096])
def test_shares_add_up_and_equal_exact_fractions(spark, monkeypatch, buckets):
    monkeypatch.setattr(ranking, "BUCKETS", buckets)
    rng = random.Random(5)
    rows = group("ties", 10, [1] * 37) + group(None, 7, [3, 3, 3]) + group("none", 0, [1, 2]) + group("one", 12345, [9])
    rows += group("big", 10 ** 15 + 7, [10 ** 9 + i for i in range(5)])
    for n in range(12):
        rows += group(f"r{n}", rng.randrange(2000), [rng.randrange(0, 9) for _ in range(rng.randrange(1, 60))] + [1])
    rows += [("bad", 1, None, 1, 2), ("bad", 2, 5, None, 2), ("bad", 3, 5, 1, 0), ("bad", 4, 5, 1, None)]
    got, want = shares(spark, rows), brute(rows)
    assert got == want
    for g in ("ties", "one", "big"):
        assert sum(n for (k, _), n in got.items() if k == g) == next(r[2] for r in rows if r[0] == g)


def test_a_huge_group_is_spread_over_tasks(spark):
    n = 60_000
    df = spark.range(n).select(F.lit("hot").alias("g"), "id", F.lit(n // 3 * 7 + 1).cast("long").alias("total"), F.lit(1).cast("long").alias("part"),
                               F.lit(n).cast("long").alias("whole"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = place_in_group(df, ["g"], [F.col("id").desc()])
        sizes = [r["n"] for r in placed.groupBy(F.expr("(60000 - id) div 7500").alias("x")).agg(F.count("*").alias("n")).collect()]
        assert placed.where("place != 60000 - id").count() == 0 and len(sizes) >= 8
        got = largest_remainder(df, ["g"], "total", "part", "whole", [F.col("id").asc()], "share")
        assert got.agg(F.sum("share")).first()[0] == n // 3 * 7 + 1
        assert got.where(f"share != 2 + cast(id < {n // 3 + 1} as int)").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_no_rows(spark):
    assert shares(spark, []) == {}
