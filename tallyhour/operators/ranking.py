"""Places of rows within groups of any size, and exact shares by largest remainder (G-03, H11).

A window over a group would put all of it in one task. Here rows are dealt by range of
(group, order), so that a large group spans many tasks; a row's place is its place in its
task plus the rows its group has in earlier ones, of which there is one count per task and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhour.sources.staging import stage_table

#: Classes that the remainders of a group are first counted in.
BUCKETS = 4096


def place_in_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], out: str = "place") -> DataFrame:
    """``df`` with each row's place (from 1) in its group; ``order`` must leave no ties that matter."""
    keys = [F.col(g).asc_nulls_first() for g in group]
    dealt = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    # written, as the bounds of a range are sampled: reading it twice must give the same rows
    held = stage_table(dealt.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "placed")
    parts = held.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    p = parts.select(F.col("_part").alias("_p"), *[F.col(g).alias("_grp_" + g) for g in group], "_first", "_before")
    on = held["_part"] == p["_p"]
    for g in group:
        on = on & held[g].eqNullSafe(p["_grp_" + g])
    joined = held.join(p, on).withColumn(out, F.col("_before") + F.col("_at") - F.col("_first") + 1)
    return joined.select(*df.columns, out)


def largest_remainder(df: DataFrame, group: Sequence[str], total: str, part: str, whole: str, ties: Sequence[Column],
                      out: str) -> DataFrame:
    """Shares ``total * part / whole`` as whole numbers that add up to the group's rounded sum of shares.

    ``total`` and ``whole`` are equal in a group. Every row gets its share without the fraction; what
    is missing goes one by one to the rows of the largest fractions, ties by ``ties``. All in exact
    integers. A histogram of each group's fractions (at most BUCKETS counts) finds the class in which
    the last one falls: rows above it get one, rows below none, and only rows of that class are ranked,
    by :func:`place_in_group`. A missing or zero ``whole``, ``part`` or ``total`` gives 0.
    """
    number = lambda c: F.col(c).cast("decimal(38,0)")
    good = F.coalesce((F.col(whole) > 0) & F.col(part).isNotNull() & F.col(total).isNotNull(), F.lit(False))
    product = F.col(total).cast("decimal(19,0)") * F.col(part).cast("decimal(18,0)")
    rows = df.withColumn("_product", F.when(good, product).otherwise(F.lit(0).cast("decimal(38,0)")))
    rows = rows.withColumn("_whole", F.when(good, number(whole)).otherwise(F.lit(1).cast("decimal(38,0)")))
    rows = rows.withColumn("_rest", F.col("_product") % F.col("_whole"))
    rows = rows.withColumn("_floor", ((F.col("_product") - F.col("_rest")) / F.col("_whole")).cast("long"))
    rows = rows.withColumn("_class", F.floor(F.col("_rest").cast("double") / F.col("_whole").cast("double") * BUCKETS).cast("int"))
    rows = stage_table(rows, "shares")
    counts = rows.groupBy(*group, "_class").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_floor").alias("_f"), F.sum("_product").alias("_p"), F.max("_whole").alias("_w"))
    whole_group = Window.partitionBy(*group)  # at most BUCKETS + 1 rows a group
    above = whole_group.orderBy(F.desc("_class")).rowsBetween(Window.unboundedPreceding, -1)
    due = F.floor((2 * F.sum("_p").over(whole_group) + F.max("_w").over(whole_group)) / (2 * F.max("_w").over(whole_group)))
    counts = counts.withColumn("_more", (due - F.sum("_f").over(whole_group)).cast("long") - F.coalesce(F.sum("_n").over(above), F.lit(0)))
    c = counts.select(*[F.col(g).alias("_grp_" + g) for g in group], F.col("_class").alias("_c"), "_n", "_more")
    on = rows["_class"] == c["_c"]
    for g in group:
        on = on & rows[g].eqNullSafe(c["_grp_" + g])
    known = rows.join(c, on).drop("_c", *["_grp_" + g for g in group])
    split = (F.col("_more") > 0) & (F.col("_more") < F.col("_n"))
    plain = known.where(~split).withColumn("_one", (F.col("_more") > 0).cast("long"))
    ranked = place_in_group(known.where(split), [*group, "_class"], [F.desc("_rest"), *ties], "_place")
    ranked = ranked.withColumn("_one", (F.col("_place") <= F.col("_more")).cast("long")).drop("_place")
    both = plain.unionByName(ranked)
    return both.select(*df.columns, (F.col("_floor") + F.col("_one")).alias(out))
