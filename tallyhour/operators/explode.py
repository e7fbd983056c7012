"""Daily -> hourly explosion (G-06..G-09).

A daily row becomes 24 hourly rows with revenue / 24 and count div 24, the
count remainder going to the first hour so counts are conserved exactly.
``posexplode`` gives the hour index, so the default needs no shuffle once the
input is at output grain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhour.functions.exprs import typed_null
from tallyhour.operators.mapping import normalise_country
from tallyhour.schemas import GRAIN, OWNER_NETWORK, SERVED_EVENT

HOURS_PER_DAY = 24


def explode_hours(df: DataFrame, date_col: str = "event_date") -> DataFrame:
    """G-06/D-13: one row per hour of the day; adds ``hour_index`` and ``event_hour`` (midnight .. 23:00)."""
    start = F.col(date_col).cast("timestamp_ntz")
    hours = F.sequence(start, start + F.expr("INTERVAL 23 HOURS"), F.expr("INTERVAL 1 HOUR"))
    return df.select("*", F.posexplode(hours).alias("hour_index", "event_hour"))


def spread_count(count_col: str, first_hour) -> F.Column:
    """``div(n, 24)`` plus ``mod(n, 24)`` on the first hour (truncating, sign of dividend)."""
    n = F.col(count_col)
    return (F.expr(f"`{count_col}` div {HOURS_PER_DAY}")
            + F.when(first_hour, n % HOURS_PER_DAY).otherwise(F.lit(0))).cast("bigint")


def explode_daily(df: DataFrame, *, date_col: str, count_col: str, revenue_col: str,
                  remainder: str = "per_grain", partition_keys: Sequence[str] = ()) -> DataFrame:
    """G-07 explode daily totals to hours.

    ``per_grain`` (default): remainder on hour index 0 of every input row;
    the caller pre-aggregates to output grain so rows are unique.
    ``first_row``: the reference rule, remainder on the first row of each
    ``partition_keys`` group ordered by hour (several input rows in one group
    share one remainder, H4).
    """
    x = explode_hours(df, date_col)
    if remainder == "per_grain":
        first = F.col("hour_index") == 0
    elif remainder == "first_row":
        w = Window.partitionBy(*partition_keys).orderBy("event_hour")
        first = F.row_number().over(w) == 1
    else:
        raise ValueError(f"unknown remainder rule {remainder!r}")
    return x.withColumns({
        "reconciled_event_count": spread_count(count_col, first),
        "actual_revenue": F.col(revenue_col) / F.lit(HOURS_PER_DAY),
    })


def _to_fact(x: DataFrame, wm_col: str) -> DataFrame:
    cols = []
    have = set(x.columns)
    for c in GRAIN:
        cols.append(F.col(c) if c in have else typed_null("string").alias(c))
    cols += [typed_null("bigint").alias("tracked_event_count"), F.col("reconciled_event_count"),
             F.col("actual_revenue"), typed_null("double").alias("estimated_revenue"), F.col(wm_col)]
    return x.select(*cols)


def ssp_explode(pulled: DataFrame, country_dim: DataFrame, *, remainder: str = "per_grain") -> DataFrame:
    """G-08: SSP daily report -> hourly fact rows (network MinuteSSP, event served)."""
    m = normalise_country(pulled, country_dim, code_col="country_code", out_col="country")
    daily = m.select(
        F.col("report_date").alias("event_date"), F.col("publisher_id").alias("organization_id"),
        F.col("placement_type").alias("media_type"), F.lit(OWNER_NETWORK).alias("network"),
        F.lit(SERVED_EVENT).alias("event"), "country", "impressions", "revenue_usd", "max_ssp_date")
    keys = ["event_date", "organization_id", "media_type", "country"]
    if remainder == "per_grain":
        daily = daily.groupBy(*keys, "network", "event").agg(
            F.sum("impressions").alias("impressions"), F.sum("revenue_usd").alias("revenue_usd"),
            F.max("max_ssp_date").alias("max_ssp_date"))
    x = explode_daily(daily, date_col="event_date", count_col="impressions", revenue_col="revenue_usd",
                      remainder=remainder, partition_keys=keys)
    return _to_fact(x, "max_ssp_date")


def syndication_explode(pulled: DataFrame, *, remainder: str = "per_grain") -> DataFrame:
    """G-09: syndication daily revenue -> hourly fact rows."""
    keys = ["event_date", "organization_id", "demand_owner"]
    daily = pulled
    if remainder == "per_grain":
        daily = pulled.groupBy(*keys, "network", "event").agg(
            F.sum("article_count").alias("article_count"), F.sum("total_revenue").alias("total_revenue"),
            F.max("max_syndication_date").alias("max_syndication_date"))
    x = explode_daily(daily, date_col="event_date", count_col="article_count", revenue_col="total_revenue",
                      remainder=remainder, partition_keys=keys)
    return _to_fact(x, "max_syndication_date")
