"""Smart delta check for partner reports (B-09, D-08, D-09, E-07, E-09)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhour.functions.exprs import date_lit
from tallyhour.schemas import SERVED_EVENT


def _d(v):
    if isinstance(v, _dt.datetime):
        return v.date()
    if isinstance(v, str):
        return _dt.date.fromisoformat(v[:10])
    return v


def unprocessed_pairs(reports: DataFrame, ssot: DataFrame, wm, *, lookback_days: int | None = 0) -> DataFrame:
    """(report_date, partner_name) pairs that arrived on/after ``wm - lookback_days`` but have
    no fact row with actual revenue for that (date, network).

    ``lookback_days`` > 0 re-examines recent dates so a partner delivering an
    older date late is still picked up (H7); 0 is the reference behaviour; None takes the
    reports of every date.
    """
    if lookback_days is not None:
        lo = date_lit(_d(wm) - _dt.timedelta(days=lookback_days))
        reports, ssot = reports.where(F.col("report_date") >= lo), ssot.where(F.col("event_date") >= lo)
    arriving = reports.where(F.col("report_date").isNotNull()).select("report_date", "partner_name").distinct()
    # (day, network) pairs are few, but nothing bounds them here: the fact side is folded to pairs
    # before any shuffle, and Spark broadcasts the small sides by their measured size.
    partners = arriving.select(F.col("partner_name").alias("_p")).distinct()
    processed = (
        ssot.where(F.col("actual_revenue").isNotNull())
        .select("event_date", "network").distinct()
        .join(partners, F.col("network") == F.col("_p"), "left_semi"))
    cond = ((arriving["partner_name"] == processed["network"])
            & (arriving["report_date"] == processed["event_date"]))
    return arriving.join(processed, cond, "left_anti")


def oldest_unprocessed(reports: DataFrame, ssot: DataFrame, wm, *, lookback_days: int = 0) -> DataFrame:
    """B-09: one row ``(has_new_data, increment_column)``: the earliest unprocessed date."""
    u = unprocessed_pairs(reports, ssot, wm, lookback_days=lookback_days)
    m = F.min("report_date")
    return u.agg(m.isNotNull().alias("has_new_data"), m.alias("increment_column"))


def pending_dates(reports: DataFrame, ssot: DataFrame, wm, *, lookback_days: int = 0) -> list:
    """All unprocessed report dates (bounded by the number of days), oldest first."""
    u = unprocessed_pairs(reports, ssot, wm, lookback_days=lookback_days)
    return sorted(r[0] for r in u.select("report_date").distinct().collect() if r[0] is not None)


def with_traffic(pairs: DataFrame, ssot: DataFrame) -> DataFrame:
    """``pairs`` (report_date, partner_name) with ``has_traffic``: whether the fact table holds served
    traffic of that network on that date, without which nothing can be allocated (H8)."""
    first = pairs.agg(F.min("report_date")).first()[0]
    if first is None:
        return pairs.withColumn("has_traffic", F.lit(False))
    traffic = (ssot.where((F.col("event_date") >= date_lit(first)) & (F.col("event") == SERVED_EVENT))
               .select(F.col("event_date").alias("_d"), F.col("network").alias("_n")).distinct())
    joined = pairs.join(traffic, (pairs["report_date"] == traffic["_d"]) & (pairs["partner_name"] == traffic["_n"]), "left")
    return joined.select("report_date", "partner_name", F.col("_d").isNotNull().alias("has_traffic"))
