"""Incremental pulls (C-01..C-05): projection, renaming and time-slice filters.

Every filter compares the raw scan column with a typed literal so Catalyst
pushes it into the parquet scan (row-group skipping, partition pruning).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhour.functions.exprs import (actual_flag, canonical_network, cpm_to_revenue, date_lit,
                                       domain_of, hour_of, ts_lit, utc_date)
from tallyhour.schemas import SSP_SITE_TYPES, SYNDICATION_EVENT, SYNDICATION_NETWORK

EVENTS_SPAN = _dt.timedelta(days=5)


def as_date(v) -> _dt.date:
    """The calendar date of a date, timestamp or ISO string."""
    if isinstance(v, _dt.datetime):
        return v.date()
    if isinstance(v, str):
        return _dt.date.fromisoformat(v[:10])
    return v


def events_window(wm: _dt.datetime | None, span: _dt.timedelta | None = EVENTS_SPAN,
                  bounds: str = "half_open", ts_col: str = "timestamp"):
    """Time predicate of the events pull.

    ``exclusive`` is the reference's ``(wm, wm + span]``; ``half_open`` is
    ``[wm, wm + span)`` (an event exactly on the hour is not lost when that hour
    is recomputed, H2). ``wm=None`` reads from the start of the source,
    ``span=None`` up to its end (catch-up).
    """
    ts = F.col(ts_col)
    cond = F.lit(True)
    if wm is not None:
        cond = cond & ((ts > ts_lit(wm)) if bounds == "exclusive" else (ts >= ts_lit(wm)))
        if span is not None:
            hi = ts_lit(wm + span)
            cond = cond & ((ts <= hi) if bounds == "exclusive" else (ts < hi))
    elif span is not None:
        raise ValueError("a bounded span needs a watermark; pass wm or span=None")
    return cond


def _day_prune(wm, span, partition_col: str | None):
    """Redundant predicate on a raw table's day-partition column (e.g. ``event_day``), so
    a table partitioned by a derived day is pruned by directory, not only by row group."""
    if partition_col is None or wm is None:
        return F.lit(True)
    c = F.col(partition_col) >= date_lit(as_date(wm))
    if span is not None:
        c = c & (F.col(partition_col) <= date_lit(as_date(wm + span)))
    return c


def pull_events(events: DataFrame, wm: _dt.datetime | None = None, *,
                span: _dt.timedelta | None = EVENTS_SPAN, bounds: str = "half_open",
                partition_col: str | None = None) -> DataFrame:
    """C-01: slice the raw event table and derive the pipeline columns."""
    cond = events_window(wm, span, bounds) & _day_prune(wm, span, partition_col)
    return events.where(cond).select(
        utc_date("timestamp").alias("event_date"),
        hour_of("timestamp").alias("event_hour"),
        F.col("timestamp"),
        F.col("event"),
        F.col("organizationId").alias("organization_id"),
        F.col("adunit"),
        F.col("mediaType").alias("media_type"),
        canonical_network("network", "payingEntity").alias("network"),
        domain_of("url").alias("domain"),
        F.col("lineItem").alias("line_item"),
        F.col("adDealType").alias("ad_deal_type"),
        F.col("demandOwner").alias("demand_owner"),
        F.col("country"),
        cpm_to_revenue("cpm").alias("revenue"),
        actual_flag("network").alias("is_actual_revenue"),
    )


def gam_days(wm, today, *, catch_up: bool = False):
    """Predicate on ``date(timestamp)`` for the GAM pull.

    Reference: exactly the day after the watermark day, and only complete days
    (before ``today``). ``catch_up`` takes every complete day after it.
    """
    d = utc_date("timestamp")
    nxt = date_lit(as_date(wm) + _dt.timedelta(days=1))
    cond = (d >= nxt) if catch_up else (d == nxt)
    if today is not None:
        cond = cond & (d < date_lit(as_date(today)))
    return cond


def pull_next_day(gam: DataFrame, wm, today, *, catch_up: bool = False,
                  partition_col: str | None = None) -> DataFrame:
    """C-02: GAM rows of the next complete day after the watermark (or all later complete days).

    The bound is also stated on the raw timestamp so the scan can skip row groups,
    and on ``partition_col`` (a day-partition column) when the table has one.
    """
    nxt = as_date(wm) + _dt.timedelta(days=1)
    lo = ts_lit(_dt.datetime.combine(nxt, _dt.time()))
    cond = (F.col("timestamp") >= lo) & gam_days(wm, today, catch_up=catch_up)
    if partition_col is not None:
        p = F.col(partition_col)
        cond = cond & ((p >= date_lit(nxt)) if catch_up else (p == date_lit(nxt)))
    return gam.where(cond).select("timestamp", "session_id", "ad_unit_id", "line_item_id",
                                  "country_name", "impressions", "cpm_usd")


def pull_date(reports: DataFrame, dates: _dt.date | Iterable[_dt.date]) -> DataFrame:
    """C-03: partner report rows of the target date(s); the date is kept as the watermark column."""
    ds = [dates] if isinstance(dates, (_dt.date, str)) else list(dates)
    ds = [as_date(d) for d in ds]
    cond = (F.col("report_date") == date_lit(ds[0])) if len(ds) == 1 else F.col("report_date").isin(ds)
    return reports.where(cond).select(
        "report_date", "partner_name", "property_code", "ad_unit", "geo", "impressions", "revenue_usd",
        F.col("report_date").alias("max_demand_partner_date"))


def pull_ssp(reports: DataFrame, wm) -> DataFrame:
    """C-04: SSP rows on or after the watermark date (re-run safe), external site types only."""
    return reports.where((F.col("report_date") >= date_lit(as_date(wm)))
                         & F.col("site_type").isin(*SSP_SITE_TYPES)).select(
        "report_date", "publisher_id", "placement_type", "site_type",
        F.upper("country_code").alias("country_code"), "impressions", "revenue_usd",
        F.col("report_date").alias("max_ssp_date"))


def pull_syndication(reports: DataFrame, wm) -> DataFrame:
    """C-05: syndication rows on or after the watermark date, renamed to fact columns."""
    return reports.where(F.col("transaction_date") >= date_lit(as_date(wm))).select(
        F.col("transaction_date").alias("event_date"),
        F.col("content_property").alias("organization_id"),
        F.col("partner_name").alias("demand_owner"),
        F.lit(SYNDICATION_NETWORK).alias("network"),
        F.lit(SYNDICATION_EVENT).alias("event"),
        "article_count", "total_revenue",
        F.col("transaction_date").alias("max_syndication_date"))
