"""High-water marks and new-data gates (B-01..B-08, B-10, B-11)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhour.functions.exprs import date_lit, hour_of, ts_lit
from tallyhour.schemas import OWNER_NETWORK, SSP_SITE_TYPES, SYNDICATION_NETWORK  # noqa: F401

EPOCH_TS = _dt.datetime(1970, 1, 1)
EPOCH_DATE = _dt.date(1970, 1, 1)

# Per-source watermark definitions: (column, default, hour truncation, filter builder).
WATERMARKS = {
    "events_stream": ("max_events_stream_timestamp", EPOCH_TS, True, None),
    "gam": ("max_gam_timestamp", EPOCH_TS, False, None),
    "demand_partner": ("max_demand_partner_date", EPOCH_DATE, False, None),
    # external SSP rows only: first-party MinuteSSP rows carry a tracked count
    "ssp": ("max_ssp_date", EPOCH_DATE, False,
            lambda: (F.col("network") == F.lit(OWNER_NETWORK)) & F.col("tracked_event_count").isNull()),
    "syndication": ("max_syndication_date", EPOCH_DATE, False,
                    lambda: F.col("network") == F.lit(SYNDICATION_NETWORK)),
}


def _lit(v) -> Column:
    if isinstance(v, _dt.datetime):
        return ts_lit(v)
    if isinstance(v, _dt.date):
        return date_lit(v)
    return F.lit(v)


def watermark(ssot: DataFrame, col: str, default=None, *, trunc_hour: bool = False,
              where: Column | None = None) -> DataFrame:
    """B-01..B-05: one-row DataFrame ``increment_column`` = coalesce(max(col)[, hour], default).

    A global aggregate: partial max per task, one tiny final merge.
    """
    df = ssot if where is None else ssot.where(where)
    m = F.max(col)
    if trunc_hour:
        m = hour_of(m)
    out = m if default is None else F.coalesce(m, _lit(default))
    return df.agg(out.alias("increment_column"))


def source_watermark(ssot: DataFrame, source: str, *, use_default: bool = True) -> DataFrame:
    col, default, trunc, where = WATERMARKS[source]
    return watermark(ssot, col, default if use_default else None, trunc_hour=trunc,
                     where=where() if where is not None else None)


def watermark_value(ssot: DataFrame, source: str, *, use_default: bool = True,
                    dates: Sequence[_dt.date] | None = None, trunc: bool = True):
    """B-06: the scalar watermark for ``source`` (one small action, one row to the driver).

    ``use_default=False`` returns None for an empty history (bootstrap, H5). ``dates`` are the
    partitions of the fact table: a row's watermark lies on its own ``event_date``, so the newest
    partitions are probed first, twice as many each time, and the scan ends at the first that
    hold one. ``trunc=False`` keeps the minutes of an hourly watermark.
    """
    col, default, hourly, where = WATERMARKS[source]
    cond = where() if where is not None else None
    if dates is None:
        found = watermark(ssot, col, trunc_hour=hourly and trunc, where=cond).first()[0]
    else:
        found, rest, n = None, sorted(dates, reverse=True), 1
        while rest and found is None:
            some, rest, n = rest[:n], rest[n:], 2 * n
            part = ssot.where(F.col("event_date").isin(some))
            found = watermark(part, col, trunc_hour=hourly and trunc, where=cond).first()[0]
    return default if found is None and use_default else found


def new_data_flag(df: DataFrame, date_col: str, wm, *, where: Column | None = None) -> DataFrame:
    """B-07/B-08 one-row ``has_new_data`` = count(*) > 0 over rows after ``wm``."""
    cond = F.col(date_col) > _lit(wm)
    if where is not None:
        cond = cond & where
    return df.where(cond).agg((F.count(F.lit(1)) > 0).alias("has_new_data"))


def has_new_data(df: DataFrame, date_col: str, wm, *, where: Column | None = None) -> bool:
    """B-07/B-08/B-10 gate evaluated with an early-exit probe (stops at the first row)."""
    cond = F.col(date_col) > _lit(wm)
    if where is not None:
        cond = cond & where
    return len(df.where(cond).select(date_col).take(1)) > 0


def gam_due(run_ts: _dt.datetime, hour: int = 17) -> bool:
    """B-11: GAM reconciliation runs only in the given UTC hour."""
    return run_ts.hour == hour


def ssp_new_data(reports: DataFrame, wm) -> DataFrame:
    """B-07 SSP new-data flag (external site types only)."""
    return new_data_flag(reports, "report_date", wm, where=F.col("site_type").isin(*SSP_SITE_TYPES))


def syndication_new_data(reports: DataFrame, wm) -> DataFrame:
    """B-08 syndication new-data flag."""
    return new_data_flag(reports, "transaction_date", wm)
