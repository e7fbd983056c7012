"""Column-returning helpers (scalar functions of the pipeline).

All are compositions of built-in ``pyspark.sql.functions`` so they stay inside
whole-stage code generation; none is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from tallyhour.schemas import AUCTION_NETWORK, NULL_SENTINEL, OWNER_NETWORK  # noqa: F401

__all__ = [
    "col_or", "utc_date", "hour_of", "ts_lit", "date_lit", "domain_of", "strip_www", "canonical_network",
    "cpm_to_revenue", "actual_flag", "sum_where", "proportional_weight", "allocate_count", "allocate_revenue",
    "null_safe_eq", "sentinel", "NULL_SENTINEL", "typed_null", "normalise_country_code",
]

# Authority of a URL: after an optional scheme and its //, up to the path, query, fragment or end. The scheme
# part is possessive, so that a scheme is never read as a host; a blank inside is no URL.
_AUTHORITY = r"^\s*+(?:(?:[A-Za-z][A-Za-z0-9+.-]*+:)?+//)?+([^/?#\s]*+)(?:[/?#]|\s*$)"
# Host inside an authority: behind any user info, an address in brackets or all before the port.
_HOST = r"^(?:.*@)?(\[[^\]]*\]|[^:@\[\]]+)(?::[0-9]*)?$"
_WWW_PATTERN = r"^www\."


def col_or(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(v: _dt.datetime | str | None) -> Column:
    """Typed TIMESTAMP_NTZ literal (UTC wall clock)."""
    if v is None:
        return F.lit(None).cast("timestamp_ntz")
    if isinstance(v, str):
        v = _dt.datetime.fromisoformat(v)
    if v.tzinfo is not None:
        v = v.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return F.lit(v).cast("timestamp_ntz")


def date_lit(v: _dt.date | str | None) -> Column:
    if v is None:
        return F.lit(None).cast("date")
    if isinstance(v, str):
        v = _dt.date.fromisoformat(v)
    if isinstance(v, _dt.datetime):
        v = v.date()
    return F.lit(v).cast("date")


def utc_date(ts: str | Column) -> Column:
    """H-01 ``date(ts)`` in UTC."""
    return F.to_date(col_or(ts))


def hour_of(ts: str | Column) -> Column:
    """H-02 ``timestamp_trunc(ts, hour)``, kept as TIMESTAMP_NTZ."""
    return F.date_trunc("hour", col_or(ts)).cast("timestamp_ntz")


def strip_www(host: str | Column) -> Column:
    """H-12 remove one leading ``www.``."""
    return F.regexp_replace(col_or(host), _WWW_PATTERN, "")


def domain_of(url: str | Column) -> Column:
    """H-11 + H-12: host of a URL without a leading ``www.``.

    Blanks around the URL are ignored; the scheme, or scheme and ``//``, may be missing;
    hosts may hold any characters (international names) or be an address in brackets. What
    has no host (an empty authority, a blank inside it, a port that is no number) gives null.
    """
    authority = F.regexp_extract(col_or(url), _AUTHORITY, 1)
    return strip_www(F.nullif(F.regexp_extract(authority, _HOST, 1), F.lit("")))


def canonical_network(network: str | Column, paying_entity: str | Column) -> Column:
    """H-18 Prebid is an auction platform: the paying partner becomes the network."""
    n = col_or(network)
    return F.when(n == F.lit(AUCTION_NETWORK), col_or(paying_entity)).otherwise(n)


def cpm_to_revenue(cpm: str | Column) -> Column:
    """H-23 revenue of one impression from its CPM."""
    return col_or(cpm) / F.lit(1000)


def actual_flag(network: str | Column, owner: str = OWNER_NETWORK) -> Column:
    """1 when the row's revenue is actual (owned network), else 0. Uses the raw network."""
    return F.when(col_or(network) == F.lit(owner), F.lit(1)).otherwise(F.lit(0))


def sum_where(cond: Column, x: str | Column) -> Column:
    """E-02 ``sum(case when cond then x end)``: null when no row qualifies."""
    return F.sum(F.when(cond, col_or(x)))


def proportional_weight(x: str | Column, total: str | Column) -> Column:
    """G-01 ``coalesce(x / nullif(total, 0), 0)`` as double."""
    return F.coalesce(F.try_divide(col_or(x).cast("double"), F.nullif(col_or(total), F.lit(0))),
                      F.lit(0.0))


def allocate_count(total: str | Column, weight: str | Column) -> Column:
    """G-03 ``cast(round(total * weight) as bigint)``, half away from zero."""
    return F.round(col_or(total) * col_or(weight)).cast("bigint")


def allocate_revenue(total: str | Column, weight: str | Column) -> Column:
    """G-02 ``total * weight`` (unrounded)."""
    return col_or(total) * col_or(weight)


def sentinel(c: Column, value: str = NULL_SENTINEL) -> Column:
    return F.coalesce(c, F.lit(value))


def null_safe_eq(a: Column, b: Column, mode: str = "null_safe") -> Column:
    """D-14 key equality that matches null to null.

    ``null_safe`` (default) is ``a <=> b``. ``sentinel`` is the reference's
    ``coalesce(a,'NA') = coalesce(b,'NA')``, which also equates null with the
    literal 'NA' (Namibia's ISO code).
    """
    if mode == "null_safe":
        return a.eqNullSafe(b)
    if mode == "sentinel":
        return sentinel(a) == sentinel(b)
    if mode == "plain":
        return a == b
    raise ValueError(f"unknown null mode {mode!r}")


def typed_null(dtype: str) -> Column:
    """C-08 typed null placeholder."""
    return F.lit(None).cast(dtype)


def normalise_country_code(code: str | Column, alpha3_match: str | Column) -> Column:
    """D-03: two-letter codes kept (upper-cased), otherwise the alpha-3 lookup result."""
    c = col_or(code)
    return F.coalesce(F.when(F.length(c) == 2, F.upper(c)), col_or(alpha3_match))
