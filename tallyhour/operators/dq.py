"""Data-quality checks on the fact table and staged results (J-01..J-09).

Each check is a one-row DataFrame ``(expected_value, actual_value, passed)``
computed by global aggregates. :func:`run_checks` builds the report from four scans
of the fact table: one groups it by its grain, one reads all row tests and both
bounding totals together, two join it with the staged daily sources.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhour.schemas import GAM_NETWORK, GRAIN, NULL_SENTINEL, OWNER_NETWORK, REQUIRED_GRAIN


class BlockingCheckError(RuntimeError):
    """A blocking data-quality check failed."""


def _grain_keys(null_mode: str) -> list[Column]:
    out = []
    for k in GRAIN:
        c = F.col(k)
        if null_mode == "sentinel" and k not in REQUIRED_GRAIN:
            c = F.coalesce(c, F.lit(NULL_SENTINEL))
        out.append(c.alias(k))
    return out


def _count_check(df: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(F.lit(0).cast("bigint").alias("expected_value"), n.alias("actual_value"),
                  (n == 0).alias("passed"))


def check_grain_uniqueness(ssot: DataFrame, *, null_mode: str = "sentinel") -> DataFrame:
    """J-01: number of grain keys present more than once (expected 0)."""
    dup = ssot.groupBy(*_grain_keys(null_mode)).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return _count_check(dup)


def check_required_fields(ssot: DataFrame) -> DataFrame:
    """J-02: rows with a null required grain column."""
    cond = None
    for k in REQUIRED_GRAIN:
        c = F.col(k).isNull()
        cond = c if cond is None else cond | c
    return _count_check(ssot.where(cond))


def check_no_negatives(ssot: DataFrame) -> DataFrame:
    """J-03: rows with a negative metric (null passes)."""
    cond = None
    for k in ["actual_revenue", "estimated_revenue", "tracked_event_count", "reconciled_event_count"]:
        c = F.col(k) < 0
        cond = c if cond is None else cond | c
    return _count_check(ssot.where(F.coalesce(cond, F.lit(False))))


def _two_totals(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Combine two one-row totals into one row without a join (tagged union + global agg)."""
    u = (expected.select(F.lit("e").alias("_tag"), F.col("total"))
         .unionByName(actual.select(F.lit("a").alias("_tag"), F.col("total"))))
    return u.agg(F.max(F.when(F.col("_tag") == "e", F.col("total"))).alias("expected_value"),
                 F.max(F.when(F.col("_tag") == "a", F.col("total"))).alias("actual_value"))


MONEY_DECIMAL = "decimal(38,12)"


def rounded_total(df: DataFrame, col: str, digits: int = 4) -> DataFrame:
    """E-11 ``round(sum(col), digits)``.

    The sum runs in DECIMAL(38,12): exact and independent of the order in which
    partial sums meet, so the rounded total cannot flip between runs or engines.
    """
    return df.agg(F.round(F.sum(F.col(col).cast(MONEY_DECIMAL)), digits).cast("double").alias("total"))


def staged_dates(staged: DataFrame) -> list:
    """The dates of a staged table (bounded by the days of a run)."""
    return sorted(r[0] for r in staged.select("event_date").distinct().collect() if r[0] is not None)


def in_dates(col: Column, dates: Sequence) -> Column:
    """Membership in literal dates: prunes partitions; false for null dates and for no dates."""
    days = [d for d in dates if d is not None]
    return F.coalesce(col.isin(days), F.lit(False)) if days else F.lit(False)


def check_conservation(staged: DataFrame, ssot: DataFrame, *, tolerance: float = 0.0,
                       null_mode: str = "sentinel", digits: int = 4, dates: Sequence | None = None) -> DataFrame:
    """J-04/J-05: staged revenue equals the fact revenue of the matching grain rows."""
    s = staged.select(*_grain_keys(null_mode), F.col("actual_revenue"))
    t = ssot.select(*[c.alias("_t_" + k) for k, c in zip(GRAIN, _grain_keys(null_mode))],
                    F.col("actual_revenue").alias("_t_actual"))
    cond = None
    for k in GRAIN:
        c = (s[k] == t["_t_" + k]) if (null_mode == "sentinel" or k in REQUIRED_GRAIN) else s[k].eqNullSafe(t["_t_" + k])
        cond = c if cond is None else cond & c
    # the staged dates as literals, so that only their fact partitions are listed and read
    t = t.where(in_dates(F.col("_t_event_date"), staged_dates(staged) if dates is None else dates))
    matched = s.join(t, cond, "inner").select(F.col("_t_actual").alias("actual_revenue"))
    r = _two_totals(rounded_total(staged, "actual_revenue", digits), rounded_total(matched, "actual_revenue", digits))
    diff = F.abs(F.coalesce(F.col("expected_value"), F.lit(0.0)) - F.coalesce(F.col("actual_value"), F.lit(0.0)))
    passed = (diff == 0) if tolerance == 0 else (diff <= F.lit(tolerance))
    return r.select("expected_value", "actual_value", passed.alias("passed"))


def gam_rows() -> Column:
    return (F.col("network") == GAM_NETWORK) & F.col("max_gam_timestamp").isNotNull()


def partner_rows() -> Column:
    return ~F.col("network").isin(GAM_NETWORK, OWNER_NETWORK) & F.col("max_demand_partner_date").isNotNull()


def check_bounding(grouped: DataFrame, allocated: DataFrame, ssot: DataFrame, *, source_col: str,
                   where: Column, mode: str = "equal", rel_tolerance: float = 0.001,
                   digits: int = 4) -> DataFrame:
    """J-06/J-07: allocated revenue in the fact table vs the source total.

    ``equal`` is the reference test (rounded equality); ``bounded`` passes when
    the allocation does not exceed the source by more than ``rel_tolerance``.
    """
    t = ssot.where(in_dates(F.col("event_date"), staged_dates(allocated)) & where)
    r = _two_totals(rounded_total(grouped, source_col, digits), rounded_total(t, "actual_revenue", digits))
    passed = _bound_passed(F.col("expected_value"), F.col("actual_value"), mode, rel_tolerance)
    return r.select("expected_value", "actual_value", passed.alias("passed"))


def check_gam_bounding(grouped: DataFrame, allocated: DataFrame, ssot: DataFrame, *, mode: str = "equal") -> DataFrame:
    return check_bounding(grouped, allocated, ssot, source_col="total_gam_revenue", mode=mode, where=gam_rows())


def check_demand_partner_bounding(grouped: DataFrame, allocated: DataFrame, ssot: DataFrame, *,
                                  mode: str = "equal") -> DataFrame:
    return check_bounding(grouped, allocated, ssot, source_col="total_demand_partner_revenue_usd", mode=mode,
                          where=partner_rows())


# J-09: pipeline -> staged results needed by its check (present in ``staged`` = pipeline ran).
SSOT_CHECKS = ["ssot_grain_uniqueness", "ssot_required_fields", "ssot_no_negatives"]
PIPELINE_CHECKS = [("ssp", "ssp_revenue_conservation"), ("syndication", "syndication_revenue_conservation"),
                   ("gam", "gam_revenue_bounding"), ("demand_partner", "demand_partner_revenue_bounding")]


def _fmt(c: Column, integral: bool) -> Column:
    if integral:
        return c.cast("bigint").cast("string")
    return F.format_string("%.4f", c)


def _bound_passed(expected: Column, actual: Column, mode: str, rel_tolerance: float = 0.001) -> Column:
    a, e = F.coalesce(actual, F.lit(0.0)), F.coalesce(expected, F.lit(0.0))
    return (a == e) if mode == "equal" else (a <= e * F.lit(1.0 + rel_tolerance))


def row_checks(fact: DataFrame, staged: Mapping[str, Mapping[str, DataFrame]], *, bounding_mode: str = "equal",
               digits: int = 4) -> DataFrame:
    """J-02, J-03, J-06 and J-07 from one scan of ``fact``: rows ``(n, expected_value, actual_value, passed)``.

    Row tests and bounding totals are sums over the same rows; the source totals join in as rows
    of a tagged union. Checks of pipelines that are not in ``staged`` give no row.
    """
    money = lambda c: F.col(c).cast(MONEY_DECIMAL)
    bound = {"gam": ("total_gam_revenue", gam_rows(), 6),
             "demand_partner": ("total_demand_partner_revenue_usd", partner_rows(), 7)}
    bound = {k: v for k, v in bound.items() if k in staged}
    flag = lambda c: F.when(F.coalesce(c, F.lit(False)), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    missing = negative = None
    for k in REQUIRED_GRAIN:
        c = F.col(k).isNull()
        missing = c if missing is None else missing | c
    for k in ["actual_revenue", "estimated_revenue", "tracked_event_count", "reconciled_event_count"]:
        c = F.coalesce(F.col(k) < 0, F.lit(False))
        negative = c if negative is None else negative | c
    cols = {"missing": flag(missing), "negative": flag(negative)}
    for k, (_, where, _) in bound.items():
        days = staged_dates(staged[k]["allocated"])
        cols["a_" + k] = F.when(in_dates(F.col("event_date"), days) & where, money("actual_revenue"))
        cols["e_" + k] = F.lit(None).cast(MONEY_DECIMAL)
    rows = fact.select(*[c.alias(n) for n, c in cols.items()])
    for k, (source, _, _) in bound.items():
        rows = rows.unionByName(staged[k]["grouped"].select(money(source).alias("e_" + k)), allowMissingColumns=True)
    one = rows.agg(*[F.sum(n).alias(n) for n in cols])
    total = lambda n: F.round(F.col(n), digits).cast("double")
    zero = F.lit(0.0)
    out = [F.struct(F.lit(n).alias("n"), zero.alias("expected_value"), F.coalesce(F.col(c), F.lit(0)).cast("double").alias("actual_value"),
                    (F.coalesce(F.col(c), F.lit(0)) == 0).alias("passed")) for n, c in ((2, "missing"), (3, "negative"))]
    for k, (_, _, n) in bound.items():
        out.append(F.struct(F.lit(n).alias("n"), total("e_" + k).alias("expected_value"), total("a_" + k).alias("actual_value"),
                            _bound_passed(total("e_" + k), total("a_" + k), bounding_mode).alias("passed")))
    return one.select(F.inline(F.array(*out)))


def run_checks(ssot: DataFrame, staged: Mapping[str, Mapping[str, DataFrame]], *,
               null_mode: str = "sentinel", bounding_mode: str = "equal", raise_on_blocking: bool = False,
               tolerance: float = 0.0, dates: Sequence | None = None) -> DataFrame:
    """J-08: the full suite as one DataFrame ``(n, name, severity, expected_value, actual_value,
    passed, status)``; status is PASS / FAIL (blocking) / WARN / SKIP.

    ``staged`` maps pipeline name -> its staged DataFrames ("exploded" for SSP
    and syndication; "grouped" and "allocated" for GAM and partners). A missing
    pipeline is skipped, as it did not produce fresh staged data. ``dates``
    limits every check to the partitions this run touched (earlier partitions were
    validated when they were written); ``None`` checks the whole table as the
    reference does.
    """
    fact = ssot if dates is None else ssot.where(in_dates(F.col("event_date"), dates))
    cols = ["n", "expected_value", "actual_value", "passed"]
    numbered = lambda n, df: df.select(F.lit(n).alias("n"), F.col("expected_value").cast("double").alias("expected_value"),
                                       F.col("actual_value").cast("double").alias("actual_value"), "passed")
    out = numbered(1, check_grain_uniqueness(fact, null_mode=null_mode)).unionByName(
        row_checks(fact, staged, bounding_mode=bounding_mode).select(cols))
    names = [(1, SSOT_CHECKS[0], "blocking"), (2, SSOT_CHECKS[1], "blocking"), (3, SSOT_CHECKS[2], "blocking")]
    for n, (pipeline, name) in enumerate(PIPELINE_CHECKS, 4):
        names.append((n, name, "warning"))
        if pipeline not in staged:
            out = out.unionByName(ssot.sparkSession.range(1).select(
                F.lit(n).alias("n"), *[F.lit(None).cast("double").alias(c) for c in cols[1:3]],
                F.lit(None).cast("boolean").alias("passed")))
        elif pipeline in ("ssp", "syndication"):
            out = out.unionByName(numbered(n, check_conservation(staged[pipeline]["exploded"], fact, tolerance=tolerance,
                                                                 null_mode=null_mode)))
    pick = lambda i: F.element_at(F.create_map(*[x for t in names for x in (F.lit(t[0]), F.lit(t[i]))]), F.col("n"))
    skipped = F.lit(False)
    for n, (pipeline, _) in enumerate(PIPELINE_CHECKS, 4):
        if pipeline not in staged:
            skipped = skipped | (F.col("n") == n)
    fmt = lambda c: F.when(F.col("n") <= 3, _fmt(F.col(c), True)).otherwise(_fmt(F.col(c), False))
    shown = lambda c: F.when(~skipped, fmt(c)).alias(c)
    out = out.select("n", pick(1).alias("name"), pick(2).alias("severity"), shown("expected_value"), shown("actual_value"), "passed",
                     F.when(skipped, F.lit("SKIP")).when(F.col("passed"), F.lit("PASS"))
                     .when(F.col("n") <= 3, F.lit("FAIL")).otherwise(F.lit("WARN")).alias("status"))
    if raise_on_blocking:
        failed = [r["name"] for r in out.where(F.col("status") == "FAIL").select("name").collect()]
        if failed:
            raise BlockingCheckError(f"DQ blocking checks failed: {', '.join(failed)}")
    return out
