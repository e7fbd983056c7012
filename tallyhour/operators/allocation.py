"""Proportional allocation of late totals over observed traffic (F-01, F-02, G-01..G-05).

Group denominators are never computed with a window over traffic rows (a
busy site or hour would land in one task). Traffic is pre-aggregated to the
group keys (partial aggregation map-side), joined with the small totals
table at group level, and the traffic rows then join that group-level result
once: a broadcast when AQE measures it small, else a sort-merge join whose
skewed partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhour.functions.exprs import allocate_count, allocate_revenue, null_safe_eq, proportional_weight
from tallyhour.operators.grouping import exact_money_sum
from tallyhour.operators.mapping import map_gam_ad_unit, map_partner_ad_unit
from tallyhour.operators.ranking import largest_remainder
from tallyhour.schemas import ALL_UNITS, GRAIN, SERVED_EVENT

SLICE_COLUMNS = GRAIN + ["tracked_event_count"]


def apply_weights(df: DataFrame, *, count_total: str, revenue_total: str,
                  tracked: str = "tracked_event_count", denominator: str = "total_tracked_for_group") -> DataFrame:
    """G-01..G-03: weight, rounded allocated count, allocated revenue."""
    w = proportional_weight(tracked, denominator)
    return df.withColumns({
        "weight": w,
        "allocated_reconciled_event_count": allocate_count(count_total, w),
        "allocated_actual_revenue": allocate_revenue(revenue_total, w),
    })


def ssot_slice(ssot: DataFrame, dates, *, networks: Sequence[str] | None = None,
               exclude_networks: Sequence[str] | None = None, event: str = SERVED_EVENT) -> DataFrame:
    """S-07/S-08: traffic rows of the given dates for allocation (14 columns).

    ``exclude_networks`` uses NOT IN, so rows with a null network are dropped too.
    """
    ds = list(dates)
    cond = (F.col("event") == F.lit(event)) & F.col("event_date").isin(ds)
    if networks is not None:
        cond = cond & F.col("network").isin(*networks)
    if exclude_networks is not None:
        cond = cond & ~F.col("network").isin(*exclude_networks)
    return ssot.where(cond).select(*SLICE_COLUMNS)


def _null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str], rkeys: Sequence[str]) -> Column:
    cond = None
    for a, b in zip(keys, rkeys):
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    return cond


def gam_allocation(slice_df: DataFrame, grouped: DataFrame, ad_unit_dim: DataFrame, *,
                   null_mode: str = "null_safe", count_method: str = "round") -> DataFrame:
    """G-04: spread GAM hourly totals over GAM traffic rows of the same hour, line item,
    country and (mapped) ad unit, in proportion to tracked events.

    Denominator of a traffic group P = (date, hour, line item, country, unit):
    the reference sums tracked events over the *joined* rows of P, i.e.
    ``T(P) * n(P)`` with ``T`` the traffic sum and ``n`` the number of totals rows
    matching P (normally 1). Both come from small P-level tables, so the
    row-level join with the traffic runs once and no task holds a whole group.

    ``count_method``: "round" rounds each row's count by itself, as the reference does;
    "largest_remainder" gives counts that add up to each totals row's count, ties by grain (H11).
    """
    if count_method not in ("round", "largest_remainder"):
        raise ValueError(f"unknown count method {count_method!r}")
    pk = ["event_date", "event_hour", "line_item", "country", "_map_unit"]
    t = map_gam_ad_unit(slice_df, ad_unit_dim, out_col="_map_unit")
    # The totals join needs a mapped unit id: unmapped traffic can never match.
    t = t.where(F.col("_map_unit").isNotNull())
    tp = t.groupBy(*pk).agg(F.sum("tracked_event_count").alias("_T"))
    g = grouped.select(
        F.col("event_date").alias("_g_date"), F.col("event_hour").alias("_g_hour"),
        F.col("line_item").alias("_g_li"), F.col("country").alias("_g_country"),
        F.col("ad_unit_id").try_cast("bigint").alias("_g_unit"),
        "total_gam_impressions", "total_gam_revenue", "max_gam_timestamp")
    cond = ((tp["event_date"] == g["_g_date"]) & (tp["event_hour"] == g["_g_hour"])
            & null_safe_eq(tp["line_item"], g["_g_li"], null_mode)
            & null_safe_eq(tp["country"], g["_g_country"], null_mode)
            & (tp["_map_unit"] == g["_g_unit"]))
    # P-level x matching totals rows: small (one row per traffic group and totals row)
    gp = tp.join(g, cond, "inner").withColumn(
        "total_tracked_for_group", F.col("_T") * F.count(F.lit(1)).over(Window.partitionBy(*pk)))
    gp = gp.select(*[F.col(k).alias("_p_" + k) for k in pk], "total_gam_impressions", "total_gam_revenue",
                   "max_gam_timestamp", "total_tracked_for_group", "_g_li", "_g_country")
    j = t.join(gp, _null_safe_on(t, gp, pk, ["_p_" + k for k in pk]), "inner")
    j = apply_weights(j, count_total="total_gam_impressions", revenue_total="total_gam_revenue")
    if count_method == "largest_remainder":
        j = largest_remainder(j.drop("allocated_reconciled_event_count"), [*pk, "_g_li", "_g_country"], "total_gam_impressions",
                              "tracked_event_count", "total_tracked_for_group", [F.col(k).asc_nulls_first() for k in GRAIN],
                              "allocated_reconciled_event_count")
    return j.select(*SLICE_COLUMNS, "total_gam_impressions", "total_gam_revenue", "max_gam_timestamp",
                    "total_tracked_for_group", "weight", "allocated_reconciled_event_count",
                    "allocated_actual_revenue")


DP_OUTPUT = GRAIN + ["max_demand_partner_date", "tracked_event_count", "weight",
                     "allocated_reconciled_event_count", "allocated_actual_revenue"]
SITE_KEYS = ["event_date", "network", "organization_id", "country"]
_G_TOTALS = ["total_demand_partner_impressions", "total_demand_partner_revenue_usd", "max_demand_partner_date"]


def partner_totals_with_denominator(grouped_mapped: DataFrame, slice_df: DataFrame) -> DataFrame:
    """D-07 + F-02 at group level: each report row with the traffic it is spread over.

    A report row whose ad unit maps to a DWH path covers the traffic rows of that
    path; one without a mapped path covers the whole site (site-wide broadcast).
    The reference's window sums tracked events over all joined rows of
    (site, path or 'all_units'), which equals ``T * n``: ``T`` the traffic sum of
    the covered rows and ``n`` the number of report rows in that group. Output:
    one row per (report row, covered group) with ``_unit_key`` and
    ``total_tracked_for_group``; site keys use plain equality as in the reference.
    """
    # one pass over the traffic; site totals roll up from the unit totals
    t_unit = slice_df.groupBy(*SITE_KEYS, "adunit").agg(F.sum("tracked_event_count").alias("_T"))
    t_site = t_unit.groupBy(*SITE_KEYS).agg(F.sum("_T").alias("_T"))
    g = grouped_mapped.select(*[F.col(k).alias("_g_" + k) for k in SITE_KEYS],
                              F.col("mapped_adunit_path").alias("_g_path"), *_G_TOTALS)

    def on(tt):
        c = None
        for k in SITE_KEYS:
            e = tt[k] == g["_g_" + k]
            c = e if c is None else c & e
        return c

    site = (g.where(F.col("_g_path").isNull()).join(t_site, on(t_site), "inner")
            .withColumn("_unit_key", F.lit(ALL_UNITS)).drop(*SITE_KEYS))
    exact = (g.where(F.col("_g_path").isNotNull())
             .join(t_unit, on(t_unit) & (t_unit["adunit"] == g["_g_path"]), "inner")
             .withColumn("_unit_key", F.col("_g_path")).drop(*SITE_KEYS, "adunit"))
    gt = site.unionByName(exact)
    part = [F.col("_g_" + k) for k in SITE_KEYS] + [F.col("_unit_key")]
    return gt.withColumn("total_tracked_for_group", F.col("_T") * F.count(F.lit(1)).over(Window.partitionBy(*part)))


def demand_partner_allocation(grouped: DataFrame, slice_df: DataFrame, ad_unit_dim: DataFrame, *,
                              mode: str = "per_path") -> DataFrame:
    """G-05: spread partner daily totals over the day's traffic.

    ``per_row`` is the reference rule: each report row is joined on its own, so
    several unmapped ad units in one site multiply rows and the denominator
    (H9). ``per_path`` (default) first sums report rows per mapped path (null =
    site-wide); a traffic row then receives at most one site-wide and one exact
    share, added up in one output row, so every report total is distributed
    once and each traffic row gets exactly one source row.
    """
    gm = map_partner_ad_unit(grouped, ad_unit_dim, out_col="mapped_adunit_path")
    if mode == "per_path":
        gm = gm.groupBy(*SITE_KEYS, "mapped_adunit_path").agg(
            F.sum("total_demand_partner_impressions").alias("total_demand_partner_impressions"),
            exact_money_sum("total_demand_partner_revenue_usd").alias("total_demand_partner_revenue_usd"),
            F.max("max_demand_partner_date").alias("max_demand_partner_date"))
    elif mode != "per_row":
        raise ValueError(f"unknown allocation mode {mode!r}")
    gt = partner_totals_with_denominator(gm, slice_df)
    t = slice_df

    def side(wide: bool, sfx: str) -> DataFrame:
        part = gt.where(F.col("_g_path").isNull() if wide else F.col("_g_path").isNotNull())
        part = part.select(*[F.col("_g_" + k).alias(f"_j{sfx}_" + k) for k in SITE_KEYS],
                           F.col("_g_path").alias(f"_j{sfx}_path"),
                           *[F.col(c).alias(c + sfx) for c in _G_TOTALS + ["total_tracked_for_group"]])
        return part

    s, e = side(True, "_s"), side(False, "_e")
    if mode == "per_row":
        # one output row per (traffic row, report row): site-wide and exact matches as two equi-joins
        outs = []
        for part, sfx, exact in ((s, "_s", False), (e, "_e", True)):
            c = None
            for k in SITE_KEYS:
                x = t[k] == part[f"_j{sfx}_" + k]
                c = x if c is None else c & x
            if exact:
                c = c & (t["adunit"] == part[f"_j{sfx}_path"])
            jj = t.join(part, c, "inner").select(
                *SLICE_COLUMNS, *[F.col(n + sfx).alias(n) for n in _G_TOTALS + ["total_tracked_for_group"]])
            outs.append(jj)
        j = apply_weights(outs[0].unionByName(outs[1]), count_total="total_demand_partner_impressions",
                          revenue_total="total_demand_partner_revenue_usd")
        return j.select(*DP_OUTPUT)
    cs = None
    for k in SITE_KEYS:
        c = t[k] == s["_j_s_" + k]
        cs = c if cs is None else cs & c
    ce = t["adunit"] == e["_j_e_path"]
    for k in SITE_KEYS:
        ce = ce & (t[k] == e["_j_e_" + k])
    j = t.join(s, cs, "left").join(e, ce, "left")
    j = j.where(F.col("_j_s_event_date").isNotNull() | F.col("_j_e_event_date").isNotNull())
    ws = proportional_weight("tracked_event_count", "total_tracked_for_group_s")
    we = proportional_weight("tracked_event_count", "total_tracked_for_group_e")
    has_s, has_e = F.col("_j_s_event_date").isNotNull(), F.col("_j_e_event_date").isNotNull()
    zero_l, zero_d = F.lit(0).cast("bigint"), F.lit(0.0)
    return j.select(
        *GRAIN,
        F.greatest("max_demand_partner_date_s", "max_demand_partner_date_e").alias("max_demand_partner_date"),
        "tracked_event_count",
        (F.when(has_s, ws).otherwise(zero_d) + F.when(has_e, we).otherwise(zero_d)).alias("weight"),
        (F.when(has_s, allocate_count("total_demand_partner_impressions_s", ws)).otherwise(zero_l)
         + F.when(has_e, allocate_count("total_demand_partner_impressions_e", we)).otherwise(zero_l))
        .alias("allocated_reconciled_event_count"),
        (F.when(has_s, allocate_revenue("total_demand_partner_revenue_usd_s", ws)).otherwise(zero_d)
         + F.when(has_e, allocate_revenue("total_demand_partner_revenue_usd_e", we)).otherwise(zero_d))
        .alias("allocated_actual_revenue"),
    )
