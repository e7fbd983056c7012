import datetime as dt

from pyspark.sql import functions as F

from tallyhour.operators import allocation, explode, grouping
from tallyhour.schemas import SSP_SCHEMA
from tallyhour.sources.fixtures import dimension
from tallyhour.operators.pull import pull_ssp

from helpers import fact, ssot_rows

D1 = dt.date(2024, 1, 1)


def _ssp(spark, rows):
    return pull_ssp(spark.createDataFrame(rows, SSP_SCHEMA), dt.date(1970, 1, 1))


def test_explode_remainder_and_conservation(spark):
    rows = [(D1, f"pub_{i}", "display", "external", "US", n, 24.0 * (i + 1)) for i, n in enumerate([50, 24, 23, 0])]
    out = explode.ssp_explode(_ssp(spark, rows), dimension(spark, "dim_country_mapping"))
    first = {r["organization_id"]: r["reconciled_event_count"]
             for r in out.where(F.col("event_hour") == dt.datetime(2024, 1, 1, 0)).collect()}
    other = {r["organization_id"]: r["reconciled_event_count"]
             for r in out.where(F.col("event_hour") == dt.datetime(2024, 1, 1, 5)).collect()}
    assert first == {"pub_0": 4, "pub_1": 1, "pub_2": 23, "pub_3": 0}
    assert other == {"pub_0": 2, "pub_1": 1, "pub_2": 0, "pub_3": 0}
    tot = out.groupBy("organization_id").agg(F.sum("reconciled_event_count").alias("n"),
                                              F.sum("actual_revenue").alias("r"), F.count("*").alias("h"))
    assert {r["organization_id"]: (r["n"], round(r["r"], 9), r["h"]) for r in tot.collect()} == {
        "pub_0": (50, 24.0, 24), "pub_1": (24, 48.0, 24), "pub_2": (23, 72.0, 24), "pub_3": (0, 96.0, 24)}


def test_explode_twin_rows(spark):
    rows = [(D1, "pub_0", "display", "external", "GBR", 50, 10.0), (D1, "pub_0", "display", "ext_player", "GB", 50, 14.0)]
    dim = dimension(spark, "dim_country_mapping")
    safe = explode.ssp_explode(_ssp(spark, rows), dim, remainder="per_grain")
    assert safe.count() == 24
    assert safe.agg(F.sum("reconciled_event_count")).first()[0] == 100
    code = explode.ssp_explode(_ssp(spark, rows), dim, remainder="first_row")
    assert code.count() == 48
    assert code.agg(F.sum("reconciled_event_count")).first()[0] == 98


def test_country_normalisation(spark):
    rows = [(D1, "p", "display", "external", c, 24, 1.0) for c in ("usa", "fr", "ZZZ", "GBR")]
    out = explode.ssp_explode(_ssp(spark, rows), dimension(spark, "dim_country_mapping"))
    assert sorted({r[0] for r in out.select("country").collect()}, key=str) == sorted(["US", "FR", None, "GB"], key=str)


def _gam_grouped(spark, rows):
    return spark.createDataFrame(rows, "event_date date, event_hour timestamp_ntz, ad_unit_id string, line_item string, "
                                       "country string, total_gam_impressions bigint, total_gam_revenue double, "
                                       "max_gam_timestamp timestamp_ntz")


def test_gam_allocation_weights_rounding_zero(spark):
    h = dt.datetime(2024, 1, 1, 0)
    traffic = ssot_rows(spark, [
        fact(network="GAM", adunit="/unit/0", line_item="1", country="US", tracked_event_count=1, domain="a"),
        fact(network="GAM", adunit="/unit/0", line_item="1", country="US", tracked_event_count=1, domain="b"),
        fact(network="GAM", adunit="/unit/1", line_item="1", country="US", tracked_event_count=0, domain="c"),
        fact(network="GAM", adunit="/zzz", line_item="1", country="US", tracked_event_count=7, domain="d"),
    ])
    grouped = _gam_grouped(spark, [(D1, h, "1000", "1", "US", 5, 10.0, h), (D1, h, "1001", "1", "US", 9, 3.0, h)])
    sl = allocation.ssot_slice(traffic, [D1], networks=["GAM"])
    out = {r["domain"]: r for r in allocation.gam_allocation(sl, grouped, dimension(spark, "dim_ad_unit_mapping")).collect()}
    assert set(out) == {"a", "b", "c"}          # unmapped unit never matches
    assert out["a"]["weight"] == 0.5 and out["a"]["allocated_reconciled_event_count"] == 3   # 2.5 -> 3 (code rounding)
    assert out["a"]["allocated_actual_revenue"] == 5.0 and out["a"]["total_tracked_for_group"] == 2
    assert out["c"]["weight"] == 0.0 and out["c"]["allocated_actual_revenue"] == 0.0     # zero denominator


def _dp_grouped(spark, rows):
    return spark.createDataFrame(rows, "event_date date, network string, organization_id string, adunit string, "
                                       "country string, total_demand_partner_impressions bigint, "
                                       "total_demand_partner_revenue_usd double, max_demand_partner_date date")


def test_partner_two_unmapped_units_one_site(spark):
    traffic = ssot_rows(spark, [
        fact(network="IndexExchange", adunit="/unit/0", country="US", tracked_event_count=1, domain="a"),
        fact(network="IndexExchange", adunit="/unit/1", country="US", tracked_event_count=1, domain="b"),
    ])
    grouped = _dp_grouped(spark, [(D1, "IndexExchange", "org_0", "u1", "US", 10, 10.0, D1),
                                  (D1, "IndexExchange", "org_0", "u2", "US", 20, 20.0, D1)])
    sl = allocation.ssot_slice(traffic, [D1], exclude_networks=["GAM", "MinuteSSP"])
    dim = dimension(spark, "dim_ad_unit_mapping")
    code = allocation.demand_partner_allocation(grouped, sl, dim, mode="per_row")
    assert code.count() == 4
    assert round(code.agg(F.sum("allocated_actual_revenue")).first()[0], 9) == 15.0
    safe = allocation.demand_partner_allocation(grouped, sl, dim, mode="per_path")
    assert safe.count() == 2
    assert round(safe.agg(F.sum("allocated_actual_revenue")).first()[0], 9) == 30.0
    assert safe.agg(F.sum("allocated_reconciled_event_count")).first()[0] == 30


def test_partner_site_wide_plus_exact_share(spark):
    traffic = ssot_rows(spark, [
        fact(network="Triplelift", adunit="/unit/1", organization_id="org_1", country="US", tracked_event_count=3,
             domain="a"),
        fact(network="Triplelift", adunit="/unit/2", organization_id="org_1", country="US", tracked_event_count=1,
             domain="b"),
    ])
    grouped = _dp_grouped(spark, [(D1, "Triplelift", "org_1", "ALIAS_1", "US", 8, 8.0, D1),   # -> /unit/1
                                  (D1, "Triplelift", "org_1", None, "US", 4, 4.0, D1)])       # site-wide
    sl = allocation.ssot_slice(traffic, [D1], exclude_networks=["GAM", "MinuteSSP"])
    dim = dimension(spark, "dim_ad_unit_mapping")
    safe = {r["domain"]: r for r in allocation.demand_partner_allocation(grouped, sl, dim).collect()}
    assert round(safe["a"]["allocated_actual_revenue"], 9) == 8.0 + 3.0
    assert round(safe["b"]["allocated_actual_revenue"], 9) == 1.0
    code = allocation.demand_partner_allocation(grouped, sl, dim, mode="per_row")
    assert code.count() == 3 and round(code.agg(F.sum("allocated_actual_revenue")).first()[0], 9) == 12.0


def test_unmatched_report_allocates_nothing(spark):
    traffic = ssot_rows(spark, [fact(network="Magnite", country="US", tracked_event_count=2)])
    grouped = _dp_grouped(spark, [(D1, "Magnite", "org_9", None, "US", 10, 10.0, D1)])
    sl = allocation.ssot_slice(traffic, [D1], exclude_networks=["GAM", "MinuteSSP"])
    assert allocation.demand_partner_allocation(grouped, sl, dimension(spark, "dim_ad_unit_mapping")).count() == 0


def test_events_grouping_split_revenue(spark):
    from tallyhour.operators.pull import pull_events
    from tallyhour.schemas import EVENTS_STREAM_SCHEMA
    t = dt.datetime(2024, 1, 1, 2, 10)
    rows = [(t, "served", "o", "/u", "d", "MinuteSSP", None, None, "1", None, None, "US", 2000.0),
            (t, "served", "o", "/u", "d", "MinuteSSP", None, None, "1", None, None, "US", 1000.0),
            (t, "served", "o", "/u", "d", "GAM", None, None, "1", None, None, "US", 500.0)]
    ev = spark.createDataFrame(rows, EVENTS_STREAM_SCHEMA)
    g = {r["network"]: r for r in grouping.group_events(pull_events(ev, None, span=None),
                                                         dimension(spark, "dim_line_items_mapping")).collect()}
    assert g["MinuteSSP"]["tracked_event_count"] == 2 and g["MinuteSSP"]["actual_revenue"] == 3.0
    assert g["MinuteSSP"]["estimated_revenue"] is None and g["GAM"]["estimated_revenue"] == 0.5
    assert g["GAM"]["actual_revenue"] is None and g["GAM"]["advertiser"] == "adv_1"
