import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhour.operators import delta, dq, merge
from tallyhour.plans.jobs import Options, run_demand_partner
from tallyhour.schemas import DEMAND_PARTNER_SCHEMA, GRAIN
from tallyhour.sources.fixtures import dimension
from tallyhour.sources.tables import empty_ssot

from helpers import RUN_TS, fact, ssot_rows

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _grouped(spark, rows):
    """Events-grouping shaped source from fact dicts."""
    cols = GRAIN + ["tracked_event_count", "actual_revenue", "estimated_revenue", "max_events_stream_timestamp"]
    return ssot_rows(spark, rows).select(*cols)


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_idempotent(spark):
    src = _grouped(spark, [fact(network="GAM", country="US", tracked_event_count=2, estimated_revenue=1.0),
                           fact(hour=1, network="MinuteSSP", tracked_event_count=1, actual_revenue=0.5)])
    spec = merge.events_spec(RUN_TS)
    once = merge.merge_into(empty_ssot(spark), src, spec).table
    twice = merge.merge_into(once, src, spec).table
    assert once.count() == 2 and _sorted(once) == _sorted(twice)
    r = once.where("network = 'GAM'").first()
    assert r["dwh_created_at"] == RUN_TS and r["reconciled_event_count"] is None


def test_a_merge_does_not_double_the_tables_pieces(spark):
    t = ssot_rows(spark, [fact(day=d, hour=h, network=n, tracked_event_count=1) for d in (1, 2) for h in range(20)
                          for n in ("GAM", "Magnite")] + [fact(day=3)]).repartition(60).localCheckpoint()
    src = t.where("network = 'GAM' and event_date = date'2024-01-02'").select(
        *GRAIN, F.lit(5).cast("long").alias("allocated_reconciled_event_count"),
        F.lit(2.0).alias("allocated_actual_revenue"), F.lit(RUN_TS).cast("timestamp_ntz").alias("max_gam_timestamp"))
    # rows of the touched day before the watermark's day are carried: day 2 is touched, and none of it can match
    for wm, filled in ((None, 20), (dt.datetime(2024, 1, 9), 0)):
        res = merge.merge_into(t, src, merge.gam_spec(RUN_TS, wm), materialize=lambda d: d.localCheckpoint(),
                               materialize_scope="table")
        assert res.table.count() == 81 and res.table.where("reconciled_event_count = 5").count() == filled
        assert _sorted(res.merged) == _sorted(res.table.where("event_date = date'2024-01-02'")) and res.merged.count() == 40
    assert res.table.rdd.getNumPartitions() < 60 + 60  # carried rows stay with those of the other days


def test_namibia_vs_null_keys(spark):
    src = _grouped(spark, [fact(network="GAM", country="NA", tracked_event_count=1),
                           fact(network="GAM", country=None, tracked_event_count=2)])
    safe = merge.events_spec(RUN_TS, null_mode="null_safe")
    t = merge.merge_into(empty_ssot(spark), src, safe).table
    t = merge.merge_into(t, src, safe).table
    assert t.count() == 2
    code = merge.events_spec(RUN_TS, null_mode="sentinel")
    t = merge.merge_into(empty_ssot(spark), src, code).table    # first run: nothing to match, both inserted
    assert t.count() == 2
    with pytest.raises(merge.MergeCardinalityError):
        merge.merge_into(t, src, code)


def test_owner_rule_protects_partner_revenue(spark):
    target = ssot_rows(spark, [
        fact(network="GAM", tracked_event_count=1, actual_revenue=9.0, reconciled_event_count=4),
        fact(hour=1, network="MinuteSSP", tracked_event_count=1, actual_revenue=9.0)])
    src = _grouped(spark, [fact(network="GAM", tracked_event_count=3, estimated_revenue=1.0),
                           fact(hour=1, network="MinuteSSP", tracked_event_count=2, actual_revenue=2.0)])
    out = {r["network"]: r for r in merge.merge_into(target, src, merge.events_spec(RUN_TS)).table.collect()}
    assert out["GAM"]["actual_revenue"] == 9.0 and out["GAM"]["tracked_event_count"] == 3
    assert out["GAM"]["reconciled_event_count"] == 4
    assert out["MinuteSSP"]["actual_revenue"] == 2.0 and out["MinuteSSP"]["dwh_updated_at"] == RUN_TS


def test_update_only_adds_no_rows_and_respects_network(spark):
    target = ssot_rows(spark, [fact(network="GAM", tracked_event_count=1), fact(network="Magnite", tracked_event_count=1)])
    src = ssot_rows(spark, [fact(network="GAM"), fact(network="Magnite"), fact(day=2, network="GAM")]).select(
        *GRAIN).withColumns({"allocated_reconciled_event_count": F.lit(7).cast("bigint"),
                             "allocated_actual_revenue": F.lit(1.5), "max_gam_timestamp": F.lit(RUN_TS)})
    out = merge.merge_into(target, src, merge.gam_spec(RUN_TS, dt.datetime(2023, 12, 31))).table
    rows = {r["network"]: r for r in out.collect()}
    assert out.count() == 2
    assert rows["GAM"]["reconciled_event_count"] == 7 and rows["Magnite"]["reconciled_event_count"] is None


def test_daily_watermark_on_insert(spark):
    cols = GRAIN + ["tracked_event_count", "reconciled_event_count", "actual_revenue", "estimated_revenue",
                    "max_ssp_date"]
    src = ssot_rows(spark, [fact(network="MinuteSSP", reconciled_event_count=3, actual_revenue=1.0,
                                 max_ssp_date=D1)]).select(*cols)
    code = merge.merge_into(empty_ssot(spark), src, merge.ssp_spec(RUN_TS, watermark_on_insert=False)).table
    safe = merge.merge_into(empty_ssot(spark), src, merge.ssp_spec(RUN_TS)).table
    assert code.first()["max_ssp_date"] is None and safe.first()["max_ssp_date"] == D1
    again = merge.merge_into(code, src, merge.ssp_spec(RUN_TS, watermark_on_insert=False)).table
    assert again.first()["max_ssp_date"] == D1      # second run updates it


def test_smart_delta_sequence(spark):
    reports = spark.createDataFrame([(D1, "A", "o", None, "us", 1, 1.0), (D2, "A", "o", None, "us", 1, 1.0),
                                     (D1, "B", "o", None, "us", 1, 1.0)], DEMAND_PARTNER_SCHEMA)
    wm = dt.date(1970, 1, 1)
    ssot = ssot_rows(spark, [fact(network="A", actual_revenue=1.0)])
    assert tuple(delta.oldest_unprocessed(reports, ssot, wm).first()) == (True, D1)
    ssot = ssot_rows(spark, [fact(network="A", actual_revenue=1.0), fact(network="B", actual_revenue=1.0)])
    assert tuple(delta.oldest_unprocessed(reports, ssot, wm).first()) == (True, D2)
    ssot = ssot_rows(spark, [fact(network="A", actual_revenue=1.0), fact(network="B", actual_revenue=1.0),
                             fact(day=2, network="A", actual_revenue=1.0)])
    assert tuple(delta.oldest_unprocessed(reports, ssot, wm).first()) == (False, None)
    assert delta.pending_dates(reports, ssot_rows(spark, []), wm) == [D1, D2]


def test_planted_faults(spark):
    good = [fact(network="GAM", tracked_event_count=1), fact(hour=1, network="GAM", tracked_event_count=1)]
    ok = ssot_rows(spark, good)
    for chk in (dq.check_grain_uniqueness(ok), dq.check_required_fields(ok), dq.check_no_negatives(ok)):
        assert chk.first()["passed"] is True
    dup = ssot_rows(spark, good + [fact(network="GAM", tracked_event_count=5)])
    assert tuple(dq.check_grain_uniqueness(dup).first()) == (0, 1, False)
    assert dq.check_required_fields(dup).first()["passed"] is True
    nul = ssot_rows(spark, good + [fact(event=None, network="GAM")])
    assert dq.check_required_fields(nul).first()["passed"] is False
    neg = ssot_rows(spark, good + [fact(hour=5, actual_revenue=-1.0)])
    assert dq.check_no_negatives(neg).first()["passed"] is False
    rep = dq.run_checks(neg, {})
    st = {r["name"]: r["status"] for r in rep.collect()}
    assert st["ssot_no_negatives"] == "FAIL" and st["ssp_revenue_conservation"] == "SKIP"
    assert list(st.values()).count("SKIP") == 4 and st["ssot_grain_uniqueness"] == "PASS"
    with pytest.raises(dq.BlockingCheckError):
        dq.run_checks(neg, {}, raise_on_blocking=True)


def test_conservation_and_bounding_modes(spark):
    staged = ssot_rows(spark, [fact(network="MinuteSSP", actual_revenue=1.25), fact(hour=1, network="MinuteSSP",
                                                                                   actual_revenue=2.0)])
    full = dq.check_conservation(staged, staged).first()
    assert full["passed"] and full["expected_value"] == 3.25
    part = dq.check_conservation(staged, staged.where("event_hour = '2024-01-01 00:00:00'")).first()
    assert not part["passed"] and part["actual_value"] == 1.25
    grouped = spark.createDataFrame([(10.0,)], "total_gam_revenue double")
    alloc = ssot_rows(spark, [fact()]).select("event_date")
    ssot = ssot_rows(spark, [fact(network="GAM", actual_revenue=6.0, max_gam_timestamp=RUN_TS)])
    assert dq.check_gam_bounding(grouped, alloc, ssot, mode="equal").first()["passed"] is False
    assert dq.check_gam_bounding(grouped, alloc, ssot, mode="bounded").first()["passed"] is True


def test_partner_lookback_picks_up_late_older_date(spark):
    d5, d9 = dt.date(2024, 1, 5), dt.date(2024, 1, 9)
    reports = spark.createDataFrame([(d5, "B", "o", None, "us", 1, 1.0), (d9, "A", "o", None, "us", 1, 1.0)],
                                    DEMAND_PARTNER_SCHEMA)
    ssot = ssot_rows(spark, [fact(day=9, network="A", actual_revenue=1.0, max_demand_partner_date=d9)])
    wm = d9   # global max of the processed dates
    assert tuple(delta.oldest_unprocessed(reports, ssot, wm, lookback_days=0).first()) == (False, None)
    assert tuple(delta.oldest_unprocessed(reports, ssot, wm, lookback_days=7).first()) == (True, d5)


@pytest.mark.parametrize("catch_up", [False, True])
def test_partner_report_is_taken_when_its_traffic_comes_weeks_later(spark, catch_up):
    d1, d25 = dt.date(2024, 1, 1), dt.date(2024, 1, 25)
    report = lambda d, p: (d, p, "o", None, "us", 4, 2.0)
    inputs = {"fact_demand_partner_reports": spark.createDataFrame([report(d1, "A"), report(d25, "A")], DEMAND_PARTNER_SCHEMA),
              "dim_ad_unit_mapping": dimension(spark, "dim_ad_unit_mapping")}
    traffic = lambda d: fact(d, network="A", organization_id="o", country="US", tracked_event_count=4)
    opts = Options(run_ts=RUN_TS)
    first = run_demand_partner(inputs, ssot_rows(spark, [traffic(25)]), opts)
    assert first.info["dates"] == [d25] and first.info["waiting"] == [d1]
    late = first.ssot.unionByName(ssot_rows(spark, [traffic(1)]))
    second = run_demand_partner(inputs, late, opts.with_(catch_up=catch_up))
    assert second.info["dates"] == [d1] and second.info["waiting"] == []
    assert {r["event_date"]: r["actual_revenue"] for r in second.ssot.collect()} == {d1: 2.0, d25: 2.0}
    assert not run_demand_partner(inputs, second.ssot, opts).ran


def test_owner_rule_replace_vs_coalesce(spark):
    target = ssot_rows(spark, [fact(network="MinuteSSP", tracked_event_count=1, actual_revenue=9.0)])
    src = _grouped(spark, [fact(network="MinuteSSP", tracked_event_count=2, actual_revenue=None,
                                estimated_revenue=1.0)])
    rep = merge.merge_into(target, src, merge.events_spec(RUN_TS, owner_actual="replace")).table.first()
    coa = merge.merge_into(target, src, merge.events_spec(RUN_TS, owner_actual="coalesce")).table.first()
    assert rep["actual_revenue"] is None and coa["actual_revenue"] == 9.0
    assert rep["tracked_event_count"] == coa["tracked_event_count"] == 2


def test_dq_scoped_to_touched_dates(spark):
    rows = [fact(network="GAM", tracked_event_count=1), fact(network="GAM", tracked_event_count=2),   # old duplicate
            fact(day=2, network="GAM", tracked_event_count=1)]
    ssot = ssot_rows(spark, rows)
    full = {r["name"]: r["status"] for r in dq.run_checks(ssot, {}).collect()}
    touched = {r["name"]: r["status"] for r in dq.run_checks(ssot, {}, dates=[D2]).collect()}
    assert full["ssot_grain_uniqueness"] == "FAIL" and touched["ssot_grain_uniqueness"] == "PASS"
