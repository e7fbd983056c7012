import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import RUN_TS, fact, ssot_rows
from tallyhour.operators import ledger, merge
from tallyhour.plans import jobs
from tallyhour.plans.jobs import Options, run_all
from tallyhour.schemas import DEMAND_PARTNER_SCHEMA
from tallyhour.sources import versions
from tallyhour.sources.fixtures import derived_inputs

D = [dt.date(2024, 1, d) for d in range(1, 32)]


def report(day, partner="Magnite", org="org_0", unit=None, geo="US", impressions=10, revenue=1.0):
    return (D[day - 1], partner, org, unit, geo, impressions, revenue)


def reports(spark, rows):
    return spark.createDataFrame(rows, DEMAND_PARTNER_SCHEMA)


def found(spark, rows, led, traffic):
    return sorted((r["report_date"].day, r["partner_name"], r["reason"]) for r in ledger.pending(reports(spark, rows), led, traffic).collect())


def empty(spark):
    return spark.createDataFrame([], ledger.LEDGER_SCHEMA)


def test_digests_tell_forms_apart(spark):
    def d(rows):
        return {(r["report_date"], r["partner_name"]): r["digest"] for r in ledger.digests(reports(spark, rows)).collect()}
    a = [report(1), report(1, org="org_1"), report(2), (None, "Magnite", "o", None, None, 1, 1.0)]
    assert d(a) == d(a[::-1]) and set(d(a)) == {(D[0], "Magnite"), (D[1], "Magnite")}
    key = (D[0], "Magnite")
    for other in ([report(1)], [*a, report(1)], [report(1, revenue=1.5), a[1]], [report(1, geo=None, unit="US"), a[1]],
                  [report(1, geo="US", unit=None), report(1, org="org_1", impressions=None)], [report(1), report(1)]):
        assert d(other).get(key) != d(a)[key]


def test_pending_reasons(spark):
    rows = [report(1), report(2), report(3, "Triplelift")]
    led = empty(spark)
    assert [r[2] for r in found(spark, rows, led, {})] == ["new"] * 3
    pairs = ledger.pending(reports(spark, rows), led, {})
    decided = ledger.outcomes(pairs, ssot_rows(spark, [fact(1, network="Magnite")]), ssot_rows(spark, [fact(1, network="Magnite"), fact(2, network="Magnite")]))
    led = ledger.updated(led, decided, {"2024-01-01": "a", "2024-01-02": "b"}, RUN_TS)
    assert {(r["report_date"].day, r["outcome"], r["traffic"]) for r in led.collect()} == {(1, "allocated", "a"), (2, "unmatched", "b"), (3, "waiting", None)}
    same = {"2024-01-01": "a", "2024-01-02": "b"}
    assert found(spark, rows, led, same) == []                                       # nothing is tried again
    assert found(spark, rows, led, {**same, "2024-01-01": "c"}) == []                # allocated: traffic does not matter
    assert found(spark, rows, led, {**same, "2024-01-02": "c", "2024-01-03": "c"}) == [(2, "Magnite", "traffic"), (3, "Triplelift", "traffic")]
    late = [*rows, report(1, "Triplelift"), report(1, revenue=9.0)]
    assert found(spark, late, led, same) == [(1, "Magnite", "restated"), (1, "Triplelift", "new")]
    assert found(spark, rows[1:], led, same) == [(1, "Magnite", "withdrawn")]
    gone = ledger.updated(led, ledger.outcomes(ledger.pending(reports(spark, rows[1:]), led, same), None, None), same, RUN_TS)
    assert found(spark, rows[1:], gone, same) == [] and found(spark, rows, gone, same) == [(1, "Magnite", "restated")]


@pytest.fixture(scope="module")
def inputs(spark):
    return derived_inputs(spark, "/root/testdata/sf0.001")


def partner_rows(spark, path):
    df = versions.read(spark, path).where("network in ('Magnite', 'Triplelift', 'IndexExchange')")
    return {tuple(str(r[k]) for k in ("event_date", "event_hour", "organization_id", "network", "adunit", "media_type", "domain", "line_item",
                                      "ad_deal_type", "demand_owner", "country")): r for r in df.collect()}


def test_runs_without_news_rewrite_nothing_and_read_few_dates(spark, inputs, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    opts = Options(run_ts=RUN_TS, catch_up=True)
    sources = ("events_stream", "demand_partner")
    run_all(spark, inputs, path, opts, sources=sources)
    first = versions.load(spark, path)
    run_all(spark, inputs, path, opts, sources=("demand_partner",))
    assert versions.load(spark, path).number == first.number                       # no report is tried again
    late = reports(spark, [report(12, geo="us", revenue=50.0)])
    plans = []
    keep = jobs.allocation.ssot_slice

    def seen(ssot, dates, **kw):
        out = keep(ssot, dates, **kw)
        plans.append((list(dates), out._jdf.queryExecution().sparkPlan().toString(), len(out.inputFiles())))
        return out
    monkeypatch.setattr(jobs.allocation, "ssot_slice", seen)
    old = inputs["fact_demand_partner_reports"]
    run_all(spark, {**inputs, "fact_demand_partner_reports": old.where("not (partner_name = 'Magnite' and report_date = '2024-01-12')").unionByName(late)},
            path, opts, sources=("demand_partner",))
    assert [d for d, _, _ in plans] == [[D[11]]] and "PartitionFilters" in plans[0][1] and "2024-01-12" in plans[0][1]
    last = versions.load(spark, path)
    changed = {d for d in last.dates if last.dates[d] != first.dates.get(d)}
    assert changed == {"2024-01-12"}


def test_restated_and_withdrawn_reports_reset_their_rows(spark, inputs, tmp_path):
    path = str(tmp_path / "fact")
    opts = Options(run_ts=RUN_TS, catch_up=True)
    run_all(spark, inputs, path, opts, sources=("events_stream", "demand_partner"))
    one = partner_rows(spark, path)
    old = inputs["fact_demand_partner_reports"]
    gone = old.where("not (partner_name = 'Magnite' and report_date = '2024-01-05')")
    run_all(spark, {**inputs, "fact_demand_partner_reports": gone}, path, opts, sources=("demand_partner",))
    two = partner_rows(spark, path)
    assert one.keys() == two.keys()
    here = [k for k in one if k[0] == "2024-01-05" and k[3] == "Magnite"]
    assert any(one[k]["actual_revenue"] is not None for k in here)
    assert all(two[k][c] is None for k in here for c in ("actual_revenue", "reconciled_event_count", "max_demand_partner_date"))
    assert all(two[k]["tracked_event_count"] == one[k]["tracked_event_count"] for k in one)
    assert all(one[k] == two[k] for k in one if k not in here)
    run_all(spark, inputs, path, opts, sources=("demand_partner",))
    three = partner_rows(spark, path)
    assert all(three[k]["actual_revenue"] == one[k]["actual_revenue"] for k in one)


def test_traffic_that_comes_later_is_allocated_then(spark, inputs, tmp_path):
    """A report more than a lookback behind the watermark whose traffic comes at last."""
    path = str(tmp_path / "fact")
    opts = Options(run_ts=RUN_TS, catch_up=True)
    day = F.to_date("timestamp")
    early = {**inputs, "events_stream": inputs["events_stream"].where(day > F.lit(D[2]))}
    run_all(spark, early, path, opts, sources=("events_stream", "demand_partner"))
    led = versions.read_side(spark, path, ledger.LEDGER, ledger.LEDGER_SCHEMA)
    assert {r["outcome"] for r in led.where("report_date <= '2024-01-03'").collect()} == {"waiting"}
    before = versions.load(spark, path).number
    run_all(spark, early, path, opts, sources=("demand_partner",))
    assert versions.load(spark, path).number == before
    # the missing days' traffic is merged by hand, as a late load would
    from tallyhour.operators import grouping, pull
    commit = versions.begin(spark, path)
    grouped = grouping.group_events(pull.pull_events(inputs["events_stream"].where(day <= F.lit(D[2])), None, span=None), inputs["dim_line_items_mapping"])
    res = merge.merge_into(versions.read(spark, path), grouped, merge.events_spec(RUN_TS))
    commit.write(res.merged, res.dates, traffic=True)
    commit.switch()
    run_all(spark, inputs, path, opts, sources=("demand_partner",))
    whole = str(tmp_path / "whole")
    run_all(spark, inputs, whole, opts, sources=("events_stream", "demand_partner"))
    a, b = partner_rows(spark, path), partner_rows(spark, whole)
    assert {k: (r["actual_revenue"], r["reconciled_event_count"]) for k, r in a.items()} == {
        k: (r["actual_revenue"], r["reconciled_event_count"]) for k, r in b.items()}


def test_a_table_from_before_the_ledger_is_not_allocated_again(spark, inputs, tmp_path):
    path = str(tmp_path / "fact")
    opts = Options(run_ts=RUN_TS, catch_up=True, dp_ledger=False)
    run_all(spark, inputs, path, opts, sources=("events_stream", "demand_partner"))
    v = versions.load(spark, path)
    assert ledger.LEDGER not in v.side
    run_all(spark, inputs, path, opts.with_(dp_ledger=True), sources=("demand_partner",))
    assert versions.load(spark, path).dates == v.dates
