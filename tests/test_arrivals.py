import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from helpers import RUN_TS
from tallyhour.plans.jobs import Options, consolidate, run_all
from tallyhour.sources import arrivals, versions
from tallyhour.sources.fixtures import derived_inputs
from tallyhour.sources.tables import empty_ssot
from tallyhour.streaming.events_state import drain, stateful_query

SF = "/root/testdata/sf0.001"
AUDIT = ["dwh_created_at", "dwh_updated_at"]


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def inputs(spark):
    return derived_inputs(spark, SF)


@pytest.fixture(scope="module")
def whole(spark, inputs):
    return consolidate(inputs, empty_ssot(spark), Options(run_ts=RUN_TS, catch_up=True), sources=("events_stream",)).ssot


def test_hours_become_ranges(spark):
    hours = [dt.datetime(2024, 1, 1, x) for x in (5, 3, 4, 9)]
    ts = F.timestamp_add("MINUTE", (F.col("id") * 30).cast("int"), F.lit(dt.datetime(2024, 1, 1)))
    day = spark.range(48).select(ts.cast("timestamp_ntz").alias("t"))
    cond = arrivals.in_hours("t", hours)
    assert sorted(r["t"].hour for r in day.where(cond).collect()) == [3, 3, 4, 4, 5, 5, 9, 9]
    assert day.where(arrivals.in_hours("t", [])).count() == 0
    assert day.where(cond)._jdf.queryExecution().optimizedPlan().toString().count(">=") == 2


def test_late_files_reopen_their_hours_and_nothing_else(spark, inputs, whole, tmp_path):
    raw, path = str(tmp_path / "raw"), str(tmp_path / "fact")
    ev = inputs["events_stream"]
    late = F.to_date("timestamp").isin(dt.date(2024, 1, 4), dt.date(2024, 1, 5)) & (F.hour("timestamp") == 2)
    ev.where(~late).repartition(3).write.parquet(raw)
    opts = Options(run_ts=RUN_TS, catch_up=True, track_files=True)

    def run():
        source = spark.read.schema(ev.schema).parquet(raw)
        run_all(spark, {**inputs, "events_stream": source}, path, opts, sources=("events_stream",))
        return versions.load(spark, path)
    one = run()
    assert versions.read_side(spark, path, arrivals.FILES, arrivals.FILES_SCHEMA).count() == 3
    two = run()                                             # no new file: only the open hour is read again
    assert {d for d in two.dates if two.dates[d] != one.dates[d]} <= {max(one.dates)}
    ev.where(late).coalesce(1).write.mode("append").parquet(raw)
    three = run()
    changed = {d for d in three.dates if three.dates[d] != two.dates.get(d)}
    assert changed - {max(three.dates)} == {"2024-01-04", "2024-01-05"}
    assert versions.read_side(spark, path, arrivals.FILES, arrivals.FILES_SCHEMA).count() == 4
    assert rows(versions.read(spark, path).drop(*AUDIT)) == rows(whole.drop(*AUDIT))


def test_files_before_the_manifest_count_as_read(spark, inputs, tmp_path):
    raw, path = str(tmp_path / "raw"), str(tmp_path / "fact")
    ev = inputs["events_stream"]
    ev.coalesce(2).write.parquet(raw)
    source = {**inputs, "events_stream": spark.read.schema(ev.schema).parquet(raw)}
    opts = Options(run_ts=RUN_TS, catch_up=True)
    run_all(spark, source, path, opts, sources=("events_stream",))
    before = versions.load(spark, path)
    run_all(spark, source, path, opts.with_(track_files=True), sources=("events_stream",))
    after = versions.load(spark, path)
    assert {d for d in after.dates if after.dates[d] != before.dates[d]} <= {max(before.dates)}
    assert arrivals.FILES in after.side


def land(events, landing, lo, hi, by):
    events.where((by >= F.lit(lo)) & (by < F.lit(hi))).coalesce(1).write.mode("append").parquet(landing)


def test_stateful_stream_with_late_files_and_restart(spark, inputs, whole, tmp_path):
    landing, path, ckpt = (str(tmp_path / x) for x in ("landing", "fact", "ckpt"))
    ev = inputs["events_stream"]
    arrival = F.when(F.col("organizationId") == "org_1", F.date_add(F.to_date("timestamp"), 2)).otherwise(F.to_date("timestamp"))
    steps = [dt.date(2024, 1, d) for d in (1, 11, 21, 31)] + [dt.date(2024, 3, 1)]

    def start():
        drain(stateful_query(spark, landing, inputs["dim_line_items_mapping"], path, ckpt, run_ts=RUN_TS, late="12 days", max_files_per_trigger=1))
    land(ev, landing, steps[0], steps[1], arrival)
    land(ev, landing, steps[1], steps[2], arrival)
    start()
    half = versions.load(spark, path).number
    start()                                                  # nothing new: nothing is committed
    assert versions.load(spark, path).number == half
    land(ev, landing, steps[2], steps[3], arrival)
    land(ev, landing, steps[3], steps[4], arrival)
    start()
    assert rows(versions.read(spark, path)) == rows(whole)
    history = [v.info["source"] for v in versions.history(spark, path)]
    assert history.count("events_stream") >= 4


def test_a_batch_that_runs_again_is_merged_once(spark, inputs, tmp_path):
    landing, path, ckpt = (str(tmp_path / x) for x in ("landing", "fact", "ckpt"))
    ev = inputs["events_stream"]
    ev.coalesce(1).write.parquet(landing)
    args = (spark, landing, inputs["dim_line_items_mapping"], path, ckpt)
    drain(stateful_query(*args, run_ts=RUN_TS))
    one = versions.load(spark, path)
    commits = os.path.join(ckpt, "commits")
    for name in os.listdir(commits):                         # the driver died after the merge, before the stream's own commit
        if name.strip(".").split(".")[0] == "0":
            os.remove(os.path.join(commits, name))
    drain(stateful_query(*args, run_ts=RUN_TS + dt.timedelta(hours=1)))
    assert versions.load(spark, path).dates == one.dates


def test_events_past_the_late_rule_are_left_out(spark, inputs, tmp_path):
    landing, path, ckpt = (str(tmp_path / x) for x in ("landing", "fact", "ckpt"))
    ev, day = inputs["events_stream"], F.to_date("timestamp")
    land(ev, landing, dt.date(2024, 1, 20), dt.date(2024, 3, 1), day)
    start = lambda: drain(stateful_query(spark, landing, inputs["dim_line_items_mapping"], path, ckpt, run_ts=RUN_TS, late="1 day"))
    start()
    land(ev, landing, dt.date(2024, 1, 1), dt.date(2024, 1, 5), day)
    start()
    assert versions.read(spark, path).where("event_date < '2024-01-05'").count() == 0
