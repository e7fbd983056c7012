import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import RUN_TS, fact, ssot_rows
from tallyhour.operators import merge
from tallyhour.plans.jobs import Options, run_all
from tallyhour.plans.scenarios import CUTOFF, Killed, before
from tallyhour.sources import staging, versions
from tallyhour.sources.fixtures import derived_inputs

D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def put(spark, path, rows, dates, **info):
    commit = versions.begin(spark, path)
    commit.write(ssot_rows(spark, rows), dates)
    commit.info = info
    return commit.switch()


def hours(df):
    return sorted((r["event_date"], r["event_hour"].hour, r["tracked_event_count"]) for r in df.collect())


@pytest.fixture
def path(spark, tmp_path):
    p = str(tmp_path / "fact")
    versions.create(spark, p)
    put(spark, p, [fact(1, 0, tracked_event_count=1), fact(2, 0, tracked_event_count=2)], [D1, D2])
    return p


def test_a_commit_replaces_its_dates_only(spark, path):
    v = put(spark, path, [fact(2, 5, tracked_event_count=9), fact(3, 1, tracked_event_count=3)], [D2, D3], source="x")
    assert hours(versions.read(spark, path)) == [(D1, 0, 1), (D2, 5, 9), (D3, 1, 3)]
    assert hours(staging.read_ssot(spark, path)) == hours(versions.read(spark, path))
    assert v.number == 3 and dict(v.rows) == {"2024-01-01": 1, "2024-01-02": 1, "2024-01-03": 1}
    assert hours(versions.read(spark, path, 2)) == [(D1, 0, 1), (D2, 0, 2)]      # the version before stays readable
    assert hours(versions.read(spark, path, dates=[D3])) == [(D3, 1, 3)]
    assert staging.partition_dates(spark, path) == [D1, D2, D3]
    with pytest.raises(versions.UnknownVersion):
        versions.load(spark, path, 17)


def test_a_date_without_rows_leaves_and_null_dates_stay(spark, path):
    put(spark, path, [fact(1, 3), {"event": "served", "organization_id": "o"}], [D1, D2, None])
    v = versions.load(spark, path)
    assert sorted(v.dates) == ["2024-01-01", versions.NO_DATE] and versions.dates_of(v) == [D1]
    rows = versions.read(spark, path).collect()
    assert sorted(str(r["event_date"]) for r in rows) == ["2024-01-01", "None"]


def test_killed_between_two_dates(spark, path):
    """A run that ends while files of some dates are there and others not changes nothing."""
    old = hours(versions.read(spark, path))
    commit = versions.begin(spark, path)
    commit.write(ssot_rows(spark, [fact(1, 7)]), [D1])      # the second date is never written, nor is the version
    data = os.path.join(path, "data", "event_date=2024-01-02", f"version={commit.label}")
    os.makedirs(data)
    with open(os.path.join(data, "part-0.parquet"), "wb") as f:
        f.write(b"torn")
    with open(os.path.join(path, "versions", f".{commit.label}"), "w") as f:
        f.write('{"number": 3, "dates": {"2024')
    assert hours(versions.read(spark, path)) == old
    assert versions.expire(spark, path, keep=1) == []        # it could still be under way
    put(spark, path, [fact(3, 1, tracked_event_count=3)], [D3])
    assert hours(versions.read(spark, path)) == [*old, (D3, 1, 3)]
    dropped = versions.expire(spark, path, keep=1)
    assert dropped == [f"event_date=2024-01-01/version={commit.label}", f"event_date=2024-01-02/version={commit.label}"]
    assert hours(versions.read(spark, path)) == [*old, (D3, 1, 3)]


def test_of_two_writers_one_wins(spark, path):
    a, b = versions.begin(spark, path), versions.begin(spark, path)
    a.write(ssot_rows(spark, [fact(3, 1, tracked_event_count=1)]), [D3])
    b.write(ssot_rows(spark, [fact(3, 2, tracked_event_count=2)]), [D3])
    a.switch()
    with pytest.raises(versions.VersionConflict):
        b.switch()
    assert hours(versions.read(spark, path))[-1] == (D3, 1, 1)


def test_expiry_keeps_what_kept_versions_name(spark, path):
    for n in range(4):
        put(spark, path, [fact(2, n, tracked_event_count=n)], [D2])
    assert len(versions.history(spark, path)) == 6
    versions.expire(spark, path, keep=2)
    assert [v.number for v in versions.history(spark, path)] == [5, 6]
    assert hours(versions.read(spark, path, 5)) == [(D1, 0, 1), (D2, 2, 2)]
    assert hours(versions.read(spark, path)) == [(D1, 0, 1), (D2, 3, 3)]
    assert len(os.listdir(os.path.join(path, "data", "event_date=2024-01-02"))) == 2
    with pytest.raises(ValueError):
        versions.expire(spark, path, keep=0)


def test_scan_is_pruned_to_the_dates_asked_for(spark, path):
    df = versions.read(spark, path).where(F.col("event_date") == F.lit(D2))
    assert df.inputFiles() and len(versions.read(spark, path).inputFiles()) == 2
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_a_table_written_in_place_is_taken_over(spark, tmp_path):
    p = str(tmp_path / "old")
    staging.init_ssot(spark, p)
    staging.write_ssot_partitions(ssot_rows(spark, [fact(1, 4, tracked_event_count=5), fact(2)]), p)
    staging.write_progress(spark, p, {"gam": D2}, RUN_TS)
    old = hours(staging.read_ssot(spark, p).where("tracked_event_count is not null"))
    v = versions.create(spark, p)
    assert hours(versions.read(spark, p).where("tracked_event_count is not null")) == old == [(D1, 4, 5)]
    assert dict(v.progress) == {"gam": "2024-01-02"} and versions.create(spark, p).number == v.number


def test_side_tables_belong_to_a_version(spark, path):
    assert versions.read_side(spark, path, "t", "x long").count() == 0
    for n in (3, 4):
        commit = versions.begin(spark, path)
        commit.write_side("t", spark.range(n).withColumnRenamed("id", "x"))
        last = commit.switch()
    assert versions.read_side(spark, path, "t", "x long").count() == 4
    assert versions.read_side(spark, path, "t", "x long", versions.load(spark, path, last.number - 1)).count() == 3
    versions.expire(spark, path, keep=1)
    assert versions.read_side(spark, path, "t", "x long").count() == 4
    with open(os.path.join(path, "versions", f"{last.number:012d}.json")) as f:
        assert json.load(f)["side"] == dict(last.side)


def test_run_killed_at_any_switch_recovers(spark, tmp_path):
    """Killed before the switch of each job in turn: the table is that of the last switch, and the next run ends it."""
    inputs = derived_inputs(spark, "/root/testdata/sf0.001")
    opts = Options(run_ts=RUN_TS, catch_up=True)
    whole, killed = str(tmp_path / "whole"), str(tmp_path / "killed")
    for p in (whole, killed):
        run_all(spark, before(inputs, CUTOFF), p, opts)
    later = opts.with_(run_ts=RUN_TS + dt.timedelta(days=1))
    run_all(spark, inputs, whole, later)
    for victim in ("ssp", "gam"):
        seen = []

        def kill(source, commit):
            seen.append((source, versions.load(spark, killed).number))
            if source == victim:
                raise Killed(source)
        with pytest.raises(Killed):
            run_all(spark, inputs, killed, later, on_commit=kill)
        assert seen[-1][0] == victim and versions.load(spark, killed).number == seen[-1][1]
    run_all(spark, inputs, killed, later)
    shown = lambda p: sorted(map(repr, staging.read_ssot(spark, p).collect()))
    assert shown(killed) == shown(whole)


def test_counts_that_do_not_add_up_end_the_run():
    day = "2024-01-01"
    merge.check_counts({day: 5}, {day: 7}, {"inserted": 2, "deleted": 0})
    merge.check_counts({day: 5}, {day: 7}, {"inserted": 9, "deleted": 0})       # a stage ran twice
    for after, observed in (({day: 4}, {"inserted": 2, "deleted": 0}), ({day: 5}, {"inserted": 0, "deleted": 1}), ({}, {"inserted": 1, "deleted": 0})):
        with pytest.raises(merge.MergeLossError):
            merge.check_counts({day: 5}, after, observed)
