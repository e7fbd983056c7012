"""Physical-plan properties that matter at scale."""

import contextlib
import datetime as dt
import io
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from tallyhour.operators import allocation, grouping, merge, pull
from tallyhour.plans.backfill import backfill
from tallyhour.sources.staging import read_ssot, write_ssot_partitions

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def b(spark):
    return backfill(spark, SF, "parity")


def test_events_pull_prunes_and_pushes(spark, b):
    path = os.path.join(tempfile.mkdtemp(prefix="tallyhour-ev-"), "events_stream")
    b.inputs["events_stream"].withColumn("event_day", F.to_date("timestamp")).write.partitionBy("event_day").parquet(path)
    ev = spark.read.parquet(path)
    g = grouping.group_events(pull.pull_events(ev, dt.datetime(2024, 1, 10), bounds="exclusive",
                                               partition_col="event_day"), b.inputs["dim_line_items_mapping"])
    p = plan(g)
    assert "PartitionFilters: [isnotnull(event_day" in p and "event_day#" in p
    assert "GreaterThan(timestamp,2024-01-10T00:00)" in p and "LessThanOrEqual(timestamp,2024-01-15T00:00)" in p
    assert "event_day" not in p.split("ReadSchema:")[1].split("\n")[0]
    # one shuffle (the aggregate); the dimension is broadcast after it
    assert len(re.findall(r"^\(\d+\) Exchange$", p, flags=re.M)) == 1
    assert "BroadcastHashJoin" in p


def test_merge_reads_only_touched_partitions(spark, b):
    path = os.path.join(tempfile.mkdtemp(prefix="tallyhour-ssot-"), "ssot")
    write_ssot_partitions(b.final, path)
    ssot = read_ssot(spark, path)
    src = b.detail("events_stream")["grouped"].where(F.col("event_date").isin(dt.date(2024, 1, 3), dt.date(2024, 1, 9)))
    res = merge.merge_into(ssot, src, merge.events_spec(dt.datetime(2024, 2, 2)), check_cardinality=False)
    p = plan(res.merged)
    filt = [ln for ln in p.split("\n") if ln.startswith("PartitionFilters: ") and "event_date" in ln]
    assert filt and "2024-01-03" in filt[0] and "2024-01-09" in filt[0]
    assert "FullOuter" in p


def test_no_nested_loop_or_cartesian_joins(spark, b):
    gam, dp = b.detail("gam"), b.detail("demand_partner")
    plans = [
        allocation.gam_allocation(allocation.ssot_slice(b.stage("demand_partner"), gam["dates"], networks=["GAM"]),
                                  gam["grouped"], b.inputs["dim_ad_unit_mapping"]),
        allocation.demand_partner_allocation(dp["grouped"], dp["slice"], b.inputs["dim_ad_unit_mapping"]),
        allocation.demand_partner_allocation(dp["grouped"], dp["slice"], b.inputs["dim_ad_unit_mapping"],
                                             mode="per_row"),
        b.run.checks(b.opts),
    ]
    for df in plans:
        p = plan(df)
        assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_allocation_windows_only_over_group_level_rows(spark, b):
    """Windows in the allocation plans partition group-level rows (after an aggregate), never raw traffic."""
    gam = b.detail("gam")
    df = allocation.gam_allocation(allocation.ssot_slice(b.stage("demand_partner"), gam["dates"], networks=["GAM"]),
                                   gam["grouped"], b.inputs["dim_ad_unit_mapping"])
    jplan = df._jdf.queryExecution().optimizedPlan().toString()
    for block in jplan.split("Window [")[1:]:
        below = block.split("\n")
        # the first join/aggregate under the window must be the P-level aggregate
        nodes = [ln.strip(" +-:") for ln in below[1:] if ln.strip(" +-:")]
        first_heavy = next(n for n in nodes if n.startswith(("Join", "Aggregate")))
        assert first_heavy.startswith("Join") and any(n.startswith("Aggregate") for n in nodes[:8])
