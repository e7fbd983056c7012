import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from helpers import RUN_TS, fact, ssot_rows
from tallyhour.operators import dq, merge
from tallyhour.operators.mapping import DimensionKeyError, map_advertiser
from tallyhour.operators.watermark import watermark_value
from tallyhour.plans.jobs import Options, _merge
from tallyhour.schemas import SSOT_SCHEMA
from tallyhour.session import checkpoint_dir, ensure_checkpoint_dir, run_scratch, scratch_path
from tallyhour.sources import staging


def rows(df):
    return sorted(map(str, df.collect()))


def test_staging_replaces_the_whole_table(spark, tmp_path):
    days = spark.range(3).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("event_date"), "id")
    path = str(tmp_path / "s")
    staging.write_staging(days, path, partition_cols=["event_date"])
    left = staging.write_staging(days.where("id = 2"), path, partition_cols=["event_date"])
    assert left.count() == 1


def ssp_source(spark, day, network="MinuteSSP", org="org_new"):
    s = spark.createDataFrame([tuple([None] * 18)], spark.createDataFrame([], SSOT_SCHEMA).select(
        *[f.name for f in SSOT_SCHEMA.fields][:17], "max_ssp_date").schema)
    return s.select(*[F.lit(v).cast(s.schema[c].dataType).alias(c) for c, v in {
        **{c: None for c in s.columns}, "event_date": day, "event_hour": dt.datetime(day.year, day.month, day.day), "event": "served",
        "organization_id": org, "network": network, "reconciled_event_count": 5, "actual_revenue": 1.0, "max_ssp_date": day}.items()])


def test_pruned_merge_keeps_rows_of_rewritten_dates(spark):
    old = ssot_rows(spark, [fact(1, network="GAM", tracked_event_count=7), fact(1, network="Magnite", tracked_event_count=3), fact(9, network="GAM")])
    spec = merge.ssp_spec(RUN_TS, dt.date(2024, 1, 9))
    res = merge.merge_into(old, ssp_source(spark, dt.date(2024, 1, 1)), spec)
    assert res.dates == [dt.date(2024, 1, 1)]
    assert res.merged.count() == 3  # both old rows of the rewritten day and the new one
    assert res.table.count() == 4
    merge.check_no_loss(old, res.merged, res.dates)


def test_a_loss_is_seen(spark):
    old = ssot_rows(spark, [fact(1, network="GAM"), fact(1, network="Magnite"), fact(2)])
    with pytest.raises(merge.MergeLossError, match="2024-01-01: 2 -> 1"):
        merge.check_no_loss(old, old.where("network = 'GAM'"), [dt.date(2024, 1, 1)])


def test_rows_without_a_date_are_merged_like_others(spark):
    old = ssot_rows(spark, [fact(1), {"organization_id": "a", "event": "served", "tracked_event_count": 1}])
    src = ssot_rows(spark, [{"organization_id": "a", "event": "served", "tracked_event_count": 2},
                            {"organization_id": "b", "event": "served", "tracked_event_count": 3}])
    res = merge.merge_into(old, src, merge.events_spec(RUN_TS))
    assert res.dates == [None]
    assert sorted(r["tracked_event_count"] for r in res.merged.collect()) == [2, 3]
    assert res.table.count() == 3


def test_init_never_overwrites(spark, tmp_path):
    path = str(tmp_path / "fact")
    staging.init_ssot(spark, path)
    staging.write_ssot_partitions(ssot_rows(spark, [fact(1), fact(2)]), path)
    part = os.path.join(path, "event_date=2024-01-01")
    with open(os.path.join(part, "part-broken.parquet"), "wb") as f:
        f.write(b"not a parquet file")
    staging.init_ssot(spark, path)
    os.remove(os.path.join(part, "part-broken.parquet"))
    assert staging.read_ssot(spark, path).count() == 2
    assert staging.partition_dates(spark, path) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]


def test_dimensions_are_checked_at_every_run(spark, tmp_path):
    path = str(tmp_path / "dim")
    facts = spark.createDataFrame([("1",)], "line_item string")
    spark.createDataFrame([("1", "a")], "line_item_id string, advertiser_name string").write.parquet(path)
    assert map_advertiser(facts, spark.read.parquet(path)).count() == 1
    spark.createDataFrame([("1", "a"), ("1", "b")], "line_item_id string, advertiser_name string").write.mode("overwrite").parquet(path)
    with pytest.raises(DimensionKeyError):
        map_advertiser(facts, spark.read.parquet(path))


def test_watermark_reads_newest_partitions_first(spark):
    ssot = ssot_rows(spark, [fact(d, max_events_stream_timestamp=dt.datetime(2024, 1, d, 3, 20) if d < 7 else None) for d in range(1, 10)])
    days = [dt.date(2024, 1, d) for d in range(1, 10)]
    assert watermark_value(ssot, "events_stream", dates=days) == watermark_value(ssot, "events_stream") == dt.datetime(2024, 1, 6, 3)
    assert watermark_value(ssot, "events_stream", dates=days, trunc=False) == dt.datetime(2024, 1, 6, 3, 20)
    assert watermark_value(ssot, "gam", dates=days) == dt.datetime(1970, 1, 1)
    assert watermark_value(ssot, "gam", dates=days, use_default=False) is None


def test_progress_is_kept_beside_the_table(spark, tmp_path):
    path = str(tmp_path / "fact")
    assert staging.read_progress(spark, path) == {}
    staging.write_progress(spark, path, {"gam": dt.date(2024, 1, 2)}, RUN_TS)
    staging.write_progress(spark, path, {"gam": dt.date(2024, 1, 1)}, RUN_TS)
    assert staging.read_progress(spark, path) == {"gam": dt.date(2024, 1, 2)}


def test_scratch_of_a_run_is_removed(spark):
    with run_scratch(spark) as folder:
        path = scratch_path(spark, "t")
        assert path.startswith(folder)
        spark.range(1).write.parquet(path)
        assert staging.path_exists(spark, path)
    assert not staging.path_exists(spark, folder)
    assert not scratch_path(spark, "t").startswith(folder)
    assert checkpoint_dir(spark)


def test_no_shared_folder_on_a_cluster_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_grouped_sources_are_not_tested_for_duplicates(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(merge, "source_profile", lambda *a: calls.append(a))
    old, src = ssot_rows(spark, [fact(1)]), ssot_rows(spark, [fact(1, tracked_event_count=4), fact(2)])
    opts = Options(run_ts=RUN_TS, materialize=True)
    res = _merge(old, src, merge.events_spec(RUN_TS), opts, unique=True)
    assert not calls and res.dates == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)] and res.table.count() == 2


def test_checks_scan_the_fact_table_four_times_and_prune(spark, tmp_path):
    path = str(tmp_path / "fact")
    staging.write_ssot_partitions(ssot_rows(spark, [fact(d, network="MinuteSSP", actual_revenue=1.0) for d in range(1, 9)]), path)
    ssot = staging.read_ssot(spark, path)
    day = dt.date(2024, 1, 3)
    exploded = ssot_rows(spark, [fact(3, network="MinuteSSP", actual_revenue=1.0)])
    grouped = spark.createDataFrame([(day, 1.0)], "event_date date, total_gam_revenue double")
    partner = grouped.withColumnRenamed("total_gam_revenue", "total_demand_partner_revenue_usd")
    staged = {"ssp": {"exploded": exploded}, "syndication": {"exploded": exploded}, "gam": {"grouped": grouped, "allocated": grouped},
              "demand_partner": {"grouped": partner, "allocated": partner}}
    report = dq.run_checks(ssot, staged, null_mode="null_safe", bounding_mode="bounded", dates=[day])
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    physical = report._jdf.queryExecution().sparkPlan().toString()
    scans = [x for x in physical.split("\n") if "FileScan parquet" in x]
    assert len(scans) == 4, plan
    assert all("PartitionFilters: [" in x and "2024-01-03" in x for x in scans)
    assert {r["name"]: r["status"] for r in report.collect()} == {
        "ssot_grain_uniqueness": "PASS", "ssot_required_fields": "PASS", "ssot_no_negatives": "PASS", "ssp_revenue_conservation": "PASS",
        "syndication_revenue_conservation": "PASS", "gam_revenue_bounding": "PASS", "demand_partner_revenue_bounding": "PASS"}
