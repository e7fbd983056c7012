"""Events as a live source.

Raw event files landing in a folder are read with ``readStream``; each
micro-batch names the hours it touched, those hours are recomputed in full
from the landing table (the batch form of the hourly watermark: an hour is
always rebuilt from all its events, so hours split across batches come out
right) and merged into the fact table, rewriting only touched partitions.
Progress is tracked by the stream checkpoint, so a restarted query resumes.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhour.functions.exprs import hour_of
from tallyhour.operators import grouping, merge, pull
from tallyhour.schemas import EVENTS_STREAM_SCHEMA
from tallyhour.session import run_scratch, scratch_path
from tallyhour.sources import versions
from tallyhour.sources.staging import read_ssot, stage_table

#: Name of the stream's progress in the table's versions.
BATCH = "events_stream_batch"


def commit_batch(spark: SparkSession, ssot_path: str, batch_id: int, query: str, grouped: DataFrame, run_ts,
                 null_mode: str, owner_actual: str) -> None:
    """Merge hourly groups (full values of their hours) and the batch's number in one commit, once."""
    version = versions.load(spark, ssot_path)
    done = version.progress.get(BATCH, "").rpartition(":")
    if done[0] == query and batch_id <= int(done[2]):
        return
    stamp = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    spec = merge.events_spec(stamp, null_mode=null_mode, owner_actual=owner_actual)
    dates = sorted((r[0] for r in grouped.select("event_date").distinct().collect()), key=lambda d: (d is None, d))
    commit = versions.begin(spark, ssot_path, version)
    # the batch is grouped by the merge's own key, so no key can match twice under null-safe equality
    observed = Observation(f"stream-{batch_id}")
    res = merge.merge_into(versions.read(spark, ssot_path, version), grouped, spec, dates=dates,
                           check_cardinality=null_mode != "null_safe", observation=observed)
    counts = {}
    if res.merged is not None:
        after = commit.write(res.merged, res.dates, traffic=True)
        counts = dict(observed.get)
        merge.check_counts({k: version.rows.get(k, 0) for k in after}, after, counts)
    commit.progress[BATCH] = f"{query}:{batch_id}"
    commit.info = {"source": "events_stream", "run_ts": stamp.isoformat(), **counts}
    commit.switch()


def _hour_batch(spark: SparkSession, landing: str, line_item_dim: DataFrame, ssot_path: str, query: str, run_ts,
                null_mode: str, owner_actual: str):
    def handle(batch: DataFrame, batch_id: int) -> None:
        hours = [r[0] for r in batch.select(hour_of("timestamp").alias("h")).distinct().collect()
                 if r[0] is not None]
        if not hours:
            return
        lo, hi = min(hours), max(hours) + _dt.timedelta(hours=1)
        raw = spark.read.schema(EVENTS_STREAM_SCHEMA).parquet(landing)
        # range bound for file/row-group skipping, exact hour set for correctness
        raw = raw.where((F.col("timestamp") >= F.lit(lo)) & (F.col("timestamp") < F.lit(hi))
                        & hour_of("timestamp").isin(hours))
        with run_scratch(spark):
            # staged once: the merge reads its keys and dates, and joins it
            grouped = stage_table(grouping.group_events(pull.pull_events(raw, None, span=None), line_item_dim), "grouped")
            commit_batch(spark, ssot_path, batch_id, query, grouped, run_ts, null_mode, owner_actual)
    return handle


def events_stream_query(spark: SparkSession, landing: str, line_item_dim: DataFrame, ssot_path: str,
                        checkpoint: str, *, run_ts=None, null_mode: str = "null_safe", owner_actual: str = "coalesce",
                        max_files_per_trigger: int | None = None, available_now: bool = True):
    """Start the streaming load; returns the ``StreamingQuery``. Without ``run_ts`` every batch is stamped
    with its own time."""
    versions.create(spark, ssot_path)
    reader = spark.readStream.schema(EVENTS_STREAM_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing)
    w = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(_hour_batch(spark, landing, line_item_dim, ssot_path, checkpoint, run_ts, null_mode,
                                    owner_actual)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def run_available_now(spark: SparkSession, inputs: dict, *, run_ts, files: int | None = None, max_files_per_trigger: int = 2,
                      **rules) -> DataFrame:
    """Land the raw events as files, drain them with an AvailableNow stream, return the fact table."""
    landing = scratch_path(spark, "events_landing")
    ssot_path = scratch_path(spark, "ssot_stream")
    ckpt = scratch_path(spark, "events_stream_ckpt")
    ev = inputs["events_stream"]
    # days kept together, in as many files as Spark's shuffle settings and the data give (or ``files``)
    day = F.to_date("timestamp")
    (ev.repartition(files, day) if files else ev.repartition(day)).write.mode("overwrite").parquet(landing)
    q = events_stream_query(spark, landing, inputs["dim_line_items_mapping"], ssot_path, ckpt, run_ts=run_ts,
                            max_files_per_trigger=max_files_per_trigger, **rules)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return read_ssot(spark, ssot_path)
