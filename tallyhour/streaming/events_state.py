"""Events as a stream with keyed state.

Where ``events_stream`` recomputes every touched hour from the landing table, this query
keeps the hourly aggregates themselves in the state store, one row per hour and grain key:
each micro-batch adds its events and hands on the changed groups with their full values,
which are merged as one versioned commit. Nothing is read twice, so that a batch costs what
its events and changed groups cost, however large the landing folder is.

Late-data rule: an hour takes events until the newest event seen is ``late`` past its end;
then its state is dropped, and still later events are left out by the watermark and counted by
Spark (``numRowsDroppedByWatermark``); the batch job's file manifest reopens such hours
(``sources.arrivals``). A query restarted from its checkpoint goes on from its state; a batch
that runs again after a loss is merged once (``events_stream.commit_batch``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhour.functions.exprs import sum_where
from tallyhour.operators import pull
from tallyhour.operators.grouping import EVENT_GROUP_KEYS
from tallyhour.operators.mapping import map_advertiser
from tallyhour.schemas import EVENTS_STREAM_SCHEMA
from tallyhour.session import run_scratch
from tallyhour.sources import versions
from tallyhour.sources.staging import stage_table
from tallyhour.streaming.events_stream import commit_batch

#: How long an hour takes events after its end.
LATE = "5 days"


def hourly_state(events: DataFrame, late: str = LATE) -> DataFrame:
    """Stateful hourly aggregates of a stream of raw events, without the advertiser (a batch lookup)."""
    pulled = pull.pull_events(events, None, span=None)
    timed = pulled.withColumn("_at", F.col("timestamp").cast("timestamp_ltz")).withWatermark("_at", late)
    return timed.groupBy(F.window("_at", "1 hour"), *EVENT_GROUP_KEYS).agg(
        F.count(F.lit(1)).alias("tracked_event_count"),
        sum_where(F.col("is_actual_revenue") == 1, "revenue").alias("actual_revenue"),
        sum_where(F.col("is_actual_revenue") == 0, "revenue").alias("estimated_revenue"),
        F.max("timestamp").alias("max_events_stream_timestamp")).drop("window")


def stateful_query(spark: SparkSession, landing: str, line_item_dim: DataFrame, ssot_path: str, checkpoint: str, *, run_ts=None,
                   null_mode: str = "null_safe", owner_actual: str = "coalesce", late: str = LATE,
                   max_files_per_trigger: int | None = None, available_now: bool = True):
    """Start the stateful load; returns the ``StreamingQuery``."""
    versions.create(spark, ssot_path)
    reader = spark.readStream.schema(EVENTS_STREAM_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def handle(batch: DataFrame, batch_id: int) -> None:
        with run_scratch(spark):
            keys = [*EVENT_GROUP_KEYS, "advertiser"]
            grouped = stage_table(map_advertiser(batch, line_item_dim).select(
                *keys, "tracked_event_count", "actual_revenue", "estimated_revenue", "max_events_stream_timestamp"), "changed")
            commit_batch(spark, ssot_path, batch_id, checkpoint, grouped, run_ts, null_mode, owner_actual)

    w = (hourly_state(reader.parquet(landing), late).writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint).foreachBatch(handle))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def drain(query) -> None:
    """Wait for an AvailableNow query and raise what ended it."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
