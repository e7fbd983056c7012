"""Staging writes, fact-table partition writes and retention (K-01..K-05, R-01)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhour.schemas import SSOT_COLUMNS, SSOT_SCHEMA


def _layout(df: DataFrame, partition_cols: Sequence[str], cluster_cols: Sequence[str]) -> DataFrame:
    # REBALANCE lets AQE split a hot partition value over several tasks/files
    # instead of funnelling it into one, and merges tiny ones.
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
    if partition_cols or cluster_cols:
        df = df.sortWithinPartitions(*partition_cols, *cluster_cols)
    return df


# Staging-table layouts (partition column, cluster columns) of the pipeline stages.
STAGING_LAYOUT = {
    "events_stream_grouping": ("event_date", ["event_hour", "event", "organization_id", "adunit"]),
    "ssp_explode_data": ("event_date", ["event_hour", "event", "organization_id", "network"]),
    "syndication_explode_data": ("event_date", ["event_hour", "event", "organization_id", "network"]),
    "demand_partner_grouping": ("event_date", ["organization_id", "country", "adunit"]),
    "demand_partner_allocation": ("event_date", ["event_hour", "event", "organization_id", "country"]),
    "GAM_grouping": ("event_date", ["event_hour", "ad_unit_id", "line_item", "country"]),
    "GAM_allocation": ("event_date", ["event_hour", "event", "organization_id", "line_item"]),
}


def write_staging(df: DataFrame, path: str, *, partition_cols: Sequence[str] = (),
                  cluster_cols: Sequence[str] = (), partition_expr: dict | None = None) -> DataFrame:
    """K-01..K-04: replace a staging table (``CREATE OR REPLACE ... PARTITION BY ... CLUSTER BY``).

    ``partition_expr`` derives a partition column first (e.g. ``{"event_date": to_date(ts)}``).
    Clustering becomes a sort within each file, so parquet min/max statistics
    skip row groups for filters on the cluster columns. Returns the written table.
    """
    if partition_expr:
        df = df.withColumns(partition_expr)
        partition_cols = list(partition_cols) + [c for c in partition_expr if c not in partition_cols]
    # the session overwrites single partitions (dynamic mode); replacing a table drops all of them
    w = (_layout(df, partition_cols, cluster_cols).write.mode("overwrite")
         .option("partitionOverwriteMode", "static"))
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def write_named_staging(df: DataFrame, staging_dir: str, name: str) -> DataFrame:
    """K-01/K-02: replace staging table ``name`` under ``staging_dir`` with its declared layout."""
    import os
    part, cluster = STAGING_LAYOUT.get(name, (None, []))
    return write_staging(df, os.path.join(staging_dir, name), partition_cols=[part] if part else [],
                         cluster_cols=cluster)


def stage_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and read it back.

    One write job, lineage is cut, the files survive executor loss, and the
    re-read keeps parquet statistics, filter pushdown and column pruning for
    later stages. (A reliable checkpoint also cuts lineage, but computes its
    input twice unless that is cached, and keeps no statistics.)
    """
    from tallyhour.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Fixed value: cluster columns of the fact table.
SSOT_CLUSTER = ["organization_id", "network", "event", "country"]


def read_ssot(spark: SparkSession, path: str) -> DataFrame:
    """The fact table at ``path``: its newest version, or the files of a table written in place."""
    from tallyhour.sources import versions
    if versions.is_versioned(spark, path):
        return versions.read(spark, path)
    return spark.read.schema(SSOT_SCHEMA).parquet(path).select(*SSOT_COLUMNS)


def write_ssot_partitions(merged: DataFrame, path: str) -> None:
    """K-05 in place: persist the touched partitions of a merge (dynamic partition overwrite).

    For tables without versions; ``versions.Commit`` switches all partitions at once.

    ``merged`` must not depend on ``path`` any more: callers checkpoint it
    first, which also makes the write restartable after executor loss.
    """
    (_layout(merged.select(*SSOT_COLUMNS), ["event_date"], SSOT_CLUSTER)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_date").parquet(path))


def _filesystem(spark: SparkSession, path: str):
    """The Hadoop filesystem and path object of ``path`` (any scheme, default filesystem without one)."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _filesystem(spark, path)
    return fs.exists(jpath)


def init_ssot(spark: SparkSession, path: str) -> None:
    """Create an empty fact table at ``path`` if nothing is there.

    Existence is asked of the cluster filesystem; anything that exists is left as it is, and
    errors other than absence rise. The write only appends an empty set of rows, so even a race replaces nothing.
    """
    fs, jpath = _filesystem(spark, path)
    if fs.exists(jpath) and len(fs.listStatus(jpath)):
        return
    fs.mkdirs(jpath)
    spark.createDataFrame([], SSOT_SCHEMA).write.mode("append").partitionBy("event_date").parquet(path)


def partition_dates(spark: SparkSession, path: str, partition_col: str = "event_date") -> list[_dt.date]:
    """The dates a table partitioned by ``partition_col`` has directories for (a listing, no data read)."""
    from tallyhour.sources import versions
    if versions.is_versioned(spark, path):
        return versions.dates_of(versions.load(spark, path))
    fs, root = _filesystem(spark, path)
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(partition_col + "="):
            try:
                out.append(_dt.date.fromisoformat(name[len(partition_col) + 1:][:10]))
            except ValueError:      # the directory of rows without a date
                continue
    return sorted(out)


PROGRESS_SCHEMA = "source string, day date, run_ts timestamp_ntz"


def read_progress(spark: SparkSession, ssot_path: str) -> dict[str, _dt.date]:
    """Last day read by source, whether or not its rows matched traffic."""
    path = ssot_path.rstrip("/") + "_progress"
    if not path_exists(spark, path):
        return {}
    rows = spark.read.schema(PROGRESS_SCHEMA).parquet(path).groupBy("source").agg(F.max("day").alias("day")).collect()
    return {r["source"]: r["day"] for r in rows}


def write_progress(spark: SparkSession, ssot_path: str, days: dict[str, _dt.date], run_ts: _dt.datetime) -> None:
    """Add the days read by a run (one small row per source and run; the newest counts)."""
    rows = spark.createDataFrame([(k, v, run_ts) for k, v in days.items()], PROGRESS_SCHEMA)
    rows.coalesce(1).write.mode("append").parquet(ssot_path.rstrip("/") + "_progress")


def apply_retention(df: DataFrame, date_col: str, days: int, as_of: _dt.date) -> DataFrame:
    """R-01: keep rows whose date lies within ``days`` of ``as_of`` (partition expiry)."""
    lo = as_of - _dt.timedelta(days=days)
    c = F.col(date_col)
    if dict(df.dtypes).get(date_col, "date").startswith("timestamp"):
        c = F.to_date(c)
    return df.where(c >= F.lit(lo))


def expire_partitions(spark: SparkSession, path: str, partition_col: str, days: int,
                      as_of: _dt.date) -> list[_dt.date]:
    """R-01: drop date partitions older than ``days`` before ``as_of`` from a table partitioned
    by ``partition_col`` (the partition-expiry setting of the raw event table).

    Partitions are whole directories, so expiry deletes them through the cluster
    filesystem (no data is read or rewritten). Returns the dropped partition dates.
    """
    cutoff = as_of - _dt.timedelta(days=days)
    fs, root = _filesystem(spark, path)
    if not fs.exists(root):
        return []
    dropped = []
    prefix = partition_col + "="
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if not (st.isDirectory() and name.startswith(prefix)):
            continue
        try:
            day = _dt.date.fromisoformat(name[len(prefix):][:10])
        except ValueError:
            continue
        if day < cutoff:
            fs.delete(st.getPath(), True)
            dropped.append(day)
    if dropped:
        spark.catalog.refreshByPath(path)
    return sorted(dropped)
