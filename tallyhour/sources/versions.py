"""Versioned commits of the partitioned fact table (K-05, SURVEY §2.I step 5).

A commit writes the partitions it touches into directories of its own and then switches to
them all at once::

    <path>/data/event_date=2024-01-01/version=<label>/part-*.parquet
    <path>/side/<name>/version=<label>/part-*.parquet     small tables that belong to the commit
    <path>/versions/000000000012.json                     what table version 12 consists of

A version file names, for each date, the label whose files hold it. It is written under
another name and renamed without overwriting: readers see the old version or the new one,
never a mixture, and of two writers that started from the same version the second fails with
:class:`VersionConflict`. A run killed before the rename leaves files that no version names;
labels are never used twice, so nothing reads them, and :func:`expire` removes them later.
Nothing is overwritten in place, so that a commit may read the version it replaces, and a
reader keeps its files until :func:`expire` drops the versions that name them.

Only version files reach the driver: their size is bounded by the number of dates.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhour.schemas import SSOT_COLUMNS, SSOT_SCHEMA
from tallyhour.sources.staging import SSOT_CLUSTER, _filesystem, _layout

#: The directory value of rows without a date.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
_FILE = re.compile(r"(\d{12})\.json")


class VersionConflict(RuntimeError):
    """Another writer has committed since this one began."""


class UnknownVersion(LookupError):
    """A version that was never committed, or has been expired."""


@dataclass(frozen=True)
class Version:
    """One committed state of the table."""
    number: int = 0
    dates: Mapping[str, str] = field(default_factory=dict)     # date -> label of the files that hold it
    rows: Mapping[str, int] = field(default_factory=dict)      # date -> its rows
    traffic: Mapping[str, str] = field(default_factory=dict)   # date -> label of the last commit that changed traffic
    side: Mapping[str, str] = field(default_factory=dict)      # side table -> label
    progress: Mapping[str, str] = field(default_factory=dict)  # source -> last day read
    info: Mapping = field(default_factory=dict)                # source, run_ts, counts of the commit

    def folders(self) -> set[str]:
        """The directories that hold this version."""
        return {f"event_date={d}/version={label}" for d, label in self.dates.items()} | {
            f"{name}/version={label}" for name, label in self.side.items()}


def _key(date) -> str:
    return NO_DATE if date is None else date.isoformat()


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, root = _filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The committed versions that are still kept, oldest first."""
    return [int(m.group(1)) for m in map(_FILE.fullmatch, _names(spark, f"{path}/versions")) if m]


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(numbers(spark, path))


def load(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """A committed version; the newest by default, an empty version 0 where nothing was committed."""
    kept = numbers(spark, path)
    if number is None:
        number = kept[-1] if kept else 0
    if number == 0 and not kept:
        return Version()
    if number not in kept:
        raise UnknownVersion(f"{path} has no version {number}")
    fs, file = _filesystem(spark, f"{path}/versions/{number:012d}.json")
    stream = fs.open(file)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Version(**json.loads(text))


def _read_dirs(spark: SparkSession, base: str, dirs: Sequence[str], schema) -> DataFrame:
    if not dirs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*dirs)


def read(spark: SparkSession, path: str, version: Version | int | None = None,
         dates: Sequence[_dt.date] | None = None) -> DataFrame:
    """The fact table as of a version (the newest by default); ``dates`` limits it to some partitions.

    Exactly the directories that the version names are listed; filters on ``event_date`` prune them.
    """
    v = version if isinstance(version, Version) else load(spark, path, version)
    chosen = v.dates if dates is None else {k: v.dates[k] for k in map(_key, dates) if k in v.dates}
    dirs = [f"{path}/data/event_date={d}/version={label}" for d, label in sorted(chosen.items())]
    return _read_dirs(spark, f"{path}/data", dirs, SSOT_SCHEMA).select(*SSOT_COLUMNS)


def dates_of(version: Version) -> list[_dt.date]:
    """The dates a version has rows for (rows without a date aside)."""
    return sorted(_dt.date.fromisoformat(d) for d in version.dates if d != NO_DATE)


def read_side(spark: SparkSession, path: str, name: str, schema: str, version: Version | None = None) -> DataFrame:
    """A side table as of a version; empty where it was never written."""
    v = version or load(spark, path)
    if name not in v.side:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/side/{name}/version={v.side[name]}")


@dataclass
class Commit:
    """A commit in the making, from the version it began with."""
    spark: SparkSession
    path: str
    base: Version
    label: str
    dates: dict = field(default_factory=dict)
    rows: dict = field(default_factory=dict)
    traffic: dict = field(default_factory=dict)
    side: dict = field(default_factory=dict)
    progress: dict = field(default_factory=dict)
    info: dict = field(default_factory=dict)

    def write(self, merged: DataFrame, touched: Sequence, traffic: bool = False) -> dict[str, int]:
        """Write all rows of the touched dates; returns their rows by date (read from file footers).

        ``merged`` may read the version that this commit replaces. A touched date without rows
        leaves the table. ``traffic``: the commit changed tracked events.
        """
        data = f"{self.path}/data"
        (_layout(merged.select(*SSOT_COLUMNS).withColumn("version", F.lit(self.label)), ["event_date"], SSOT_CLUSTER)
         .write.mode("append").partitionBy("event_date", "version").parquet(data))
        keys = [_key(d) for d in touched]
        fs, _ = _filesystem(self.spark, data)
        own = [k for k in keys if fs.exists(_filesystem(self.spark, f"{data}/event_date={k}/version={self.label}")[1])]
        dirs = [f"{data}/event_date={k}/version={self.label}" for k in own]
        found = _read_dirs(self.spark, data, dirs, SSOT_SCHEMA).groupBy("event_date").agg(F.count(F.lit(1)).alias("n")).collect()
        counts = {_key(r["event_date"]): r["n"] for r in found}
        for k in keys:
            self.dates[k], self.rows[k] = (self.label, counts[k]) if k in counts else (None, 0)
            if traffic:
                self.traffic[k] = self.label
        return {k: counts.get(k, 0) for k in keys}

    def write_side(self, name: str, table: DataFrame) -> None:
        """Replace a side table (a small one: it is written whole)."""
        table.write.mode("error").parquet(f"{self.path}/side/{name}/version={self.label}")
        self.side[name] = self.label

    def switch(self) -> Version:
        """Make the commit the newest version, all at once."""
        merged = lambda old, new: {k: v for k, v in {**old, **new}.items() if v is not None}
        dates = merged(self.base.dates, self.dates)
        rows = {k: n for k, n in {**self.base.rows, **self.rows}.items() if k in dates}
        v = Version(self.base.number + 1, dates, rows, merged(self.base.traffic, self.traffic), merged(self.base.side, self.side),
                    merged(self.base.progress, self.progress), self.info)
        jvm, sc = self.spark.sparkContext._jvm, self.spark.sparkContext
        fs, folder = _filesystem(self.spark, f"{self.path}/versions")
        fs.mkdirs(folder)
        target = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions/{v.number:012d}.json"))
        if fs.exists(target):
            raise VersionConflict(f"{self.path}: version {v.number} was committed by another writer")
        draft = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions/.{self.label}"))
        out = fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(v.__dict__).encode()))
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), sc._jsc.hadoopConfiguration())
        try:
            context.rename(draft, target, sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as e:  # py4j wraps the Java error
            if "FileAlreadyExists" in str(e):
                raise VersionConflict(f"{self.path}: version {v.number} was committed by another writer") from e
            raise
        return v


def begin(spark: SparkSession, path: str, base: Version | None = None) -> Commit:
    """A new commit on the newest version (or on ``base``, which must still be the newest at the switch)."""
    base = load(spark, path) if base is None else base
    return Commit(spark, path, base, f"{base.number + 1}-{uuid.uuid4().hex[:12]}")


def create(spark: SparkSession, path: str) -> Version:
    """Version 1 of a table that does not exist yet; an older in-place table at ``path`` is taken over.

    The older table's files are copied into the first version and left where they are.
    """
    from tallyhour.sources import staging

    if is_versioned(spark, path):
        return load(spark, path)
    commit = begin(spark, path, Version())
    old = [n for n in _names(spark, path) if n.startswith("event_date=")]
    if old:
        table = _read_dirs(spark, path, [f"{path}/{n}" for n in old], SSOT_SCHEMA).select(*SSOT_COLUMNS)
        days = [None if n.endswith(NO_DATE) else _dt.date.fromisoformat(n[11:21]) for n in old]
        commit.write(table, days, traffic=True)
        commit.progress = {k: d.isoformat() for k, d in staging.read_progress(spark, path).items()}
    commit.info = {"source": "create"}
    try:
        return commit.switch()
    except VersionConflict:
        return load(spark, path)


def history(spark: SparkSession, path: str) -> list[Version]:
    """All kept versions, oldest first."""
    return [load(spark, path, n) for n in numbers(spark, path)]


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Drop all but the newest ``keep`` versions, and every directory that no kept version names.

    Directories of commits that could still be under way (labels beyond the newest version) are left
    alone. Version files go first, so that no kept version ever names a missing directory. Returns
    the dropped directories.
    """
    if keep < 1:
        raise ValueError("at least the newest version is kept")
    kept = numbers(spark, path)
    if not kept:
        return []
    named = set().union(*(load(spark, path, n).folders() for n in kept[-keep:]))
    for n in kept[:-keep]:
        fs, file = _filesystem(spark, f"{path}/versions/{n:012d}.json")
        fs.delete(file, False)
    dropped = []
    for top in ("data", "side"):
        for outer in _names(spark, f"{path}/{top}"):
            for inner in _names(spark, f"{path}/{top}/{outer}") if "=" in outer or top == "side" else []:
                label = inner.removeprefix("version=")
                if inner.startswith("version=") and f"{outer}/{inner}" not in named and int(label.split("-")[0]) <= kept[-1]:
                    fs, folder = _filesystem(spark, f"{path}/{top}/{outer}/{inner}")
                    fs.delete(folder, True)
                    dropped.append(f"{outer}/{inner}")
    return sorted(dropped)
