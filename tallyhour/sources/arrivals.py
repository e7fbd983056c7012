"""Raw event files that arrive late.

The events watermark is the newest event loaded, so a file that comes later with older events
would never be read. The manifest of files already read, a side table of the fact table's commits,
tells which files are new; the hours of their events before the watermark are opened again and
pulled in full. Files are compared in Spark. Those modified before the newest known
file, less ``SLACK``, are pruned by the scan's own file metadata and are not opened.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhour.functions.exprs import hour_of

FILES = "events_files"
FILES_SCHEMA = "file string, modified timestamp_ltz"
#: Clocks of writers may differ by so much.
SLACK = _dt.timedelta(hours=6)


def files_of(events: DataFrame, since: _dt.datetime | None = None) -> DataFrame:
    """file, modified of the files that hold rows of ``events`` (a scan of files, filtered or not)."""
    if since is not None:
        events = events.where(F.col("_metadata.file_modification_time") >= F.lit(since))
    return (events.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"))
            .distinct())


def new_files(events: DataFrame, known: DataFrame) -> DataFrame:
    """file, modified of the files that are not among ``known``."""
    newest = known.agg(F.max("modified")).first()[0]
    found = files_of(events, newest - SLACK if newest is not None else None)
    return found.join(known.select("file"), "file", "left_anti")


def late_hours(events: DataFrame, files: DataFrame, before: _dt.datetime) -> list[_dt.datetime]:
    """Hours before ``before`` of which these files hold events (bounded by the hours that raw events are kept for)."""
    mine = events.where(F.col("timestamp") < F.lit(before)).select("timestamp", F.col("_metadata.file_path").alias("_file"))
    rows = mine.join(files.select(F.col("file").alias("_file")), "_file", "left_semi").select(hour_of("timestamp").alias("h")).distinct()
    return sorted(r["h"] for r in rows.collect() if r["h"] is not None)


def in_hours(column: str, hours: list[_dt.datetime]) -> Column:
    """Membership in hours as ranges, so that the scan can skip files and row groups."""
    out, hour = F.lit(False), _dt.timedelta(hours=1)
    begin = end = None
    for h in [*sorted(hours), None]:
        if h is not None and h == end:
            end = h + hour
            continue
        if begin is not None:
            out = out | ((F.col(column) >= F.lit(begin)) & (F.col(column) < F.lit(end)))
        if h is not None:
            begin, end = h, h + hour
    return out
