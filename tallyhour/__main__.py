"""Hourly run from the command line (what the scheduler calls every hour).

    python -m tallyhour --inputs <dir with the 8 input tables> --ssot <fact table path>
                        [--staging <dir>] [--run-ts 2024-02-01T17:00:00] [--mode safe|parity]
                        [--catch-up] [--sources events_stream,ssp,...] [--dq-scope touched|full]
                        [--events-partition-col event_day] [--gam-partition-col event_day]
                        [--replace-hours] [--track-files] [--count-method round|largest_remainder] [--keep-versions 10]

Inputs are parquet tables named as in ``sources.tables.INPUT_TABLES``. On a
cluster, ``spark-submit`` a two-line driver that calls ``main(sys.argv[1:])``;
the session's ``spark.checkpoint.dir`` must name a shared folder.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys

from pyspark.sql import SparkSession

from tallyhour.plans.jobs import ORDER, Options, run_all
from tallyhour.session import configure, ensure_checkpoint_dir
from tallyhour.sources.tables import read_inputs


def parse(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tallyhour", description=__doc__.splitlines()[0])
    p.add_argument("--inputs", required=True)
    p.add_argument("--ssot", required=True)
    p.add_argument("--staging", default=None)
    p.add_argument("--run-ts", default=None, help="UTC run time (default: now)")
    p.add_argument("--mode", choices=["safe", "parity"], default="safe")
    p.add_argument("--catch-up", action="store_true")
    p.add_argument("--sources", default=",".join(ORDER))
    p.add_argument("--dq-scope", choices=["full", "touched"], default="touched")
    p.add_argument("--events-partition-col", default=None, help="day-partition column of the raw events table")
    p.add_argument("--gam-partition-col", default=None, help="day-partition column of the GAM table")
    p.add_argument("--replace-hours", action="store_true", help="re-pulled hours and days lose rows their source no longer has")
    p.add_argument("--track-files", action="store_true", help="raw event files that come late reopen their hours")
    p.add_argument("--count-method", choices=["round", "largest_remainder"], default="round")
    p.add_argument("--keep-versions", type=int, default=10, help="committed versions of the fact table that stay readable")
    p.add_argument("--no-raise", action="store_true", help="report blocking DQ failures without failing")
    return p.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> list[dict]:
    a = parse(argv)
    spark = spark or SparkSession.builder.appName("tallyhour").getOrCreate()
    configure(spark)
    ensure_checkpoint_dir(spark)
    kw = dict(catch_up=a.catch_up, staging_dir=a.staging, dq_scope=a.dq_scope,
              events_partition_col=a.events_partition_col, gam_partition_col=a.gam_partition_col, replace_hours=a.replace_hours, track_files=a.track_files,
              count_method=a.count_method, keep_versions=a.keep_versions)
    if a.run_ts:
        kw["run_ts"] = _dt.datetime.fromisoformat(a.run_ts)
    opts = Options.parity(**kw) if a.mode == "parity" else Options(**kw)
    sources = tuple(s for s in a.sources.split(",") if s)
    report = run_all(spark, read_inputs(spark, a.inputs), a.ssot, opts, sources=sources,
                     raise_on_blocking=not a.no_raise)
    rows = [r.asDict() for r in report.orderBy("n").collect()]
    for r in rows:
        print(json.dumps(r))
    return rows


if __name__ == "__main__":
    main(sys.argv[1:])
