"""Ledger of partner reports: what was read, in which form, and what came of it (B-09, H7, H8, H20).

One row per (date, partner): the digest of the report as it was last read, its outcome, and
the version of the date's traffic it met. A report is pending when it is new, when its
digest has changed (a restatement), or when it could not be allocated then and the traffic of
its date has been written since. So a late report is found however late it comes, a
restated one is allocated anew, one that nothing matches is not tried again every
hour, and the fact table is read on the pending dates only.

The ledger belongs to the same commit as the fact rows (``sources.versions``). It has as many rows
as days times partners and is written whole; reports are read in full, narrow and folded.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEDGER = "partner_ledger"
LEDGER_SCHEMA = "report_date date, partner_name string, digest string, outcome string, traffic string, run_ts timestamp_ntz"
ALLOCATED, UNMATCHED, WAITING, WITHDRAWN = "allocated", "unmatched", "waiting", "withdrawn"


def digests(reports: DataFrame) -> DataFrame:
    """report_date, partner_name, digest of every report: the same for the same rows in any order.

    Rows are hashed with their nulls; count, sum and exclusive or of the hashes tell repeated rows apart.
    """
    h = F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in sorted(reports.columns)]), {"ignoreNullFields": "false"}))
    return (reports.where(F.col("report_date").isNotNull()).select("report_date", "partner_name", h.alias("_h"))
            .groupBy("report_date", "partner_name")
            .agg(F.concat_ws("-", F.count(F.lit(1)), F.hex(F.bit_xor("_h")),
                             F.sum(F.col("_h").cast("decimal(20,0)"))).alias("digest")))


def _same_pair(a: DataFrame, b: DataFrame) -> Column:
    return (a["report_date"] == b["_date"]) & a["partner_name"].eqNullSafe(b["_partner"])


def pending(reports: DataFrame, ledger: DataFrame, traffic: Mapping[str, str]) -> DataFrame:
    """report_date, partner_name, digest, reason of the reports to allocate now.

    ``traffic``: date -> label of the commit that last changed its tracked events (bounded by the
    days of the table). A report of which no row is left is pending as withdrawn.
    """
    spark = reports.sparkSession
    found = digests(reports)
    known = ledger.select(F.col("report_date").alias("_date"), F.col("partner_name").alias("_partner"),
                          F.col("digest").alias("_digest"), F.col("outcome").alias("_outcome"), F.col("traffic").alias("_traffic"))
    labels = spark.createDataFrame([(_dt.date.fromisoformat(d), t) for d, t in traffic.items() if d[:1].isdigit()],
                                   "_day date, _label string")
    both = found.join(known, _same_pair(found, known), "full_outer")
    both = both.withColumn("_on", F.coalesce("report_date", "_date")).join(labels, F.col("_on") == F.col("_day"), "left")
    gone = F.col("report_date").isNull()
    reason = (F.when(gone & (F.col("_outcome") != WITHDRAWN), F.lit("withdrawn")).when(gone, F.lit(None).cast("string"))
              .when(F.col("_date").isNull(), F.lit("new"))
              .when(~F.col("digest").eqNullSafe(F.col("_digest")), F.lit("restated"))
              .when((F.col("_outcome") != ALLOCATED) & ~F.col("_label").eqNullSafe(F.col("_traffic")), F.lit("traffic")))
    return (both.withColumn("reason", reason).where("reason is not null")
            .select(F.col("_on").alias("report_date"), F.when(gone, F.col("_partner")).otherwise(F.col("partner_name")).alias("partner_name"),
                    "digest", "reason"))


def of_pairs(reports: DataFrame, pairs: DataFrame) -> DataFrame:
    """The reports of these pairs (few, as AQE measures)."""
    p = pairs.select(F.col("report_date").alias("_date"), F.col("partner_name").alias("_partner"))
    return reports.join(p, _same_pair(reports, p), "left_semi")


def outcomes(pairs: DataFrame, allocated: DataFrame | None, slice_df: DataFrame | None) -> DataFrame:
    """``pairs`` with ``outcome``: allocated to some row, unmatched by the traffic there is, waiting for traffic, or withdrawn."""
    out = pairs
    for name, df in (("_hit", allocated), ("_seen", slice_df)):
        if df is None:
            out = out.withColumn(name, F.lit(None).cast("boolean"))
            continue
        keys = df.select(F.col("event_date").alias("_date"), F.col("network").alias("_partner")).distinct().withColumn(name, F.lit(True))
        out = out.join(keys, _same_pair(out, keys), "left").drop("_date", "_partner")
    outcome = (F.when(F.col("reason") == "withdrawn", F.lit(WITHDRAWN)).when(F.col("_hit"), F.lit(ALLOCATED))
               .when(F.col("_seen"), F.lit(UNMATCHED)).otherwise(F.lit(WAITING)))
    return out.select(*pairs.columns, outcome.alias("outcome"))


def updated(ledger: DataFrame, decided: DataFrame, traffic: Mapping[str, str], run_ts: _dt.datetime) -> DataFrame:
    """The ledger after these pairs (with outcome) were decided against the given traffic."""
    labels = ledger.sparkSession.createDataFrame(
        [(_dt.date.fromisoformat(d), t) for d, t in traffic.items() if d[:1].isdigit()], "_day date, traffic string")
    new = decided.join(labels, F.col("report_date") == F.col("_day"), "left").select(
        "report_date", "partner_name", "digest", "outcome", "traffic", F.lit(run_ts).cast("timestamp_ntz").alias("run_ts"))
    gone = decided.select(F.col("report_date").alias("_date"), F.col("partner_name").alias("_partner"))
    return ledger.join(gone, _same_pair(ledger, gone), "left_anti").unionByName(new)
