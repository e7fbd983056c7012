"""

``entry`` runs the flagship query (events -> hourly 13-dimension grain) at
the backfill scenario (see ``tallyhour.plans.backfill``); ``oracle_sql`` gives
the equivalent DuckDB SQL for each (see ``oracle_sql.py``).

Registered queries run the reference rules (``Options.parity``); ``*_safe``
twins run the hardened defaults where results differ. Double outputs are
rounded to 9 decimals on both sides, as float sums depend on order.
"""

from __future__ import annotations

import datetime as _dt
import importlib.util
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from tallyhour.operators import dq, grouping, pull, watermark  # noqa: E402
from tallyhour.operators.mapping import map_partner_ad_unit, normalise_country  # noqa: E402
from tallyhour.plans import scenarios  # noqa: E402
from tallyhour.plans.backfill import backfill  # noqa: E402
from tallyhour.schemas import GRAIN  # noqa: E402
from tallyhour.session import configure  # noqa: E402
from tallyhour.sources.fixtures import derived_inputs  # noqa: E402
from tallyhour.sources.staging import apply_retention  # noqa: E402

ROUND_DIGITS = 9
RETENTION_AS_OF = _dt.date(2024, 3, 15)
RETENTION_DAYS = 60


def _r(df: DataFrame) -> DataFrame:
    """Round double columns (float sums are order dependent)."""
    cols = [F.round(F.col(f.name), ROUND_DIGITS).alias(f.name) if f.dataType.typeName() == "double"
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: raw events -> hourly 13-dimension grain, on sf0.001."""
    configure(spark)
    inputs = derived_inputs(spark, "/root/testdata/sf0.001")
    pulled = pull.pull_events(inputs["events_stream"], None, span=None)
    return _r(grouping.group_events(pulled, inputs["dim_line_items_mapping"]))


def _b(spark, sf, mode="parity"):
    configure(spark)
    return backfill(spark, sf, mode)


def _events_pull(spark, sf):
    return _r(_b(spark, sf).detail("events_stream")["pulled"])


def _events_grouping(spark, sf):
    return _r(_b(spark, sf).detail("events_stream")["grouped"])


def _wm(source):
    def q(spark, sf, mode="parity"):
        return watermark.source_watermark(_b(spark, sf, mode).final, source)
    return q


def _ssp_new(spark, sf):
    b = _b(spark, sf)
    wm = watermark.watermark_value(b.before("ssp"), "ssp")
    return watermark.ssp_new_data(b.inputs["fact_ssp_report"], wm)


def _syn_new(spark, sf):
    b = _b(spark, sf)
    wm = watermark.watermark_value(b.before("syndication"), "syndication")
    return watermark.syndication_new_data(b.inputs["fact_syndication_revenue"], wm)


def _detail(source, key, mode="parity"):
    def q(spark, sf):
        return _r(_b(spark, sf, mode).detail(source)[key])
    return q


def _ssp_normalised(spark, sf):
    b = _b(spark, sf)
    m = normalise_country(b.detail("ssp")["pulled"], b.inputs["dim_country_mapping"])
    return _r(m.select(F.col("report_date").alias("event_date"), F.col("publisher_id").alias("organization_id"),
                       F.col("placement_type").alias("media_type"), F.lit("MinuteSSP").alias("network"),
                       F.lit("served").alias("event"), "country", "impressions", "revenue_usd", "max_ssp_date"))


def _dp_alias(spark, sf):
    b = _b(spark, sf)
    return _r(map_partner_ad_unit(b.detail("demand_partner")["grouped"], b.inputs["dim_ad_unit_mapping"]))


def _dp_delta(spark, sf):
    b = _b(spark, sf)
    return b.dp_delta(b.before("demand_partner"))


def _dp_pairs(spark, sf):
    from tallyhour.operators import delta
    b = _b(spark, sf)
    ssot = b.before("demand_partner")
    wm = watermark.watermark_value(ssot, "demand_partner")
    return delta.unprocessed_pairs(b.inputs["fact_demand_partner_reports"], ssot, wm)


def _dp_delta_after(spark, sf):
    b = _b(spark, sf)
    return b.dp_delta(b.final)


def _stage(source, mode="parity"):
    def q(spark, sf):
        return _r(_b(spark, sf, mode).stage(source))
    return q


def _merge_gam(spark, sf):
    return _r(_b(spark, sf).final.where(F.col("max_gam_timestamp").isNotNull()))


def _rerun(spark, sf):
    from tallyhour.plans.jobs import run_events
    b = _b(spark, sf)
    return _r(run_events(b.inputs, b.final, b.opts.with_(materialize=False)).ssot)


def _dq(name):
    def q(spark, sf):
        b = _b(spark, sf)
        st = b.run.staged()
        ssot = b.final
        nm = b.opts.null_mode
        if name == "grain":
            df = dq.check_grain_uniqueness(ssot, null_mode=nm)
        elif name == "required":
            df = dq.check_required_fields(ssot)
        elif name == "negatives":
            df = dq.check_no_negatives(ssot)
        elif name == "ssp":
            df = dq.check_conservation(st["ssp"]["exploded"], ssot, null_mode=nm)
        elif name == "syndication":
            df = dq.check_conservation(st["syndication"]["exploded"], ssot, null_mode=nm)
        elif name == "gam":
            df = dq.check_gam_bounding(st["gam"]["grouped"], st["gam"]["allocated"], ssot, mode=b.opts.bounding_mode)
        else:
            df = dq.check_demand_partner_bounding(st["demand_partner"]["grouped"], st["demand_partner"]["allocated"],
                                                  ssot, mode=b.opts.bounding_mode)
        return _r(df)
    return q


def _suite(mode):
    def q(spark, sf):
        b = _b(spark, sf, mode)
        return b.run.checks(b.opts)
    return q


def _second_run(spark, sf):
    """One more hourly run with the reference's single-step rules over the backfilled table."""
    from tallyhour.plans.jobs import consolidate
    b = _b(spark, sf)
    opts = b.opts.with_(catch_up=False, run_ts=scenarios.SECOND_RUN_TS)
    return _r(consolidate(b.inputs, b.final, opts).ssot)


def _retention(spark, sf):
    configure(spark)
    ev = derived_inputs(spark, sf)["events_stream"]
    return _r(apply_retention(ev, "timestamp", RETENTION_DAYS, RETENTION_AS_OF))


def _available_now(spark, sf):
    from tallyhour.streaming.events_stream import run_available_now
    configure(spark)
    return _r(run_available_now(spark, derived_inputs(spark, sf), run_ts=_dt.datetime(2024, 2, 1, 17, 0, 0),
                                null_mode="sentinel", owner_actual="replace"))


def _scenario(make, **kw):
    return lambda spark, sf: _r(make(spark, sf, **kw))


def _skipped_source(spark, sf):
    """I-06: sources without new data merge nothing (hardened rules, under which both have a watermark)."""
    from tallyhour.plans.jobs import run_ssp, run_syndication
    b = _b(spark, sf, "safe")
    opts = b.opts.with_(materialize=False, run_ts=scenarios.SECOND_RUN_TS)
    return _r(run_syndication(b.inputs, run_ssp(b.inputs, b.final, opts).ssot, opts).ssot)


def _key_profile(spark, sf):
    """I-07: the most source rows that share a merge key, by source."""
    b = _b(spark, sf, "safe")
    parts = []
    for source, key in (("events_stream", "grouped"), ("ssp", "exploded"), ("syndication", "exploded"),
                        ("demand_partner", "allocated"), ("gam", "allocated")):
        per_key = b.detail(source)[key].groupBy(*GRAIN).agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_key.agg(F.max("n").alias("most")).select(F.lit(source).alias("source"), "most"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _gam_gate(spark, sf):
    """B-11: whether a run in each hour of the day with events would reconcile GAM."""
    configure(spark)
    due = [h for h in range(24) if watermark.gam_due(_dt.datetime(2024, 1, 1, h))]
    ev = spark.read.parquet(f"{sf}/events.parquet")
    return (ev.groupBy(F.hour("ts").cast("long").alias("hour_of_day")).agg(F.count(F.lit(1)).alias("events"))
            .select("hour_of_day", F.col("hour_of_day").isin(due).alias("due"), "events"))


def _present(name: str) -> bool:
    """Whether a module is there; a module that is there but fails to import still raises."""
    try:
        return importlib.util.find_spec(name) is not None
    except ModuleNotFoundError:
        return False


def _llm_queries() -> dict:
    """The training-data operators and the corpus pipeline, where they are installed."""
    out = {}
    if _present("tallyhour.llm.entry_queries"):
        from tallyhour.llm import entry_queries
        out.update(entry_queries.queries())
        if _present("corpus_pipeline"):
            import corpus_pipeline
            out["pipeline"] = corpus_pipeline.run
    return out


def _llm_sql() -> dict:
    out = {}
    if _present("tallyhour.llm.entry_queries"):
        from tallyhour.llm import entry_queries
        out.update(entry_queries.oracle_sql())
        if _present("corpus_pipeline"):
            import corpus_pipeline
            if corpus_pipeline.ORACLE_SQL:
                out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "events_pull": _events_pull,
        "events_hourly_grouping": _events_grouping,
        "events_watermark": _wm("events_stream"),
        "gam_watermark": _wm("gam"),
        "dp_watermark": _wm("demand_partner"),
        "ssp_watermark": _wm("ssp"),
        "ssp_watermark_safe": lambda spark, sf: _wm("ssp")(spark, sf, "safe"),
        "syndication_watermark": _wm("syndication"),
        "ssp_new_data": _ssp_new,
        "syndication_new_data": _syn_new,
        "gam_pull": _detail("gam", "pulled"),
        "gam_hourly_grouping": _detail("gam", "grouped"),
        "gam_ssot_slice": _detail("gam", "slice"),
        "gam_allocation": _detail("gam", "allocated"),
        "dp_smart_delta": _dp_delta,
        "dp_unprocessed_pairs": _dp_pairs,
        "dp_smart_delta_after": _dp_delta_after,
        "dp_pull": _detail("demand_partner", "pulled"),
        "dp_grouping": _detail("demand_partner", "grouped"),
        "dp_alias_mapping": _dp_alias,
        "dp_site_slice": _detail("demand_partner", "slice"),
        "dp_allocation": _detail("demand_partner", "allocated"),
        "dp_allocation_safe": _detail("demand_partner", "allocated", "safe"),
        "ssp_pull": _detail("ssp", "pulled"),
        "ssp_country_normalised": _ssp_normalised,
        "ssp_explode": _detail("ssp", "exploded"),
        "ssp_explode_safe": _detail("ssp", "exploded", "safe"),
        "syndication_pull": _detail("syndication", "pulled"),
        "syndication_explode": _detail("syndication", "exploded"),
        "merge_events": _stage("events_stream"),
        "merge_ssp": _stage("ssp"),
        "merge_ssp_safe": _stage("ssp", "safe"),
        "merge_syndication": _stage("syndication"),
        "merge_demand_partner": _stage("demand_partner"),
        "merge_gam": _merge_gam,
        "consolidated_all_sources": _stage("gam"),
        "consolidated_all_sources_safe": _stage("gam", "safe"),
        "merge_twice_idempotent": _rerun,
        "dq_grain_uniqueness": _dq("grain"),
        "dq_required_fields": _dq("required"),
        "dq_no_negatives": _dq("negatives"),
        "dq_ssp_conservation": _dq("ssp"),
        "dq_syndication_conservation": _dq("syndication"),
        "dq_gam_bounding": _dq("gam"),
        "dq_dp_bounding": _dq("dp"),
        "dq_suite": _suite("parity"),
        "dq_suite_safe": _suite("safe"),
        "consolidated_second_run": _second_run,
        "raw_retention": _retention,
        "events_stream_available_now": _available_now,
        "persisted_two_runs": _scenario(scenarios.persisted_two_runs),
        "persisted_two_runs_staged": _scenario(scenarios.persisted_two_runs, staged=True),
        "safe_single_step_events_gap": _scenario(scenarios.events_gap, mode="safe"),
        "parity_single_step_events_gap": _scenario(scenarios.events_gap, mode="parity"),
        "safe_single_step_gam_no_match": _scenario(scenarios.gam_no_match),
        "safe_single_step_dp_head_of_line": _scenario(scenarios.partner_head_of_line, mode="safe"),
        "parity_single_step_dp_head_of_line": _scenario(scenarios.partner_head_of_line, mode="parity"),
        "ssp_explode_twins": _scenario(scenarios.ssp_twins, mode="parity"),
        "ssp_explode_twins_safe": _scenario(scenarios.ssp_twins, mode="safe"),
        "dp_allocation_twins": _scenario(scenarios.partner_twins, mode="parity"),
        "dp_allocation_twins_safe": _scenario(scenarios.partner_twins, mode="safe"),
        "url_shapes": scenarios.url_shapes,
        "staging_by_expression": scenarios.staging_by_expression,
        "merge_skipped_source": _skipped_source,
        "merge_key_profile": _key_profile,
        "gam_hour_gate": _gam_gate,
        "events_late_files": _scenario(scenarios.late_files, mode="safe"),
        "parity_events_late_files": _scenario(scenarios.late_files, mode="parity"),
        "events_stream_stateful": _scenario(scenarios.stateful_stream),
        "persisted_crash_recovery": _scenario(scenarios.persisted_crash_recovery),
        "dp_ledger_late_and_restated": _scenario(scenarios.ledger_late_and_restated),
        "merge_replace_hours": _scenario(scenarios.replace_hours),
        "merge_overlap_counts": scenarios.merge_counts,
        "gam_allocation_exact_counts": _scenario(scenarios.gam_exact_counts),
        **_llm_queries(),
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each key of ``queries()`` (input views inlined as CTEs)."""
    from oracle_sql import oracle_queries
    return {**oracle_queries(), **_llm_sql()}
