"""Runs an operator meets hour after hour, over the driver's tables.

The backfill (``plans.backfill``) starts from nothing and catches up. These go on
from there: persisted runs with new data in between, and single hourly steps
over sources with a gap, a day that matches nothing, or a report that waits for
its traffic; each in the hardened form and, where it differs, by the reference rules.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhour.operators import allocation, explode, grouping, merge, pull
from tallyhour.plans.backfill import RUN_TS
from tallyhour.plans.jobs import Options, consolidate, run_all, run_gam
from tallyhour.session import configure, scratch_path
from tallyhour.sources.fixtures import derived_inputs
from tallyhour.sources import versions
from tallyhour.sources.staging import read_ssot, stage_table, write_staging
from tallyhour.sources.tables import empty_ssot

SECOND_RUN_TS = _dt.datetime(2024, 2, 2, 17, 0, 0)
#: Rows before this day are there at the first run, all rows at the second.
CUTOFF = _dt.date(2024, 1, 20)
#: Events of these days are missing in the gap scenario.
GAP = (_dt.date(2024, 1, 5), _dt.date(2024, 1, 25))
#: Traffic starts here in the scenarios whose reports start before.
TRAFFIC_FROM = _dt.date(2024, 1, 3)
GAM_UNTIL = _dt.date(2024, 1, 4)

_DAY_COLUMNS = {"events_stream": "timestamp", "fact_gam_data_transfer": "timestamp",
                "fact_demand_partner_reports": "report_date", "fact_ssp_report": "report_date",
                "fact_syndication_revenue": "transaction_date"}


def _days(inputs: dict, keep) -> dict:
    """Inputs whose rows' days satisfy ``keep(name, day column)``."""
    out = dict(inputs)
    for name, c in _DAY_COLUMNS.items():
        cond = keep(name, F.to_date(c))
        if cond is not None:
            out[name] = inputs[name].where(cond)
    return out


LAST_DAY = _dt.date(2024, 1, 30)


def before(inputs: dict, day: _dt.date) -> dict:
    """Inputs as they were before ``day``."""
    return _days(inputs, lambda n, d: d < F.lit(day))


def persisted_two_runs(spark: SparkSession, sf_dir: str, staged: bool = False) -> DataFrame:
    """The fact table after two hardened ``run_all`` runs, new days arriving in between."""
    configure(spark)
    inputs = derived_inputs(spark, sf_dir)
    path = scratch_path(spark, "persisted")
    staging = scratch_path(spark, "persisted_staging") if staged else None
    opts = Options(run_ts=RUN_TS, catch_up=True, staging_dir=staging)
    run_all(spark, before(inputs, CUTOFF), path, opts)
    run_all(spark, inputs, path, opts.with_(run_ts=SECOND_RUN_TS))
    return read_ssot(spark, path)


class Killed(RuntimeError):
    """Ends a run in the scenarios, as a lost driver would."""


def persisted_crash_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table after a run that was killed before its first switch, and after the run that follows.

    The killed run has written the files of all dates its first merge touched.
    """
    configure(spark)
    inputs = derived_inputs(spark, sf_dir)
    path = scratch_path(spark, "crashed")
    opts = Options(run_ts=RUN_TS, catch_up=True)
    run_all(spark, before(inputs, CUTOFF), path, opts)

    def kill(source, commit):
        raise Killed(source)

    opts = opts.with_(run_ts=SECOND_RUN_TS)
    try:
        run_all(spark, inputs, path, opts, on_commit=kill)
    except Killed:
        pass
    crashed = stage_table(read_ssot(spark, path), "after_crash")
    run_all(spark, inputs, path, opts)
    return (crashed.withColumn("state", F.lit("after_crash"))
            .unionByName(read_ssot(spark, path).withColumn("state", F.lit("recovered"))))


#: Magnite's reports up to this day are restated in the ledger scenario.
RESTATED_UNTIL = _dt.date(2024, 1, 10)


def ledger_late_and_restated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partner reports in two runs: Triplelift's of even days come with the second, behind the watermark, and
    Magnite's of the first days are restated there with other revenue and without one site."""
    configure(spark)
    inputs = derived_inputs(spark, sf_dir)
    reports = inputs["fact_demand_partner_reports"]
    late = (F.col("partner_name") == "Triplelift") & (F.dayofmonth("report_date") % 2 == 0)
    restated = (F.col("partner_name") == "Magnite") & (F.col("report_date") <= F.lit(RESTATED_UNTIL))
    second = reports.where(~(restated & (F.col("property_code") == "org_0"))).withColumn(
        "revenue_usd", F.when(restated, F.col("revenue_usd") * 2).otherwise(F.col("revenue_usd")))
    path = scratch_path(spark, "ledger")
    opts = Options(run_ts=RUN_TS, catch_up=True)
    run_all(spark, {**inputs, "fact_demand_partner_reports": reports.where(~late)}, path, opts, sources=("events_stream", "demand_partner"))
    run_all(spark, {**inputs, "fact_demand_partner_reports": second}, path, opts.with_(run_ts=SECOND_RUN_TS), sources=("demand_partner",))
    return read_ssot(spark, path)


def replace_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day's events pulled again without those of one line item: their rows go, but for those that partners reconciled."""
    configure(spark)
    inputs = derived_inputs(spark, sf_dir)
    opts = Options(run_ts=RUN_TS, catch_up=True)
    ssot = consolidate(inputs, empty_ssot(spark), opts, sources=("events_stream", "demand_partner")).ssot
    day = _dt.datetime.combine(CUTOFF, _dt.time())
    again = inputs["events_stream"].where(~F.col("lineItem").eqNullSafe(F.lit("1")))
    pulled = pull.pull_events(again, day, span=_dt.timedelta(days=1))
    source = stage_table(grouping.group_events(pulled, inputs["dim_line_items_mapping"]), "again")
    spec = merge.events_spec(SECOND_RUN_TS, replace_hours=(day, day + _dt.timedelta(days=1)))
    return merge.merge_into(ssot, source, spec, dates=[CUTOFF], check_cardinality=False).table


def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each source's merge of a persisted catch-up run did, from the table's versions (H18)."""
    configure(spark)
    path = scratch_path(spark, "counted")
    run_all(spark, derived_inputs(spark, sf_dir), path, Options(run_ts=RUN_TS, catch_up=True))
    names = ["matched", "inserted", "withdrawn", "deleted", "overlapping"]
    rows = [(v.info["source"], *[v.info[n] for n in names], sum(v.rows.values()))
            for v in versions.history(spark, path) if "matched" in v.info]  # five commits
    return spark.createDataFrame(rows, "source string, " + ", ".join(f"{n} long" for n in [*names, "fact_rows"]))


def gam_exact_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GAM allocation of all days with counts that add up to the totals (H11)."""
    configure(spark)
    inputs = derived_inputs(spark, sf_dir)
    opts = Options(run_ts=RUN_TS, catch_up=True)
    ssot = consolidate(inputs, empty_ssot(spark), opts, sources=("events_stream",)).ssot
    return run_gam(inputs, ssot, opts.with_(count_method="largest_remainder")).detail["allocated"]


def late_files(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Raw events in files; those of one publisher on four days come after the other days were loaded."""
    configure(spark)
    inputs = derived_inputs(spark, sf_dir)
    events, landing, path = inputs["events_stream"], scratch_path(spark, "raw_events"), scratch_path(spark, "late")
    late = (F.col("organizationId") == "org_2") & F.to_date("timestamp").between(F.lit(LATE_DAYS[0]), F.lit(LATE_DAYS[1]))
    events.where(~late).write.parquet(landing)
    opts = Options(run_ts=RUN_TS, catch_up=True, track_files=mode == "safe")
    for run_ts in (RUN_TS, SECOND_RUN_TS):
        raw = spark.read.schema(events.schema).parquet(landing)
        run_all(spark, {**inputs, "events_stream": raw}, path, opts.with_(run_ts=run_ts), sources=("events_stream",))
        if run_ts == RUN_TS:
            events.where(late).write.mode("append").parquet(landing)
    return read_ssot(spark, path)


#: Days of the late events, and by how many days some events come late in the stateful stream.
LATE_DAYS = (_dt.date(2024, 1, 3), _dt.date(2024, 1, 6))


def stateful_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events through the stateful stream: files land in order of arrival, one publisher's two days late; the query
    ends half-way and is started again from its checkpoint."""
    from tallyhour.streaming.events_state import drain, stateful_query

    configure(spark)
    inputs = derived_inputs(spark, sf_dir)
    events, landing = inputs["events_stream"], scratch_path(spark, "state_landing")
    path, checkpoint = scratch_path(spark, "state_fact"), scratch_path(spark, "state_checkpoint")
    day = F.to_date("timestamp")
    arrival = F.when(F.col("organizationId") == "org_1", F.date_add(day, 2)).otherwise(day)
    steps = [_dt.date(2024, 1, 1), _dt.date(2024, 1, 9), _dt.date(2024, 1, 17), _dt.date(2024, 1, 25), _dt.date(2024, 3, 1)]
    for half in ((0, 1), (2, 3)):
        for i in half:  # one file set after another: a stream takes files in the order they were written
            here = events.where((arrival >= F.lit(steps[i])) & (arrival < F.lit(steps[i + 1])))
            here.coalesce(2).write.mode("append").parquet(landing)
        drain(stateful_query(spark, landing, inputs["dim_line_items_mapping"], path, checkpoint, run_ts=RUN_TS,
                             late="10 days", max_files_per_trigger=2))
    return read_ssot(spark, path)


def events_gap(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """One hourly events step after the days before a gap were loaded."""
    configure(spark)
    inputs = derived_inputs(spark, sf_dir)
    raw = _days(inputs, lambda n, d: ((d < F.lit(GAP[0])) | (d >= F.lit(GAP[1]))) if n == "events_stream" else None)
    make = Options.parity if mode == "parity" else Options
    opts = make(run_ts=RUN_TS, catch_up=True)
    early = {**raw, "events_stream": raw["events_stream"].where(F.to_date("timestamp") < F.lit(GAP[0]))}
    loaded = consolidate(early, empty_ssot(spark), opts, sources=("events_stream",)).ssot
    return consolidate(raw, loaded, opts.with_(catch_up=False, run_ts=SECOND_RUN_TS), sources=("events_stream",)).ssot


def gam_no_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four daily GAM steps, the first two over days without any traffic: each is read once."""
    configure(spark)
    inputs = derived_inputs(spark, sf_dir)
    inputs = _days(inputs, lambda n, d: d >= F.lit(TRAFFIC_FROM) if n == "events_stream" else
                   d < F.lit(GAM_UNTIL) if n == "fact_gam_data_transfer" else None)
    opts = Options(run_ts=RUN_TS, catch_up=True)
    ssot = consolidate(inputs, empty_ssot(spark), opts, sources=("events_stream",)).ssot
    opts, progress = opts.with_(catch_up=False), {}
    for _ in range(4):
        step = run_gam(inputs, ssot, opts.with_(progress=progress))
        ssot = step.ssot
        if step.info.get("dates"):
            progress = {"gam": max(step.info["dates"])}
    return ssot


def partner_head_of_line(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """One hourly partner step; the oldest reports wait for traffic that is not there."""
    configure(spark)
    inputs = derived_inputs(spark, sf_dir)
    inputs = _days(inputs, lambda n, d: d >= F.lit(TRAFFIC_FROM) if n == "events_stream" else None)
    make = Options.parity if mode == "parity" else Options
    opts = make(run_ts=RUN_TS, catch_up=True)
    ssot = consolidate(inputs, empty_ssot(spark), opts, sources=("events_stream",)).ssot
    return consolidate(inputs, ssot, opts.with_(catch_up=False), sources=("demand_partner",)).ssot


def url_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and hosts of event URLs written in eight shapes (H-11, H-12)."""
    configure(spark)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = (F.col("user_id") % 4).cast("string")
    host = F.concat(F.lit("site"), n, F.lit(".example.com"))
    shapes = [F.concat(F.lit("https://www."), host, F.lit("/p/"), F.col("event_id").cast("string")), F.concat(F.lit("//cdn."), host, F.lit("/x")),
              F.concat(F.lit("  http://"), host, F.lit("  ")), F.concat(F.lit("https://b\u00fccher"), n, F.lit(".de?q=1")),
              F.concat(F.lit("https://[::"), n, F.lit("]:8080/x")), F.concat(F.lit("ftp://me:pw@"), host, F.lit(":21/f")),
              F.concat(F.lit("www."), host, F.lit("#top")), F.lit(None).cast("string")]
    url = F.element_at(F.array(*shapes), (F.col("event_id") % 8 + 1).cast("int"))
    return (ev.select(pull.domain_of(url).alias("domain")).groupBy("domain")
            .agg(F.count("*").alias("events")))


def ssp_twins(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """SSP explosion where two report rows share an output row: the US publishers' reports come twice,
    once per country notation."""
    configure(spark)
    inputs = derived_inputs(spark, sf_dir)
    pulled = pull.pull_ssp(inputs["fact_ssp_report"], _dt.date(1970, 1, 1))
    twin = pulled.where("country_code = 'USA'").withColumn("country_code", F.lit("US"))
    rule = "first_row" if mode == "parity" else "per_grain"
    return explode.ssp_explode(pulled.unionByName(twin), inputs["dim_country_mapping"], remainder=rule)


def partner_twins(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Partner allocation where sites have two unmapped units, and exact rows beside site-wide ones."""
    configure(spark)
    inputs = derived_inputs(spark, sf_dir)
    days = [r[0] for r in inputs["fact_demand_partner_reports"].select("report_date").distinct().collect()]  # bounded by days
    reports = pull.pull_date(inputs["fact_demand_partner_reports"], days)
    odd = (F.col("impressions") % 2) == 1
    reports = reports.withColumn("ad_unit", F.when(odd, F.lit("unmapped_b")).otherwise(F.col("ad_unit")))
    traffic = grouping.group_events(pull.pull_events(inputs["events_stream"], None, span=None), inputs["dim_line_items_mapping"])
    part = allocation.ssot_slice(traffic, days, exclude_networks=("GAM", "MinuteSSP"))
    return allocation.demand_partner_allocation(grouping.group_demand_partner(reports), part, inputs["dim_ad_unit_mapping"],
                                                mode="per_row" if mode == "parity" else "per_path")


def staging_by_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-04: raw events staged by a derived day; rows per partition, read from the replaced table."""
    configure(spark)
    ev = derived_inputs(spark, sf_dir)["events_stream"].select("timestamp", "event")
    path = scratch_path(spark, "by_expression")
    day = {"event_date": F.to_date("timestamp")}
    write_staging(ev, path, partition_expr=day, cluster_cols=["event"])
    kept = write_staging(ev.where(F.to_date("timestamp") < F.lit(CUTOFF)), path, partition_expr=day, cluster_cols=["event"])
    return kept.groupBy("event_date", "event").agg(F.count("*").alias("events"))
