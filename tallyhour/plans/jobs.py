"""Composite jobs (L-01..L-06): watermark -> gate -> pull -> transform -> merge.

Two forms share the same steps:

* :func:`consolidate` keeps the fact table as a DataFrame and returns it with
  every staged result (used by tests and the registered queries); the table is
  checkpointed to the shared checkpoint folder after each merge, which cuts the
  lineage, survives executor loss and prevents recomputing earlier stages.
* :func:`run_all` works on a versioned parquet fact table at a path; each merge
  writes the partitions it touched and switches to them in one commit.

Only scalars reach the driver: watermarks, gate flags and the touched dates.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhour.operators import allocation, delta, dq, explode, grouping, ledger, merge, pull, watermark
from tallyhour.schemas import GAM_NETWORK, OWNER_NETWORK, SSOT_COLUMNS
from tallyhour.session import checkpoint_dir, configure, run_scratch
from tallyhour.sources import arrivals
from tallyhour.sources.staging import STAGING_LAYOUT, stage_table, write_named_staging


@dataclass(frozen=True)
class Options:
    """Run options. Defaults are the hardened behaviour; :meth:`parity` reproduces the reference."""
    run_ts: _dt.datetime = field(default_factory=lambda: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
    today: _dt.date | None = None                 # complete-day guard for GAM (default: run_ts date)
    null_mode: str = "null_safe"                  # H1/H13: "null_safe" | "sentinel"
    events_bounds: str = "half_open"              # H2: "half_open" | "exclusive"
    events_span: _dt.timedelta | None = pull.EVENTS_SPAN
    catch_up: bool = False                        # pull every pending day, not one step (H5/H6/H8)
    bootstrap_from_source: bool = True            # H5: empty history starts at the source minimum
    skip_gaps: bool = True                        # H6: an empty window/day advances to the next source data
    watermark_on_insert: bool = True              # H3
    explode_remainder: str = "per_grain"          # H4: "per_grain" | "first_row"
    dp_allocation: str = "per_path"               # H9: "per_path" | "per_row"
    count_method: str = "round"                   # H11: GAM counts "round" | "largest_remainder"
    owner_actual: str = "coalesce"                # H16: "coalesce" | "replace"
    lookback_days: int = 7                        # H7; dates with traffic are taken however old they are (H8)
    bounding_mode: str = "bounded"                # H12: "equal" | "bounded"
    gam_hour: int | None = 17                     # B-11; None = no gate
    check_cardinality: bool = True                # I-07
    replace_hours: bool = False                   # H19/H20: re-pulled hours and days lose rows their source no longer has
    dp_ledger: bool = True                        # persisted runs: partner reports by ledger; else by the facts (delta)
    ledger: DataFrame | None = None               # the ledger, and the commits of each date's traffic, of this run
    traffic: Mapping[str, str] = field(default_factory=dict)
    track_files: bool = False                     # raw events are a file scan: files that come late reopen their hours
    events_files: DataFrame | None = None         # the files read by earlier runs
    keep_versions: int = 10                       # committed versions of the fact table that stay readable
    dq_scope: str = "touched"                     # "touched": checks on this run's dates | "full": whole table
    progress: Mapping[str, _dt.date] = field(default_factory=dict)  # last day read by source, matched or not
    fact_dates: tuple | None = None               # partitions of the fact table, where they are known
    events_partition_col: str | None = None       # day-partition column of the raw events table, if any
    gam_partition_col: str | None = None          # day-partition column of the GAM table, if any
    materialize: bool = True                      # stage merge sources and merged partitions
    observe: bool = False                         # count what a merge does in its own pass; merged rows are not staged
    stage_format: str = "checkpoint"              # "checkpoint" (reliable, shared folder) | "parquet"
    staging_dir: str | None = None                # if set, named stages are written there with their layout
    compact: bool = True                          # in-memory runs: materialise the whole table after a merge

    @classmethod
    def parity(cls, **kw) -> Options:
        base = dict(null_mode="sentinel", events_bounds="exclusive", bootstrap_from_source=False, skip_gaps=False,
                    watermark_on_insert=False, explode_remainder="first_row", dp_allocation="per_row",
                    owner_actual="replace", lookback_days=0, bounding_mode="equal", dq_scope="full", dp_ledger=False)
        base.update(kw)
        return cls(**base)

    def with_(self, **kw) -> Options:
        return replace(self, **kw)

    @property
    def today_date(self) -> _dt.date:
        return self.today or self.run_ts.date()


@dataclass
class JobResult:
    ssot: DataFrame
    ran: bool
    staged: dict = field(default_factory=dict)
    info: dict = field(default_factory=dict)
    merged: DataFrame | None = None
    dates: list = field(default_factory=list)
    detail: dict = field(default_factory=dict)     # every staged DataFrame / scalar of the run
    observation: Observation | None = None         # counts of the merge, once its rows were written


def _materialize(df: DataFrame, opts: Options, name: str = "stage") -> DataFrame:
    """Stage ``df`` in the shared checkpoint folder (the Spark form of the reference's STG
    tables): cuts lineage, survives executor loss and is computed once however often it is
    read. ``checkpoint`` is a reliable checkpoint (its input is computed twice, so it suits small
    staged data); ``parquet`` writes a table once, whose re-read keeps statistics, pushdown and pruning."""
    if not opts.materialize:
        return df
    if opts.staging_dir and name in STAGING_LAYOUT:
        return write_named_staging(df, opts.staging_dir, name)
    if opts.stage_format == "parquet":
        return stage_table(df, name)
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _merge(ssot: DataFrame, source: DataFrame, spec, opts: Options, dates=None, unique: bool = False):
    """``unique``: the source is grouped by its null-safe grain, so that no target row can match
    twice and the test (a shuffle of its own) is left out."""
    check = opts.check_cardinality and not (unique and opts.null_mode == "null_safe")
    if dates is None and not check:
        dates = _dates(source)
    observation = Observation(f"merge-{uuid.uuid4().hex}") if opts.observe else None
    scope = "none" if opts.observe else "table" if opts.compact else "merged"
    res = merge.merge_into(ssot, source, spec, dates=dates, check_cardinality=check, observation=observation,
                           materialize=None if opts.observe else lambda d: _materialize(d, opts), materialize_scope=scope)
    res.observation = observation
    return res


def _dates(df: DataFrame) -> list:
    """The dates of a staged table (bounded by days), a missing one last."""
    return sorted((r[0] for r in df.select("event_date").distinct().collect()), key=lambda d: (d is None, d))


def _covered(source: DataFrame, ssot: DataFrame, opts: Options, lo, hi=None) -> list | None:
    """With replacement: the source's dates and those of the fact table from ``lo`` on, before ``hi``."""
    if not opts.replace_hours:
        return None
    known = opts.fact_dates if opts.fact_dates is not None else _dates(ssot)
    first, last = pull.as_date(lo) if lo is not None else None, hi.date() if hi is not None else None
    held = {d for d in known if d is not None and (first is None or d >= first) and (last is None or d <= last)}
    return sorted(held | set(_dates(source)), key=lambda d: (d is None, d or _dt.date.min))


# --- L-01 ------------------------------------------------------------------

def events_staged(inputs: Mapping[str, DataFrame], ssot: DataFrame, opts: Options) -> dict:
    wm = watermark.watermark_value(ssot, "events_stream", use_default=not opts.bootstrap_from_source,
                                   dates=opts.fact_dates)
    span = opts.events_span
    if wm is None:       # bootstrap (H5): no history, start at the first source event
        if span is None:
            lo = None
        else:
            lo = inputs["events_stream"].agg(F.min("timestamp")).first()[0]
            if lo is not None:
                lo = lo.replace(minute=0, second=0, microsecond=0)
        wm_used, bounds = lo, "half_open"
    else:
        wm_used, bounds = wm, opts.events_bounds
    if opts.catch_up:
        span = None
    if opts.skip_gaps and span is not None and wm_used is not None:
        # H6: the watermark's own hour is already loaded, so look for the first event after the last
        # loaded one; if the window ends before it, the window moves there
        loaded = watermark.watermark_value(ssot, "events_stream", use_default=False, dates=opts.fact_dates, trunc=False)
        ts = F.col("timestamp")
        later = ts >= F.lit(wm_used) if loaded is None else ts > F.lit(loaded)
        nxt = inputs["events_stream"].where(later).agg(F.min("timestamp")).first()[0]
        if nxt is not None:
            start = nxt.replace(minute=0, second=0, microsecond=0)
            if start >= wm_used + span:
                wm_used = start
    files, reopened = None, []
    if opts.events_files is not None:
        files = _materialize(arrivals.new_files(inputs["events_stream"], opts.events_files), opts, "events_files")
        if wm is not None and opts.events_files.take(1):  # without a manifest, what is there counts as read
            reopened = arrivals.late_hours(inputs["events_stream"], files, wm_used)
    hours = None
    if opts.replace_hours and bounds == "half_open":
        hours = (wm_used, None if span is None or wm_used is None else wm_used + span)
    if wm_used is None:
        pulled = pull.pull_events(inputs["events_stream"], None, span=None)
    else:
        pulled = pull.pull_events(inputs["events_stream"], wm_used, span=span, bounds=bounds,
                                  partition_col=opts.events_partition_col)
    if reopened:
        again = inputs["events_stream"].where(arrivals.in_hours("timestamp", reopened))
        pulled = pulled.unionByName(pull.pull_events(again, None, span=None))
    grouped = _materialize(grouping.group_events(pulled, inputs["dim_line_items_mapping"]), opts,
                           "events_stream_grouping")
    return {"watermark": wm, "pulled": pulled, "grouped": grouped, "hours": hours, "files": files, "reopened": reopened}


def run_events(inputs, ssot: DataFrame, opts: Options) -> JobResult:
    st = events_staged(inputs, ssot, opts)
    hours = st["hours"]
    spec = merge.events_spec(opts.run_ts, null_mode=opts.null_mode, owner_actual=opts.owner_actual, replace_hours=hours)
    dates = _covered(st["grouped"], ssot, opts, *hours) if hours else None
    res = _merge(ssot, st["grouped"], spec, opts, dates=dates, unique=True)
    return JobResult(res.table, True, {"grouped": st["grouped"]},
                     {"watermark": st["watermark"]}, res.merged, res.dates, st, res.observation)


# --- L-02 / L-03 -----------------------------------------------------------

def ssp_staged(inputs, ssot, opts: Options) -> dict:
    wm = watermark.watermark_value(ssot, "ssp", dates=opts.fact_dates)
    # the report may itself be a query: it is read once, by the pull, which holds every row of the gate
    pulled = _materialize(pull.pull_ssp(inputs["fact_ssp_report"], wm), opts, "ssp_pull")
    has = watermark.has_new_data(pulled, "report_date", wm)
    exploded = explode.ssp_explode(pulled, inputs["dim_country_mapping"], remainder=opts.explode_remainder)
    if has:
        exploded = _materialize(exploded, opts, "ssp_explode_data")
    return {"watermark": wm, "has_new_data": has, "pulled": pulled, "exploded": exploded}


def run_ssp(inputs, ssot, opts: Options) -> JobResult:
    st = ssp_staged(inputs, ssot, opts)
    if not st["has_new_data"]:
        return JobResult(ssot, False, {}, {"watermark": st["watermark"]})
    spec = merge.ssp_spec(opts.run_ts, st["watermark"], null_mode=opts.null_mode,
                          watermark_on_insert=opts.watermark_on_insert, replace_dates=opts.replace_hours)
    res = _merge(ssot, st["exploded"], spec, opts, dates=_covered(st["exploded"], ssot, opts, st["watermark"]),
                 unique=opts.explode_remainder == "per_grain")
    return JobResult(res.table, True, {"exploded": st["exploded"]},
                     {"watermark": st["watermark"]}, res.merged, res.dates, st, res.observation)


def syndication_staged(inputs, ssot, opts: Options) -> dict:
    wm = watermark.watermark_value(ssot, "syndication", dates=opts.fact_dates)
    pulled = _materialize(pull.pull_syndication(inputs["fact_syndication_revenue"], wm), opts, "syndication_pull")
    has = watermark.has_new_data(pulled, "event_date", wm)
    exploded = explode.syndication_explode(pulled, remainder=opts.explode_remainder)
    if has:
        exploded = _materialize(exploded, opts, "syndication_explode_data")
    return {"watermark": wm, "has_new_data": has, "pulled": pulled, "exploded": exploded}


def run_syndication(inputs, ssot, opts: Options) -> JobResult:
    st = syndication_staged(inputs, ssot, opts)
    if not st["has_new_data"]:        # H14: a skipped source is not merged
        return JobResult(ssot, False, {}, {"watermark": st["watermark"]})
    spec = merge.syndication_spec(opts.run_ts, st["watermark"], null_mode=opts.null_mode,
                                  watermark_on_insert=opts.watermark_on_insert, replace_dates=opts.replace_hours)
    res = _merge(ssot, st["exploded"], spec, opts, dates=_covered(st["exploded"], ssot, opts, st["watermark"]),
                 unique=opts.explode_remainder == "per_grain")
    return JobResult(res.table, True, {"exploded": st["exploded"]},
                     {"watermark": st["watermark"]}, res.merged, res.dates, st, res.observation)


# --- L-04 ------------------------------------------------------------------

DP_EXCLUDED_NETWORKS = (GAM_NETWORK, OWNER_NETWORK)


def ledger_staged(inputs, ssot, opts: Options) -> dict:
    """L-04 by the ledger: only pending reports, allocated over the fact rows of their dates alone."""
    reports = inputs["fact_demand_partner_reports"]
    pairs = _materialize(ledger.pending(reports, opts.ledger, opts.traffic), opts, "demand_partner_pending")
    known = set(opts.fact_dates or ())
    days = sorted({r["report_date"] for r in pairs.select("report_date").distinct().collect()} & known)
    st = {"watermark": None, "pairs": pairs, "dates": [], "decided": ledger.outcomes(pairs, None, None), "restated": None}
    if not days:
        return st
    pulled = ledger.of_pairs(pull.pull_date(reports, days), pairs)
    grouped = _materialize(grouping.group_demand_partner(pulled), opts, "demand_partner_grouping")
    slice_df = allocation.ssot_slice(ssot, days, exclude_networks=DP_EXCLUDED_NETWORKS)
    allocated = _materialize(allocation.demand_partner_allocation(grouped, slice_df, inputs["dim_ad_unit_mapping"],
                                                                  mode=opts.dp_allocation), opts,
                             "demand_partner_allocation")
    restated = pairs.where(F.col("reason").isin("restated", "withdrawn")).select(
        F.col("report_date").alias("event_date"), F.col("partner_name").alias("network"))
    touched = sorted(({d for d in _dates(allocated)} | {r[0] for r in restated.select("event_date").distinct().collect()}) & known)
    decided = _materialize(ledger.outcomes(pairs, allocated, slice_df), opts, "demand_partner_decided")
    return {**st, "pulled": pulled, "grouped": grouped, "slice": slice_df, "allocated": allocated, "restated": restated,
            "decided": decided, "dates": touched}


def demand_partner_staged(inputs, ssot, opts: Options) -> dict:
    reports = inputs["fact_demand_partner_reports"]
    wm = watermark.watermark_value(ssot, "demand_partner", dates=opts.fact_dates)
    waiting = []
    if opts.skip_gaps:
        # H8: a date without traffic must not hold up the others; take all that can be allocated, report the rest.
        # The watermark may be far ahead of a waiting or late report, so every date is looked at
        pairs = delta.unprocessed_pairs(reports, ssot, wm, lookback_days=None)
        found = delta.with_traffic(pairs, ssot).groupBy("report_date").agg(
            F.max("has_traffic").alias("ready"), F.count_if(~F.col("has_traffic")).alias("waiting")).collect()  # a row per day
        dates = sorted(r["report_date"] for r in found if r["ready"])
        waiting = sorted(r["report_date"] for r in found if r["waiting"])
        if opts.catch_up:
            dates = sorted({*dates, *delta.pending_dates(reports, ssot, wm, lookback_days=opts.lookback_days)})
    elif opts.catch_up:
        dates = delta.pending_dates(reports, ssot, wm, lookback_days=opts.lookback_days)
    else:
        row = delta.oldest_unprocessed(reports, ssot, wm, lookback_days=opts.lookback_days).first()
        dates = [row["increment_column"]] if row is not None and row["has_new_data"] else []
    if not dates:
        return {"watermark": wm, "dates": [], "waiting": waiting}
    pulled = pull.pull_date(reports, dates)
    grouped = _materialize(grouping.group_demand_partner(pulled), opts, "demand_partner_grouping")
    slice_df = allocation.ssot_slice(ssot, dates, exclude_networks=DP_EXCLUDED_NETWORKS)
    allocated = _materialize(allocation.demand_partner_allocation(grouped, slice_df, inputs["dim_ad_unit_mapping"],
                                                                  mode=opts.dp_allocation), opts,
                             "demand_partner_allocation")
    return {"watermark": wm, "dates": dates, "waiting": waiting, "pulled": pulled, "grouped": grouped,
            "slice": slice_df, "allocated": allocated}


def run_demand_partner(inputs, ssot, opts: Options) -> JobResult:
    if opts.ledger is not None:
        st = ledger_staged(inputs, ssot, opts)
        waiting = st["decided"].where(F.col("outcome") == ledger.WAITING).select("report_date").distinct().collect()
        st["waiting"] = sorted(r[0] for r in waiting)
    else:
        st = demand_partner_staged(inputs, ssot, opts)
    if not st["dates"]:
        return JobResult(ssot, False, {}, {"watermark": st["watermark"], "waiting": st["waiting"]}, detail=st)
    spec = merge.demand_partner_spec(opts.run_ts, null_mode=opts.null_mode, restated=st.get("restated"))
    res = _merge(ssot, st["allocated"], spec, opts, dates=st["dates"], unique=opts.dp_allocation == "per_path")
    return JobResult(res.table, True,
                     {"grouped": st["grouped"], "allocated": st["allocated"]},
                     {"watermark": st["watermark"], "dates": st["dates"], "waiting": st["waiting"]},
                     res.merged, res.dates, st, res.observation)


# --- L-05 ------------------------------------------------------------------

def gam_staged(inputs, ssot, opts: Options) -> dict:
    gam = inputs["fact_gam_data_transfer"]
    wm = watermark.watermark_value(ssot, "gam", dates=opts.fact_dates)
    day_wm = wm
    read = opts.progress.get("gam")
    if read is not None and read > pull.as_date(wm):
        day_wm = read      # H6: a day that was read but matched no traffic is done, too
    if opts.skip_gaps and not opts.catch_up:
        # H6: a day without GAM rows would stall the one-day step; jump to the next day with data
        nxt = gam.where(pull.gam_days(day_wm, opts.today_date, catch_up=True)).agg(
            F.min(F.to_date("timestamp"))).first()[0]
        if nxt is not None:
            day_wm = nxt - _dt.timedelta(days=1)
    pulled = pull.pull_next_day(gam, day_wm, opts.today_date, catch_up=opts.catch_up,
                                partition_col=opts.gam_partition_col)
    grouped = _materialize(grouping.group_gam(pulled, inputs["dim_country_mapping"]), opts, "GAM_grouping")
    # pulled days = days of the (small, staged) hourly totals
    dates = sorted(r[0] for r in grouped.select("event_date").distinct().collect() if r[0] is not None)
    slice_df = allocation.ssot_slice(ssot, dates, networks=[GAM_NETWORK])
    allocated = _materialize(allocation.gam_allocation(slice_df, grouped, inputs["dim_ad_unit_mapping"],
                                                       null_mode=opts.null_mode, count_method=opts.count_method),
                             opts, "GAM_allocation")
    return {"watermark": wm, "dates": dates, "pulled": pulled, "grouped": grouped, "slice": slice_df,
            "allocated": allocated}


def run_gam(inputs, ssot, opts: Options) -> JobResult:
    if opts.gam_hour is not None and not watermark.gam_due(opts.run_ts, opts.gam_hour):
        return JobResult(ssot, False, {}, {"gate": False})
    st = gam_staged(inputs, ssot, opts)
    if not st["dates"]:
        return JobResult(ssot, False, {}, {"watermark": st["watermark"]})
    spec = merge.gam_spec(opts.run_ts, st["watermark"], null_mode=opts.null_mode)
    res = _merge(ssot, st["allocated"], spec, opts, dates=st["dates"])
    return JobResult(res.table, True,
                     {"grouped": st["grouped"], "allocated": st["allocated"]},
                     {"watermark": st["watermark"], "dates": st["dates"]}, res.merged, res.dates, st, res.observation)


# --- L-06 ------------------------------------------------------------------

ORDER = ["events_stream", "ssp", "syndication", "demand_partner", "gam"]
RUNNERS = {"events_stream": run_events, "ssp": run_ssp, "syndication": run_syndication,
           "demand_partner": run_demand_partner, "gam": run_gam}


@dataclass
class Consolidation:
    ssot: DataFrame
    stages: dict            # source -> fact table after that source's merge
    results: dict           # source -> JobResult

    def staged(self) -> dict:
        return {k: r.staged for k, r in self.results.items() if r.ran and k != "events_stream"}

    def checks(self, opts: Options, **kw) -> DataFrame:
        return dq.run_checks(self.ssot, self.staged(), null_mode=opts.null_mode,
                             bounding_mode=opts.bounding_mode, **kw)


def consolidate(inputs: Mapping[str, DataFrame], ssot: DataFrame, opts: Options,
                sources=tuple(ORDER)) -> Consolidation:
    """Run the source jobs strictly in order on an in-memory fact table."""
    stages, results = {}, {}
    cur = ssot.select(*SSOT_COLUMNS)
    for name in ORDER:
        if name not in sources:
            continue
        r = RUNNERS[name](inputs, cur, opts)
        results[name] = r
        cur = r.ssot
        stages[name] = cur
    return Consolidation(cur, stages, results)


def _ledger(spark: SparkSession, path: str, version, inputs: Mapping[str, DataFrame]) -> DataFrame:
    """The committed ledger. A table from before the ledger is read once: what it holds revenue of counts as allocated."""
    from tallyhour.sources import versions

    if ledger.LEDGER in version.side or not version.dates:
        return versions.read_side(spark, path, ledger.LEDGER, ledger.LEDGER_SCHEMA, version)
    reports = inputs["fact_demand_partner_reports"]
    waiting = delta.unprocessed_pairs(reports, versions.read(spark, path, version), None, lookback_days=None)
    done = ledger.digests(reports).join(waiting, ["report_date", "partner_name"], "left_anti")
    seen = done.select("*", F.lit(ledger.ALLOCATED).alias("outcome"))
    empty = spark.createDataFrame([], ledger.LEDGER_SCHEMA)
    return stage_table(ledger.updated(empty, seen, version.traffic, _dt.datetime(1970, 1, 1)), "ledger")


def _commit(spark: SparkSession, path: str, version, name: str, r: JobResult, opts: Options, on_commit: Callable | None):
    """Write what a job merged, its ledger and its progress, check the counts, and switch to them; the new version."""
    from tallyhour.sources import versions

    commit = versions.begin(spark, path, version)
    counts = {}
    if r.ran and r.merged is not None:
        after = commit.write(r.merged, r.dates, traffic=name == "events_stream")
        before = {k: version.rows.get(k, 0) for k in after}
        if r.observation is not None:
            counts = dict(r.observation.get)
            merge.check_counts(before, after, counts)
    decided = r.detail.get("decided") if name == "demand_partner" else None
    if decided is not None and (r.ran or decided.take(1)):
        commit.write_side(ledger.LEDGER, ledger.updated(opts.ledger, decided, version.traffic, opts.run_ts))
    files = r.detail.get("files") if name == "events_stream" else None
    if files is not None and files.take(1):
        commit.write_side(arrivals.FILES, opts.events_files.unionByName(files))
    if name == "gam" and r.info.get("dates"):
        commit.progress["gam"] = max(r.info["dates"]).isoformat()
    if not (commit.dates or commit.side or commit.progress):
        return version
    commit.info = {"source": name, "run_ts": opts.run_ts.isoformat(), **counts}
    if on_commit is not None:
        on_commit(name, commit)
    return commit.switch()


def run_all(spark: SparkSession, inputs: Mapping[str, DataFrame], ssot_path: str, opts: Options,
            sources=tuple(ORDER), raise_on_blocking: bool = True, on_commit: Callable | None = None) -> DataFrame:
    """Persisted pipeline: each job commits its touched partitions, ledger and progress as a new version
    of the table at ``ssot_path``, then the DQ suite runs; a blocking failure raises after the report is built.

    Merged rows are written once, where they stay; what the merge did is counted in the same pass
    and kept with the version (``versions.history``). A run that ends early leaves the last committed
    version. ``on_commit(source, commit)`` is called before each switch; an error there ends the
    run without it. Staged tables live in one scratch folder, removed at the end.
    """
    from tallyhour.sources import versions

    configure(spark)
    version = versions.create(spark, ssot_path)
    with run_scratch(spark):
        results = {}
        for name in ORDER:
            if name not in sources:
                continue
            cur = versions.read(spark, ssot_path, version)
            progress = {k: _dt.date.fromisoformat(d) for k, d in version.progress.items()}
            own = opts.with_(materialize=True, observe=True, compact=False, stage_format="parquet",
                             fact_dates=tuple(versions.dates_of(version)), progress={**progress, **opts.progress},
                             traffic=version.traffic)
            if name == "events_stream" and opts.track_files:
                own = own.with_(events_files=versions.read_side(spark, ssot_path, arrivals.FILES, arrivals.FILES_SCHEMA, version))
            if name == "demand_partner" and opts.dp_ledger:
                own = own.with_(ledger=_ledger(spark, ssot_path, version, inputs))
            results[name] = r = RUNNERS[name](inputs, cur, own)
            version = _commit(spark, ssot_path, version, name, r, own, on_commit)
        final = versions.read(spark, ssot_path, version)
        staged = {k: r.staged for k, r in results.items() if r.ran and k != "events_stream"}
        touched = sorted({d for r in results.values() for d in (r.dates or []) if d is not None})
        report = dq.run_checks(final, staged, null_mode=opts.null_mode, bounding_mode=opts.bounding_mode,
                               dates=touched if opts.dq_scope == "touched" else None)
        rows = report.collect()  # seven rows
        versions.expire(spark, ssot_path, keep=opts.keep_versions)
    report = spark.createDataFrame(rows, report.schema)
    if raise_on_blocking:
        failed = [r["name"] for r in rows if r["status"] == "FAIL"]
        if failed:
            raise dq.BlockingCheckError(f"DQ blocking checks failed: {', '.join(failed)}")
    return report
