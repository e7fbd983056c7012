"""Idempotent MERGE into the partitioned fact table (I-01..I-07).

Parquet tables have no row-level MERGE, so a merge is expressed as a join:

1. the source's distinct ``event_date`` values (bounded by days) select the
   touched partitions; untouched partitions are neither read nor rewritten by
   the writer (partition pruning on the IN list);
2. a source key that would match one target row twice is an error (I-07);
3. upsert = full outer join, update-only = left join, on the grain, each
   output column resolved with ``when(matched ...)``; target rows of a touched
   partition that ``prune`` keeps from matching are carried through unchanged,
   since their whole partition is rewritten;
4. with a replacement rule (``MergeSpec.replace``), target rows that the source
   should hold but does not are deleted or emptied (H19, H20);
5. the result is ``untouched UNION merged``; a versioned commit (``sources.versions``)
   writes the merged partitions and switches to them; rows in, rows out and the
   counts observed in the same pass must add up (:func:`check_counts`).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyhour.functions.exprs import ts_lit
from tallyhour.schemas import GAM_NETWORK, GRAIN, NULL_SENTINEL, OWNER_NETWORK, REQUIRED_GRAIN

SRC = "_s_"
#: Marks target rows that join ``MergeSpec.scope``.
IN_SCOPE = "_in_scope"


def S(c: str) -> Column:
    """Source column inside merge expressions."""
    return F.col(SRC + c)


def T(c: str) -> Column:
    """Target column inside merge expressions."""
    return F.col(c)


class MergeCardinalityError(RuntimeError):
    """A target row is matched by more than one source row."""


class MergeLossError(RuntimeError):
    """A merge would write fewer rows for a date than it replaces."""


@dataclass
class MergeSpec:
    update: Mapping[str, Column]
    insert: Mapping[str, Column] | None = None
    keys: Sequence[str] = field(default_factory=lambda: list(GRAIN))
    plain_keys: Sequence[str] = ()
    null_mode: str = "null_safe"
    target_condition: Column | None = None
    prune: Column | None = None
    date_col: str = "event_date"
    #: target rows that the source covers; those without a source row are withdrawn
    replace: Column | None = None
    #: rows (of some grain columns, distinct) that ``replace`` can test as ``IN_SCOPE``
    scope: DataFrame | None = None
    #: which withdrawn rows are deleted, and what the others are set to
    delete: Column | None = None
    withdraw: Mapping[str, Column] = field(default_factory=dict)
    #: matched target rows that count as overlaps between two sources (H18)
    overlap: Column | None = None


@dataclass
class MergeResult:
    table: DataFrame            # full new target
    merged: DataFrame | None    # rows of the touched partitions only
    dates: list                 # touched partition values
    observation: Observation | None = None


def _key_eq(k: str, spec: MergeSpec) -> Column:
    t, s = F.col(k), S(k)
    if spec.null_mode == "null_safe":
        return t.eqNullSafe(s)
    if k in spec.plain_keys:
        return t == s
    if spec.null_mode == "sentinel":
        return F.coalesce(t, F.lit(NULL_SENTINEL)) == F.coalesce(s, F.lit(NULL_SENTINEL))
    raise ValueError(f"unknown null mode {spec.null_mode!r}")


def join_condition(spec: MergeSpec) -> Column:
    cond = None
    for k in spec.keys:
        c = _key_eq(k, spec)
        cond = c if cond is None else cond & c
    if spec.target_condition is not None:
        cond = cond & spec.target_condition
    return cond


def _normalised_keys(spec: MergeSpec) -> list[Column]:
    out = []
    for k in spec.keys:
        c = S(k)
        if spec.null_mode == "sentinel" and k not in spec.plain_keys:
            c = F.coalesce(c, F.lit(NULL_SENTINEL))
        out.append(c.alias("_nk_" + k))
    return out


def source_profile(src: DataFrame, spec: MergeSpec):
    """One aggregate over the (prefixed) source: the largest number of source rows sharing a
    merge key (rows whose plain keys are null can never match and are not counted) and the
    distinct partition values (bounded by the number of days)."""
    valid = F.lit(True)
    if spec.null_mode != "null_safe":
        for k in spec.plain_keys:
            valid = valid & F.col("_nk_" + k).isNotNull()
    per_key = src.groupBy(*_normalised_keys(spec)).agg(F.count(F.lit(1)).alias("_n"))
    date = F.col("_nk_" + spec.date_col)
    return per_key.agg(F.max(F.when(valid, F.col("_n"))).alias("max_dup"), F.collect_set(date).alias("dates"),
                       F.coalesce(F.max(date.isNull()), F.lit(False)).alias("null_date")).first()


def check_single_match(touched: DataFrame, src: DataFrame, spec: MergeSpec) -> None:
    """I-07: raise if some target row would be matched by two or more source rows.

    Source keys are grouped under the merge's own equality (sentinel or
    null-safe); only duplicated keys that actually meet a target row fail.
    """
    s = src
    if spec.null_mode != "null_safe":
        for k in spec.plain_keys:
            s = s.where(S(k).isNotNull())
    dup_keys = s.groupBy(*_normalised_keys(spec)).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    if not dup_keys.take(1):
        return
    dups = s.join(dup_keys.drop("_n"),
                  [(F.coalesce(S(k), F.lit(NULL_SENTINEL)) if (spec.null_mode == "sentinel" and k not in spec.plain_keys)
                    else S(k)).eqNullSafe(F.col("_nk_" + k)) for k in spec.keys], "left_semi")
    hit = touched.join(dups, join_condition(spec), "left_semi").take(1)
    if hit:
        raise MergeCardinalityError(
            f"merge would update one target row from several source rows; first such target row: {hit[0].asDict()}")


def check_no_loss(before: DataFrame, merged: DataFrame, dates: Sequence, date_col: str = "event_date") -> None:
    """Raise if some touched date would keep fewer rows than it had.

    A merge only adds or updates rows, so no date can have fewer than before. One narrow
    aggregate over both sides; at most ten offending dates reach the driver.
    """
    days = [d for d in dates if d is not None]
    here = F.coalesce(F.col(date_col).isin(days), F.lit(False)) if days else F.lit(False)
    if len(days) < len(dates):
        here = here | F.col(date_col).isNull()
    old = before.where(here).select(date_col, F.lit(1).alias("_b"), F.lit(0).alias("_a"))
    new = merged.select(date_col, F.lit(0).alias("_b"), F.lit(1).alias("_a"))
    lost = (old.unionByName(new).groupBy(date_col).agg(F.sum("_b").alias("before"), F.sum("_a").alias("after"))
            .where("after < before").orderBy(date_col).limit(10).collect())
    if lost:
        raise MergeLossError("merge would lose fact rows: " + ", ".join(
            f"{r[date_col]}: {r['before']} -> {r['after']}" for r in lost))


def check_counts(before: Mapping, after: Mapping, observed: Mapping[str, int]) -> None:
    """Raise unless the touched dates hold the rows they had, those inserted, less those deleted.

    ``before`` and ``after`` are exact rows by date. Observed counts can be too high where a stage
    ran again after a lost executor, so a difference alone is no proof: it is one if rows
    were deleted, or if some date has fewer rows than before.
    """
    expected = sum(before.values()) + observed["inserted"] - observed["deleted"]
    if sum(after.values()) == expected:
        return
    lost = {d: (n, after.get(d, 0)) for d, n in before.items() if after.get(d, 0) < n}
    if lost or observed["deleted"]:
        raise MergeLossError(f"merge would hold {sum(after.values())} rows where {expected} are due: " + ", ".join(
            f"{d}: {a} -> {b}" for d, (a, b) in sorted(lost.items())[:10]))


def merge_into(target: DataFrame, source: DataFrame, spec: MergeSpec, *,
               dates: Iterable | None = None, check_cardinality: bool = True, observation: Observation | None = None,
               materialize: Callable[[DataFrame], DataFrame] | None = None,
               materialize_scope: str = "merged") -> MergeResult:
    """Merge ``source`` into ``target`` (both DataFrames); returns the new target.

    ``source`` should be materialised (a staged table): its dates, the
    cardinality check and the join all read it. ``materialize`` (e.g. a
    checkpoint) is applied to the merged touched partitions (``merged``: what a
    partition-level writer needs) or to the whole new table (``table``: keeps an
    in-memory table compact, one piece instead of a growing union); the new
    target is ``untouched UNION merged``. ``observation`` collects, while the merged rows are
    computed, how many target rows were matched, withdrawn, deleted or overlapping and how many
    source rows were inserted.
    """
    dc = spec.date_col
    src = source.select(*[F.col(c).alias(SRC + c) for c in source.columns], F.lit(True).alias(SRC + "present"))
    max_dup, null_date = None, dates is not None and None in dates
    if dates is None or check_cardinality:
        prof = source_profile(src, spec)
        max_dup = prof["max_dup"]
        if dates is None:
            dates, null_date = prof["dates"], prof["null_date"]
    dates = sorted(d for d in dates if d is not None)
    if not dates and not null_date:
        return MergeResult(target, None, [])
    in_touched = F.coalesce(F.col(dc).isin(dates), F.lit(False)) if dates else F.lit(False)
    if null_date:  # the partition of rows without a date is rewritten like any other
        in_touched = in_touched | F.col(dc).isNull()
    untouched = target.where(~in_touched)
    touched, carried = target.where(in_touched), None
    if spec.prune is not None:  # rows that cannot match stay as they are in their partition
        eligible = F.coalesce(spec.prune, F.lit(False))
        carried = touched.where(~eligible)
        touched = touched.where(eligible)
    if check_cardinality and (max_dup or 0) > 1:
        check_single_match(touched, src, spec)
    t = touched.withColumn("_t_present", F.lit(True))
    if spec.scope is not None:
        keys = spec.scope.columns
        scope = spec.scope.select(*[F.col(k).alias("_k_" + k) for k in keys], F.lit(True).alias(IN_SCOPE))
        for i, k in enumerate(keys):
            on = t[k].eqNullSafe(scope["_k_" + k]) if i == 0 else on & t[k].eqNullSafe(scope["_k_" + k])  # noqa: F821
        t = t.join(scope, on, "left").drop(*["_k_" + k for k in keys])
    how = "full_outer" if spec.insert is not None else "left"
    j = t.join(src, join_condition(spec), how)
    matched = F.col("_t_present").isNotNull() & F.col(SRC + "present").isNotNull()
    source_only = F.col("_t_present").isNull()
    withdrawn = deleted = F.lit(False)
    if spec.replace is not None:
        withdrawn = F.col("_t_present").isNotNull() & F.col(SRC + "present").isNull() & F.coalesce(spec.replace, F.lit(False))
        if spec.delete is not None:
            deleted = withdrawn & F.coalesce(spec.delete, F.lit(False))
    if observation is not None:
        overlap = matched & F.coalesce(spec.overlap, F.lit(False)) if spec.overlap is not None else F.lit(False)
        j = j.observe(observation, *[F.count_if(c).alias(n) for n, c in (
            ("matched", matched), ("inserted", source_only), ("withdrawn", withdrawn & ~deleted), ("deleted", deleted),
            ("overlapping", overlap))])
    if spec.delete is not None:
        j = j.where(~deleted)
    cols = []
    for c in target.columns:
        e = T(c)
        if c in spec.update:
            e = F.when(matched, spec.update[c]).otherwise(e)
        if c in spec.withdraw:
            e = F.when(withdrawn, spec.withdraw[c]).otherwise(e)
        if spec.insert is not None:
            ins = spec.insert.get(c, F.lit(None))
            e = F.when(source_only, ins).otherwise(e)
        cols.append(e.cast(target.schema[c].dataType).alias(c))
    merged = j.select(*cols)
    if null_date:
        dates = [*dates, None]
    if materialize is not None and materialize_scope == "table":
        # one pass over the rows that stay: as two, every merge would double the table's pieces
        stays = untouched if carried is None else target.where(~(in_touched & eligible))
        table = materialize(stays.unionByName(merged))
        return MergeResult(table, table.where(in_touched), dates)
    if carried is not None:
        merged = merged.unionByName(carried.select(*target.columns))
    if materialize is not None:
        merged = materialize(merged)
    return MergeResult(untouched.unionByName(merged), merged, dates)


# ---------------------------------------------------------------------------
# The five source merges
# ---------------------------------------------------------------------------

def _insert_all(columns: Sequence[str], run_ts) -> dict[str, Column]:
    ins = {c: S(c) for c in columns}
    ins["dwh_created_at"] = ts_lit(run_ts)
    ins["dwh_updated_at"] = ts_lit(run_ts)
    return ins


def _unreconciled() -> Column:
    """Rows that only traffic has written to."""
    none = F.col("reconciled_event_count").isNull()
    for c in ("max_gam_timestamp", "max_demand_partner_date", "max_ssp_date", "max_syndication_date"):
        none = none & F.col(c).isNull()
    return none


def events_spec(run_ts: _dt.datetime, *, null_mode: str = "null_safe", owner_actual: str = "coalesce",
                owner: str = OWNER_NETWORK, replace_hours: tuple | None = None) -> MergeSpec:
    """I-01: events upsert. Actual revenue is overwritten only for the owner network
    (others keep what partner reconciliation wrote).

    ``replace_hours`` (first hour, hour after the last; either may be None) names hours that were
    pulled in full: their traffic rows without a source row are deleted, or, where another source
    has reconciled them, lose their traffic (H19).
    """
    if owner_actual == "replace":
        actual = F.when(S("network") == F.lit(owner), S("actual_revenue")).otherwise(T("actual_revenue"))
    elif owner_actual == "coalesce":
        actual = F.when(S("network") == F.lit(owner), F.coalesce(S("actual_revenue"), T("actual_revenue"))
                        ).otherwise(T("actual_revenue"))
    else:
        raise ValueError(owner_actual)
    update = {
        "tracked_event_count": S("tracked_event_count"),
        "estimated_revenue": S("estimated_revenue"),
        "actual_revenue": actual,
        "max_events_stream_timestamp": S("max_events_stream_timestamp"),
        "dwh_updated_at": ts_lit(run_ts),
    }
    insert = _insert_all(GRAIN + ["tracked_event_count", "actual_revenue", "estimated_revenue",
                                  "max_events_stream_timestamp"], run_ts)
    spec = MergeSpec(update=update, insert=insert, plain_keys=REQUIRED_GRAIN, null_mode=null_mode)
    if replace_hours is not None:
        lo, hi = replace_hours
        spec.replace = F.col("tracked_event_count").isNotNull()
        if lo is not None:
            spec.replace = spec.replace & (F.col("event_hour") >= ts_lit(lo))
        if hi is not None:
            spec.replace = spec.replace & (F.col("event_hour") < ts_lit(hi))
        spec.delete = _unreconciled()
        spec.withdraw = {"tracked_event_count": F.lit(None), "estimated_revenue": F.lit(None),
                         "max_events_stream_timestamp": F.lit(None), "dwh_updated_at": ts_lit(run_ts)}
    return spec


def _daily_spec(run_ts, wm, wm_col: str, *, null_mode: str, watermark_on_insert: bool, replace_dates: bool) -> MergeSpec:
    update = {
        "reconciled_event_count": S("reconciled_event_count"),
        "actual_revenue": S("actual_revenue"),
        wm_col: S(wm_col),
        "dwh_updated_at": ts_lit(run_ts),
    }
    cols = GRAIN + ["tracked_event_count", "reconciled_event_count", "actual_revenue", "estimated_revenue"]
    if watermark_on_insert:
        cols = cols + [wm_col]
    prune = None
    if wm is not None:
        prune = F.col("event_date") >= F.date_sub(F.lit(wm).cast("date"), 1)
    spec = MergeSpec(update=update, insert=_insert_all(cols, run_ts), plain_keys=REQUIRED_GRAIN + ["network"],
                     null_mode=null_mode, prune=prune, overlap=F.col("tracked_event_count").isNotNull())
    if replace_dates:  # the pull takes whole days from the watermark on
        spec.replace = F.col(wm_col).isNotNull()
        if wm is not None:
            spec.replace = spec.replace & (F.col("event_date") >= F.lit(wm).cast("date"))
        spec.delete = F.col("tracked_event_count").isNull()
        spec.withdraw = {"reconciled_event_count": F.lit(None), "actual_revenue": F.lit(None), wm_col: F.lit(None),
                         "dwh_updated_at": ts_lit(run_ts)}
    return spec


def ssp_spec(run_ts, wm=None, *, null_mode: str = "null_safe", watermark_on_insert: bool = True,
             replace_dates: bool = False) -> MergeSpec:
    """I-02: SSP upsert (reference omits ``max_ssp_date`` on insert: ``watermark_on_insert=False``).

    ``replace_dates``: rows that an earlier form of a re-pulled report wrote and this one does not
    hold are deleted, or emptied where they also hold traffic (H20). Rows that also hold
    first-party traffic count as overlaps (H18).
    """
    return _daily_spec(run_ts, wm, "max_ssp_date", null_mode=null_mode, watermark_on_insert=watermark_on_insert,
                       replace_dates=replace_dates)


def syndication_spec(run_ts, wm=None, *, null_mode: str = "null_safe",
                     watermark_on_insert: bool = True, replace_dates: bool = False) -> MergeSpec:
    """I-03: syndication upsert."""
    return _daily_spec(run_ts, wm, "max_syndication_date", null_mode=null_mode,
                       watermark_on_insert=watermark_on_insert, replace_dates=replace_dates)


def demand_partner_spec(run_ts, *, null_mode: str = "null_safe", restated: DataFrame | None = None) -> MergeSpec:
    """I-04: update-only; no row is created for a report without traffic.

    ``restated`` (event_date, network): rows that an earlier form of these reports filled and this
    one does not reach are emptied (H20).
    """
    update = {
        "reconciled_event_count": S("allocated_reconciled_event_count"),
        "actual_revenue": S("allocated_actual_revenue"),
        "max_demand_partner_date": S("max_demand_partner_date"),
        "dwh_updated_at": ts_lit(run_ts),
    }
    spec = MergeSpec(update=update, insert=None, plain_keys=REQUIRED_GRAIN + ["network", "country"], null_mode=null_mode)
    if restated is not None:
        spec.scope = restated
        spec.replace = F.col(IN_SCOPE).isNotNull() & F.col("max_demand_partner_date").isNotNull()
        spec.withdraw = {"reconciled_event_count": F.lit(None), "actual_revenue": F.lit(None),
                         "max_demand_partner_date": F.lit(None), "dwh_updated_at": ts_lit(run_ts)}
    return spec


def gam_spec(run_ts, wm=None, *, null_mode: str = "null_safe") -> MergeSpec:
    """I-05: update-only on GAM rows (no ghost rows without traffic)."""
    update = {
        "reconciled_event_count": S("allocated_reconciled_event_count"),
        "actual_revenue": S("allocated_actual_revenue"),
        "max_gam_timestamp": S("max_gam_timestamp"),
        "dwh_updated_at": ts_lit(run_ts),
    }
    prune = None
    if wm is not None:
        wm_date = wm.date() if isinstance(wm, _dt.datetime) else wm
        prune = F.col("event_date") >= F.date_sub(F.lit(wm_date).cast("date"), 1)
    return MergeSpec(update=update, insert=None, plain_keys=REQUIRED_GRAIN + ["network"], null_mode=null_mode,
                     target_condition=F.col("network") == F.lit(GAM_NETWORK), prune=prune)

