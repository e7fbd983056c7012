"""Benchmark: headline stages of the consolidation pipeline at one scale factor.

Prints one JSON line. Each stage is timed on its own (inputs of the stage
materialised beforehand, output forced with the ``noop`` sink so nothing is
collected), median of ``BENCH_REPEAT`` warm runs; ``pipeline`` is the whole
backfill (five sources, five merges, checkpoints) end to end in memory.
``pipeline_persisted``, the headline, is the hardened run on a partitioned parquet
fact table (``run_all``: staged sources, touched partitions rewritten, DQ suite), and
``hour_over_history`` one more such run over that table after a day was added.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyhour.operators import allocation, explode, grouping, pull  # noqa: E402
from tallyhour.plans import scenarios  # noqa: E402
from tallyhour.plans.backfill import scenario_options  # noqa: E402
from tallyhour.plans.jobs import consolidate, run_all  # noqa: E402
from tallyhour.session import build_session, scratch_path  # noqa: E402
from tallyhour.sources.fixtures import derived_inputs  # noqa: E402
from tallyhour.sources.staging import stage_table  # noqa: E402
from tallyhour.sources.tables import empty_ssot  # noqa: E402


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _time(fn, repeat: int) -> float:
    fn()  # warm-up
    ts = []
    for _ in range(repeat):
        t = time.perf_counter()
        fn()
        ts.append(time.perf_counter() - t)
    return round(statistics.median(ts), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app_name="tallyhour-bench")
    opts = scenario_options("parity")
    inputs = derived_inputs(spark, sf_dir)
    # Materialise the derived inputs once: the bench measures the pipeline, not the fixture derivation.
    inputs = {k: (stage_table(v, k) if not k.startswith("dim_") else v) for k, v in inputs.items()}

    # Reference run (untimed) gives each stage its real input state.
    ref = consolidate(inputs, empty_ssot(spark), opts)
    st = ref.stages
    gam = ref.results["gam"].detail
    dp = ref.results["demand_partner"].detail
    ssp = ref.results["ssp"].detail
    syn = ref.results["syndication"].detail

    q = {}
    q["events_hourly_grouping"] = _time(lambda: _force(grouping.group_events(
        pull.pull_events(inputs["events_stream"], None, span=None), inputs["dim_line_items_mapping"])), repeat)
    q["gam_hourly_grouping"] = _time(lambda: _force(grouping.group_gam(
        gam["pulled"], inputs["dim_country_mapping"])), repeat)
    q["gam_allocation"] = _time(lambda: _force(allocation.gam_allocation(
        allocation.ssot_slice(st["demand_partner"], gam["dates"], networks=["GAM"]), gam["grouped"],
        inputs["dim_ad_unit_mapping"], null_mode=opts.null_mode)), repeat)
    q["dp_allocation"] = _time(lambda: _force(allocation.demand_partner_allocation(
        dp["grouped"], allocation.ssot_slice(st["syndication"], dp["dates"], exclude_networks=["GAM", "MinuteSSP"]),
        inputs["dim_ad_unit_mapping"], mode=opts.dp_allocation)), repeat)
    q["ssp_explode"] = _time(lambda: _force(explode.ssp_explode(
        ssp["pulled"], inputs["dim_country_mapping"], remainder=opts.explode_remainder)), repeat)
    q["syndication_explode"] = _time(lambda: _force(explode.syndication_explode(
        syn["pulled"], remainder=opts.explode_remainder)), repeat)
    q["dq_suite"] = _time(lambda: ref.checks(opts).collect(), repeat)
    q["pipeline"] = _time(lambda: consolidate(inputs, empty_ssot(spark), opts).ssot.count(), max(1, repeat - 1))
    # production path: partitioned parquet fact table, touched partitions rewritten per merge
    safe = scenario_options("safe")
    q["pipeline_persisted"] = _time(lambda: run_all(spark, inputs, scratch_path(spark, "bench_ssot"), safe), 1)
    path = scratch_path(spark, "bench_history")
    run_all(spark, scenarios.before(inputs, scenarios.LAST_DAY), path, safe)
    t = time.perf_counter()
    run_all(spark, inputs, path, safe.with_(catch_up=False))
    q["hour_over_history"] = round(time.perf_counter() - t, 3)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "pipeline_persisted_sec", "value": q["pipeline_persisted"], "unit": "sec", "queries": q,
                      "sf": float(sf.group(1)) if sf else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
