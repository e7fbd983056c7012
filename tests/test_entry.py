import importlib.util
import os
import re

import duckdb

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(HERE, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_smoke(spark):
    df = _entry().entry(spark)
    assert "tracked_event_count" in df.columns and df.count() > 0


def test_every_query_has_oracle_and_matches(spark):
    m = _entry()
    qs, sqls = m.queries(), m.oracle_sql()
    own = {q for q in qs if q != "pipeline" and not re.match(r"op\d+_", q)}  # the others need no SQL
    assert own <= set(sqls) <= set(qs)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    for name in ["events_hourly_grouping", "gam_allocation", "dp_allocation", "ssp_explode", "merge_ssp_safe",
                 "consolidated_all_sources", "dq_suite", "dp_smart_delta", "url_shapes", "staging_by_expression",
                 "safe_single_step_events_gap", "parity_single_step_events_gap", "safe_single_step_dp_head_of_line",
                 "ssp_explode_twins", "ssp_explode_twins_safe", "dp_allocation_twins", "dp_allocation_twins_safe",
                 "merge_replace_hours", "gam_allocation_exact_counts", "dp_ledger_late_and_restated", "merge_overlap_counts"]:
        df = qs[name](spark, SF)
        cols = sorted(df.columns)
        got = sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.select(*cols).collect()),
                     key=repr)
        cur = con.execute(sqls[name])
        ocols = [d[0] for d in cur.description]
        assert sorted(ocols) == cols, name
        idx = [ocols.index(c) for c in cols]
        exp = sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in idx) for r in cur.fetchall()),
                     key=repr)
        assert got == exp, name
