"""Rows and dates that several test modules share (a module of its own: two folders have a conftest)."""

import datetime as dt

from tallyhour.schemas import SSOT_SCHEMA

RUN_TS = dt.datetime(2024, 2, 1, 17, 0, 0)


def ssot_rows(spark, rows):
    """Fact-table DataFrame from dicts; unspecified columns are null."""
    names = [f.name for f in SSOT_SCHEMA.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SSOT_SCHEMA)


def fact(day=1, hour=0, **kw):
    base = {"event_date": dt.date(2024, 1, day), "event_hour": dt.datetime(2024, 1, day, hour),
            "event": "served", "organization_id": "org_0"}
    base.update(kw)
    return base
