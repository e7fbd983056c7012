import datetime as dt

from pyspark.sql import functions as F

from tallyhour.operators import pull, watermark
from tallyhour.schemas import EVENTS_STREAM_SCHEMA, GAM_SCHEMA
from tallyhour.sources.tables import empty_ssot

from helpers import fact, ssot_rows


def _events(spark, stamps):
    rows = [(ts, "served", "org_0", "/u", "display", "GAM", None, "https://www.s.com/p", "1", None, None, "US", 1.0)
            for ts in stamps]
    return spark.createDataFrame(rows, EVENTS_STREAM_SCHEMA)


def test_hour_boundary_half_open_vs_exclusive(spark):
    wm = dt.datetime(2024, 1, 1, 10)
    ev = _events(spark, [dt.datetime(2024, 1, 1, 10, 0, 0), dt.datetime(2024, 1, 1, 10, 30)])
    assert pull.pull_events(ev, wm, bounds="half_open").count() == 2
    assert pull.pull_events(ev, wm, bounds="exclusive").count() == 1


def test_five_day_upper_bound(spark):
    wm = dt.datetime(2024, 1, 1, 10)
    ev = _events(spark, [wm + dt.timedelta(days=5)])
    assert pull.pull_events(ev, wm, bounds="half_open").count() == 0
    assert pull.pull_events(ev, wm, bounds="exclusive").count() == 1
    assert pull.pull_events(ev, wm, span=None, bounds="exclusive").count() == 1


def test_pull_columns_and_flags(spark):
    rows = [(dt.datetime(2024, 1, 1, 3, 15), "served", "o", None, "video", "Prebid", "Magnite", "http://www.x.org/a",
             None, None, None, None, 2.5),
            (dt.datetime(2024, 1, 1, 3, 45), "served", "o", None, "video", "MinuteSSP", None, None, None, None, None,
             None, 4.0)]
    ev = spark.createDataFrame(rows, EVENTS_STREAM_SCHEMA)
    out = pull.pull_events(ev, None, span=None).orderBy("timestamp").collect()
    assert out[0]["network"] == "Magnite" and out[0]["is_actual_revenue"] == 0 and out[0]["domain"] == "x.org"
    assert out[0]["event_hour"] == dt.datetime(2024, 1, 1, 3) and out[0]["revenue"] == 0.0025
    assert out[1]["is_actual_revenue"] == 1


def test_gam_next_complete_day(spark):
    rows = [(dt.datetime(2024, 1, d, 5), "s", "1000", "1", "France", 1, 1.0) for d in (1, 2, 3, 4)]
    gam = spark.createDataFrame(rows, GAM_SCHEMA)
    wm = dt.datetime(2024, 1, 1, 23, 10)
    days = lambda df: sorted({r[0].day for r in df.select(F.to_date("timestamp")).collect()})
    assert days(pull.pull_next_day(gam, wm, dt.date(2024, 1, 4))) == [2]
    assert days(pull.pull_next_day(gam, wm, dt.date(2024, 1, 4), catch_up=True)) == [2, 3]
    assert days(pull.pull_next_day(gam, wm, dt.date(2024, 1, 2))) == []


def test_watermarks_default_trunc_and_filters(spark):
    empty = empty_ssot(spark)
    assert watermark.watermark_value(empty, "events_stream") == dt.datetime(1970, 1, 1)
    assert watermark.watermark_value(empty, "events_stream", use_default=False) is None
    s = ssot_rows(spark, [
        fact(max_events_stream_timestamp=dt.datetime(2024, 1, 1, 3, 59), network="GAM", tracked_event_count=1),
        fact(network="MinuteSSP", tracked_event_count=5, max_ssp_date=dt.date(2024, 1, 9)),
        fact(network="MinuteSSP", max_ssp_date=dt.date(2024, 1, 3)),
        fact(network="Syndication", max_syndication_date=dt.date(2024, 1, 7)),
    ])
    assert watermark.watermark_value(s, "events_stream") == dt.datetime(2024, 1, 1, 3)
    assert watermark.watermark_value(s, "ssp") == dt.date(2024, 1, 3)
    assert watermark.watermark_value(s, "syndication") == dt.date(2024, 1, 7)
    assert watermark.watermark_value(s, "gam") == dt.datetime(1970, 1, 1)


def test_gates(spark):
    assert watermark.gam_due(dt.datetime(2024, 1, 1, 17, 5))
    assert not watermark.gam_due(dt.datetime(2024, 1, 1, 16, 59))
    df = spark.createDataFrame([(dt.date(2024, 1, 2), "owned"), (dt.date(2024, 1, 3), "external")],
                               "report_date date, site_type string")
    assert watermark.ssp_new_data(df, dt.date(2024, 1, 2)).first()[0] is True
    assert watermark.ssp_new_data(df, dt.date(2024, 1, 3)).first()[0] is False
    assert watermark.has_new_data(df, "report_date", dt.date(2024, 1, 1))
