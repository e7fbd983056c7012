from pyspark.sql import functions as F

from tallyhour.functions.exprs import (allocate_count, canonical_network, domain_of, proportional_weight)
from tallyhour.operators.explode import spread_count


def test_url_host(spark):
    df = spark.createDataFrame([("https://www.a.com/x",), ("http://m.b.org:80",), ("bad url",), (None,),
                                ("www.c.net/path",), ("https://user@www.d.io?q=1",)], "url string")
    got = [r[0] for r in df.select(domain_of("url")).collect()]
    assert got == ["a.com", "m.b.org", None, None, "c.net", "d.io"]


def test_url_host_of_unusual_urls(spark):
    urls = {"https://bücher.de/a": "bücher.de", "https://[::1]/x": "[::1]", "https://[2001:db8::1]:8080/": "[2001:db8::1]",
            "//cdn.example.com/x": "cdn.example.com", "   https://www.pad.com/  ": "pad.com", "HTTP://Up.Case": "Up.Case",
            "ftp://u:p@h.x:21/f?a=b@c": "h.x", "https:///path": None, "https://": None, "": None, "h.x:port": None,
            "host.only?q=//other.com": "host.only", "a.b#frag": "a.b", "https://x.y\\": "x.y\\"}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r[0]: r[1] for r in df.select("url", domain_of("url")).collect()} == urls


def test_canonical_network(spark):
    df = spark.createDataFrame([("Prebid", "Magnite"), ("GAM", "Magnite"), (None, "x")], "n string, p string")
    assert [r[0] for r in df.select(canonical_network("n", "p")).collect()] == ["Magnite", "GAM", None]


def test_weight_zero_and_null_denominator(spark):
    df = spark.createDataFrame([(0, 0), (None, None), (1, 4), (3, None)], "x bigint, t bigint")
    assert [r[0] for r in df.select(proportional_weight("x", "t")).collect()] == [0.0, 0.0, 0.25, 0.0]


def test_count_rounding_half_away_from_zero(spark):
    df = spark.createDataFrame([(5, 0.5), (3, 0.5), (1, 0.25)], "n bigint, w double")
    assert [r[0] for r in df.select(allocate_count("n", "w")).collect()] == [3, 2, 0]


def test_spread_count(spark):
    df = spark.createDataFrame([(50,), (24,), (23,), (0,), (-25,)], "n bigint")
    first = [r[0] for r in df.select(spread_count("n", F.lit(True))).collect()]
    other = [r[0] for r in df.select(spread_count("n", F.lit(False))).collect()]
    assert first == [4, 1, 23, 0, -2] and other == [2, 1, 0, 0, -1]
