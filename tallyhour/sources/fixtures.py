"""Pipeline inputs derived from the driver's generated tables.

The driver ships TPC-H-style tables (``events``, ``lineitem``, ``orders``). The
revenue pipeline needs its own raw tables; these functions derive them with
DataFrame expressions so that every input grows with the scale factor:

* ``events_stream``            <- ``events``   (one row per event)
* ``fact_gam_data_transfer``   <- ``lineitem`` (one row per line item)
* ``fact_demand_partner_reports`` <- ``orders`` (one row per order)
* ``fact_ssp_report``          <- ``orders`` aggregated to report grain
* ``fact_syndication_revenue`` <- ``orders`` aggregated to report grain

The three dimensions are small fixed lookup tables.
"""

from __future__ import annotations

import os
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhour.schemas import (AD_UNIT_DIM_SCHEMA, COUNTRY_DIM_SCHEMA, LINE_ITEM_DIM_SCHEMA)

# Dimension contents used with the derived inputs.
DIMENSION_ROWS = {
    "dim_country_mapping": [
        ("United States", "US", "USA"), ("United Kingdom", "GB", "GBR"), ("France", "FR", "FRA"),
        ("Namibia", "NA", "NAM"), ("Germany", "DE", "DEU"),
    ],
    "dim_line_items_mapping": [("1", "adv_1"), ("2", "adv_2"), ("3", "adv_3"), ("4", "adv_4"), ("5", "adv_5")],
    "dim_ad_unit_mapping": [
        ("GAM", "org_0", "g0", "/unit/0", 1000), ("gam", "org_0", "g1", "/unit/1", 1001),
        ("GAM", "org_0", "g2", "/unit/2", 1002), ("GAM", "org_0", "g3", "/unit/3", 1003),
        ("Triplelift", "ORG_0", "Alias_0", "/unit/0", 0), ("Triplelift", "org_1", "alias_1", "/unit/1", 0),
        ("Triplelift", "org_2", "alias_2", "/unit/2", 0), ("Triplelift", "org_3", "alias_3", "/unit/1", 0),
    ],
}
_DIM_SCHEMAS = {"dim_country_mapping": COUNTRY_DIM_SCHEMA, "dim_line_items_mapping": LINE_ITEM_DIM_SCHEMA,
                "dim_ad_unit_mapping": AD_UNIT_DIM_SCHEMA}
BASE_DAY = "2024-01-01"


def _t(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _case(key: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(key == F.lit(k), F.lit(v)) if out is None else out.when(key == F.lit(k), F.lit(v)))
    return out.otherwise(F.lit(default).cast("string") if default is None else F.lit(default))


def _money_total(col: str, factor: str) -> Column:
    """``round(sum(col) * factor, 2)`` summed exactly in decimal (order-independent)."""
    return F.round(F.sum(F.col(col).cast("decimal(18,2)")) * F.lit(Decimal(factor)), 2).cast("double")


def _base_date(days: Column) -> Column:
    return F.date_add(F.lit(BASE_DAY).cast("date"), days.cast("int"))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spark.read.parquet(_t(sf_dir, "events"))
    uid4 = F.col("user_id") % 4
    eid = F.col("event_id")
    hour_shift = F.floor(F.hour("ts") / 4) * 4
    return ev.select(
        F.timestamp_add("HOUR", -hour_shift.cast("int"), F.col("ts")).alias("timestamp"),
        F.when(F.col("event_type").isin("view", "click", "purchase"), F.lit("served"))
         .otherwise(F.col("event_type")).alias("event"),
        F.concat(F.lit("org_"), _s(uid4)).alias("organizationId"),
        F.when(eid % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("/unit/"), _s(eid % 3))).alias("adunit"),
        F.when(F.col("user_id") % 2 == 0, F.lit("display")).otherwise(F.lit("video")).alias("mediaType"),
        _case(eid % 7, {0: "GAM", 1: "GAM", 2: "MinuteSSP", 3: "Prebid", 4: "Triplelift", 5: "Magnite"}).alias("network"),
        F.when(eid % 2 == 0, F.lit("Magnite")).otherwise(F.lit("IndexExchange")).alias("payingEntity"),
        F.when(uid4 == 3, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("https://www.site"), _s(uid4), F.lit(".example.com/p/"), _s(eid))).alias("url"),
        F.when(uid4 == 0, F.lit(None).cast("string")).otherwise(_s(uid4)).alias("lineItem"),
        F.when(F.col("user_id") % 2 == 0, F.lit("open")).alias("adDealType"),
        F.when(uid4 == 1, F.lit("SI")).alias("demandOwner"),
        _case(uid4, {0: "US", 1: "NA", 3: "GB"}).alias("country"),
        F.col("value").alias("cpm"),
    )


def fact_gam_data_transfer(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(_t(sf_dir, "lineitem"))
    k5 = (F.col("l_suppkey") + F.col("l_orderkey")) % 5
    ts = (F.lit(BASE_DAY + " 00:00:00").cast("timestamp_ntz")
          + F.make_dt_interval(days=(F.col("l_orderkey") % 30).cast("int"),
                               hours=(F.col("l_partkey") % 4).cast("int"),
                               secs=(F.col("l_suppkey") % 3600).cast("decimal(18,6)")))
    return li.select(
        ts.cast("timestamp_ntz").alias("timestamp"),
        F.concat(F.lit("s"), _s(F.col("l_orderkey"))).alias("session_id"),
        _s(F.lit(1000) + (F.col("l_partkey") + F.col("l_linenumber")) % 4).alias("ad_unit_id"),
        _case(k5, {1: "1", 2: "2", 3: "3", 4: "9"}).alias("line_item_id"),
        _case(k5, {0: "United States", 1: "Namibia", 3: "United Kingdom", 4: "Atlantis"}).alias("country_name"),
        F.round(F.col("l_quantity")).cast("bigint").alias("impressions"),
        (F.col("l_extendedprice") / 1000).alias("cpm_usd"),
    )


def fact_demand_partner_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(_t(sf_dir, "orders"))
    c3 = F.col("o_custkey") % 3
    s4 = (F.col("o_custkey") + F.col("o_orderkey")) % 4
    return o.select(
        _base_date(F.col("o_orderkey") % 30).alias("report_date"),
        _case(c3, {0: "Magnite", 1: "Triplelift", 2: "IndexExchange"}).alias("partner_name"),
        F.concat(F.lit("org_"), _s(s4)).alias("property_code"),
        F.when(c3 == 1, F.concat(F.lit("ALIAS_"), _s(s4))).when(c3 == 2, F.lit("not_in_mapping")).alias("ad_unit"),
        _case(s4, {0: "us", 1: "Na", 2: "FR", 3: "gb"}).alias("geo"),
        (F.col("o_custkey") % 1000).cast("bigint").alias("impressions"),
        (F.col("o_totalprice") / 1000).alias("revenue_usd"),
    )


def fact_ssp_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(_t(sf_dir, "orders"))
    c5 = F.col("o_custkey") % 5
    keyed = o.select(
        _base_date(F.col("o_orderkey") % 30).alias("report_date"),
        F.concat(F.lit("pub_"), _s(c5)).alias("publisher_id"),
        F.when(F.col("o_orderpriority") < F.lit("3"), F.lit("display")).otherwise(F.lit("video")).alias("placement_type"),
        _case(c5, {0: "external", 1: "external", 2: "ext_player", 3: "external"}, "owned").alias("site_type"),
        _case(F.col("o_custkey") % 4, {0: "usa", 1: "GBR", 2: "fr"}, "ZZZ").alias("country_code"),
        F.col("o_totalprice"),
    )
    return (keyed.groupBy("report_date", "publisher_id", "placement_type", "site_type", "country_code")
            .agg((F.count(F.lit(1)) * 37).cast("bigint").alias("impressions"),
                 _money_total("o_totalprice", "0.001").alias("revenue_usd")))


def fact_syndication_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(_t(sf_dir, "orders"))
    keyed = o.select(
        _base_date(F.col("o_orderkey") % 30).alias("transaction_date"),
        F.concat(F.lit("prop_"), _s(F.col("o_custkey") % 3)).alias("content_property"),
        F.when(F.col("o_custkey") % 2 == 0, F.lit("Yahoo")).otherwise(F.lit("MSN")).alias("partner_name"),
        F.col("o_totalprice"),
    )
    return (keyed.groupBy("transaction_date", "content_property", "partner_name")
            .agg((F.count(F.lit(1)) * 7).cast("bigint").alias("article_count"),
                 _money_total("o_totalprice", "0.002").alias("total_revenue")))


def dimension(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame(DIMENSION_ROWS[name], _DIM_SCHEMAS[name])


def derived_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All eight pipeline inputs, derived from the driver tables under ``sf_dir``."""
    return {
        "events_stream": events_stream(spark, sf_dir),
        "fact_gam_data_transfer": fact_gam_data_transfer(spark, sf_dir),
        "fact_demand_partner_reports": fact_demand_partner_reports(spark, sf_dir),
        "fact_ssp_report": fact_ssp_report(spark, sf_dir),
        "fact_syndication_revenue": fact_syndication_revenue(spark, sf_dir),
        "dim_country_mapping": dimension(spark, "dim_country_mapping"),
        "dim_line_items_mapping": dimension(spark, "dim_line_items_mapping"),
        "dim_ad_unit_mapping": dimension(spark, "dim_ad_unit_mapping"),
    }
