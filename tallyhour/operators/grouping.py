"""Hourly and daily grouping (E-01..E-04).

Each is one ``groupBy().agg()``: a partial aggregate in every map task (so a
hot key is collapsed before the shuffle) and one final aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhour.functions.exprs import hour_of, sum_where, utc_date
from tallyhour.operators.mapping import map_advertiser, map_country_name

EVENT_GROUP_KEYS = ["event_date", "event_hour", "event", "organization_id", "adunit", "media_type",
                    "network", "domain", "line_item", "ad_deal_type", "demand_owner", "country"]


def group_events(pulled: DataFrame, line_item_dim: DataFrame) -> DataFrame:
    """E-01: events to the 13-dimension hourly grain with counts and split revenue.

    The advertiser is a function of the line item (the dimension key is checked
    unique), so the lookup runs after the aggregate, on far fewer rows.
    """
    g = pulled.groupBy(*EVENT_GROUP_KEYS).agg(
        F.count(F.lit(1)).alias("tracked_event_count"),
        sum_where(F.col("is_actual_revenue") == 1, "revenue").alias("actual_revenue"),
        sum_where(F.col("is_actual_revenue") == 0, "revenue").alias("estimated_revenue"),
        F.max("timestamp").alias("max_events_stream_timestamp"),
    )
    g = map_advertiser(g, line_item_dim)
    return g.select(*EVENT_GROUP_KEYS[:12], "advertiser", "tracked_event_count", "actual_revenue",
                    "estimated_revenue", "max_events_stream_timestamp")


def group_gam(pulled: DataFrame, country_dim: DataFrame) -> DataFrame:
    """E-03: GAM rows to (date, hour, ad unit, line item, country) with the country name mapped.

    The country map is tiny and broadcast, so the lookup runs map-side ahead of
    the partial aggregate and the grouping needs a single shuffle.
    """
    m = map_country_name(pulled, country_dim, name_col="country_name", out_col="country")
    return m.groupBy(
        utc_date("timestamp").alias("event_date"), hour_of("timestamp").alias("event_hour"),
        "ad_unit_id", F.col("line_item_id").alias("line_item"), "country",
    ).agg(
        F.sum("impressions").alias("total_gam_impressions"),
        F.sum(F.col("cpm_usd") / F.lit(1000)).alias("total_gam_revenue"),
        F.max("timestamp").alias("max_gam_timestamp"),
    )


MONEY_DECIMAL = "decimal(38,12)"


def exact_money_sum(col: str):
    """Order-independent money sum (DECIMAL accumulation, double result): identical totals
    whatever the partitioning or executor count. Used on daily report totals, whose
    magnitudes make double sums differ in the last bits between runs."""
    return F.sum(F.col(col).cast(MONEY_DECIMAL)).cast("double")


def group_demand_partner(pulled: DataFrame) -> DataFrame:
    """E-04: partner rows to (date, network, org, ad unit, upper(geo))."""
    return pulled.groupBy(
        F.col("report_date").alias("event_date"), F.col("partner_name").alias("network"),
        F.col("property_code").alias("organization_id"), F.col("ad_unit").alias("adunit"),
        F.upper("geo").alias("country"),
    ).agg(
        F.sum("impressions").alias("total_demand_partner_impressions"),
        exact_money_sum("revenue_usd").alias("total_demand_partner_revenue_usd"),
        F.max("max_demand_partner_date").alias("max_demand_partner_date"),
    )
