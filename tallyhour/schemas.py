"""Table schemas, the fact-table grain and column groups."""

from __future__ import annotations

from pyspark.sql import types as T

# Fact table (SSOT) grain: the 13 dimensions that identify one hourly row.
GRAIN = [
    "event_date", "event_hour", "event", "organization_id", "adunit", "media_type",
    "network", "domain", "line_item", "advertiser", "ad_deal_type", "demand_owner",
    "country",
]
# Grain columns that are never null (compared with plain equality in every merge).
REQUIRED_GRAIN = ["event_date", "event_hour", "event", "organization_id"]
METRICS = ["tracked_event_count", "reconciled_event_count", "actual_revenue", "estimated_revenue"]
WATERMARK_COLS = ["max_events_stream_timestamp", "max_gam_timestamp", "max_demand_partner_date",
                  "max_ssp_date", "max_syndication_date"]
AUDIT_COLS = ["dwh_created_at", "dwh_updated_at"]
SSOT_COLUMNS = GRAIN + METRICS + WATERMARK_COLS + AUDIT_COLS

# Names carried by the source data and the fact table, which the
# pipeline rules test for (they must equal the values in the data).
OWNER_NETWORK = "MinuteSSP"          # first-party network: its revenue is actual, and SSP rows use it
GAM_NETWORK = "GAM"
SYNDICATION_NETWORK = "Syndication"
AUCTION_NETWORK = "Prebid"           # auction platform: the paying entity becomes the network
SERVED_EVENT = "served"
SYNDICATION_EVENT = "syndication_view"
SSP_SITE_TYPES = ("external", "ext_player")
GAM_PARTNER = "gam"                  # partner name of GAM rows in the ad-unit map (compared lower-case)
ALL_UNITS = "all_units"              # group key of a site-wide (unmapped) partner report
NULL_SENTINEL = "NA"                 # null stand-in of the reference merge keys

TS = T.TimestampNTZType()
S = T.StringType()
L = T.LongType()
D = T.DoubleType()
DT = T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SSOT_SCHEMA = _struct(
    ("event_date", DT), ("event_hour", TS), ("event", S), ("organization_id", S),
    ("adunit", S), ("media_type", S), ("network", S), ("domain", S), ("line_item", S),
    ("advertiser", S), ("ad_deal_type", S), ("demand_owner", S), ("country", S),
    ("tracked_event_count", L), ("reconciled_event_count", L),
    ("actual_revenue", D), ("estimated_revenue", D),
    ("max_events_stream_timestamp", TS), ("max_gam_timestamp", TS),
    ("max_demand_partner_date", DT), ("max_ssp_date", DT), ("max_syndication_date", DT),
    ("dwh_created_at", TS), ("dwh_updated_at", TS),
)

EVENTS_STREAM_SCHEMA = _struct(
    ("timestamp", TS), ("event", S), ("organizationId", S), ("adunit", S), ("mediaType", S),
    ("network", S), ("payingEntity", S), ("url", S), ("lineItem", S), ("adDealType", S),
    ("demandOwner", S), ("country", S), ("cpm", D),
)
GAM_SCHEMA = _struct(
    ("timestamp", TS), ("session_id", S), ("ad_unit_id", S), ("line_item_id", S),
    ("country_name", S), ("impressions", L), ("cpm_usd", D),
)
DEMAND_PARTNER_SCHEMA = _struct(
    ("report_date", DT), ("partner_name", S), ("property_code", S), ("ad_unit", S),
    ("geo", S), ("impressions", L), ("revenue_usd", D),
)
SSP_SCHEMA = _struct(
    ("report_date", DT), ("publisher_id", S), ("placement_type", S), ("site_type", S),
    ("country_code", S), ("impressions", L), ("revenue_usd", D),
)
SYNDICATION_SCHEMA = _struct(
    ("transaction_date", DT), ("content_property", S), ("partner_name", S),
    ("article_count", L), ("total_revenue", D),
)
COUNTRY_DIM_SCHEMA = _struct(("country_name", S), ("country_code", S), ("country_code_alpha3", S))
LINE_ITEM_DIM_SCHEMA = _struct(("line_item_id", S), ("advertiser_name", S))
AD_UNIT_DIM_SCHEMA = _struct(
    ("partner_name", S), ("property_code", S), ("partner_ad_unit", S), ("adunit_path", S),
    ("ad_unit_id", T.IntegerType()),
)

TABLE_SCHEMAS = {
    "events_stream": EVENTS_STREAM_SCHEMA,
    "fact_gam_data_transfer": GAM_SCHEMA,
    "fact_demand_partner_reports": DEMAND_PARTNER_SCHEMA,
    "fact_ssp_report": SSP_SCHEMA,
    "fact_syndication_revenue": SYNDICATION_SCHEMA,
    "dim_country_mapping": COUNTRY_DIM_SCHEMA,
    "dim_line_items_mapping": LINE_ITEM_DIM_SCHEMA,
    "dim_ad_unit_mapping": AD_UNIT_DIM_SCHEMA,
    "fact_consolidated_revenue_hourly": SSOT_SCHEMA,
}
