"""DuckDB oracle for the registered queries.

SQL statements of the same pipeline, run by the driver's DuckDB over the driver
tables, and derived another way than the Spark code where there is one: hosts by
cutting strings instead of patterns, lookups as scalar subqueries, denominators as
an aggregate times a count, joined back. The rules themselves (keys, rounding,
exact decimal money sums) are the same on both sides by design. Each statement inlines the input views (derived from
``events``, ``lineitem`` and ``orders``) and every pipeline stage it needs as
CTEs. Two scenarios: ``parity`` (reference rules) and ``safe`` (hardened
defaults); both start from an empty fact table and catch up on all pending
data, with run timestamp 2024-02-01 17:00:00.
"""

from __future__ import annotations

import re

GRAIN = ["event_date", "event_hour", "event", "organization_id", "adunit", "media_type", "network", "domain",
         "line_item", "advertiser", "ad_deal_type", "demand_owner", "country"]
REQUIRED = ["event_date", "event_hour", "event", "organization_id"]
SSOT_TYPES = [
    ("event_date", "DATE"), ("event_hour", "TIMESTAMP"), ("event", "VARCHAR"), ("organization_id", "VARCHAR"),
    ("adunit", "VARCHAR"), ("media_type", "VARCHAR"), ("network", "VARCHAR"), ("domain", "VARCHAR"),
    ("line_item", "VARCHAR"), ("advertiser", "VARCHAR"), ("ad_deal_type", "VARCHAR"), ("demand_owner", "VARCHAR"),
    ("country", "VARCHAR"), ("tracked_event_count", "BIGINT"), ("reconciled_event_count", "BIGINT"),
    ("actual_revenue", "DOUBLE"), ("estimated_revenue", "DOUBLE"), ("max_events_stream_timestamp", "TIMESTAMP"),
    ("max_gam_timestamp", "TIMESTAMP"), ("max_demand_partner_date", "DATE"), ("max_ssp_date", "DATE"),
    ("max_syndication_date", "DATE"), ("dwh_created_at", "TIMESTAMP"), ("dwh_updated_at", "TIMESTAMP"),
]
SSOT_COLS = [c for c, _ in SSOT_TYPES]
RUN_TS = "timestamp '2024-02-01 17:00:00'"
TODAY = "date '2024-02-01'"
RUN_TS2 = "timestamp '2024-02-02 17:00:00'"     # second hourly run (reference rules, one step per source)
TODAY2 = "date '2024-02-02'"
RETENTION_AS_OF = "date '2024-03-15'"
RETENTION_DAYS = 60
ROUND_DIGITS = 9
DOUBLE_COLS = {"revenue", "actual_revenue", "estimated_revenue", "total_gam_revenue", "weight",
               "allocated_actual_revenue", "total_demand_partner_revenue_usd", "revenue_usd", "cpm", "cpm_usd",
               "total_revenue", "expected_value", "actual_value"}

# ---------------------------------------------------------------------------
# Input views
# ---------------------------------------------------------------------------
VIEWS = {
    "dim_country_mapping": """select * from (values ('United States','US','USA'),('United Kingdom','GB','GBR'),
 ('France','FR','FRA'),('Namibia','NA','NAM'),('Germany','DE','DEU')) as t(country_name,country_code,country_code_alpha3)""",
    "dim_line_items_mapping": """select * from (values ('1','adv_1'),('2','adv_2'),('3','adv_3'),('4','adv_4'),('5','adv_5'))
 as t(line_item_id,advertiser_name)""",
    "dim_ad_unit_mapping": """select * from (values
 ('GAM','org_0','g0','/unit/0',1000),('gam','org_0','g1','/unit/1',1001),('GAM','org_0','g2','/unit/2',1002),
 ('GAM','org_0','g3','/unit/3',1003),('Triplelift','ORG_0','Alias_0','/unit/0',0),('Triplelift','org_1','alias_1','/unit/1',0),
 ('Triplelift','org_2','alias_2','/unit/2',0),('Triplelift','org_3','alias_3','/unit/1',0)
 ) as t(partner_name,property_code,partner_ad_unit,adunit_path,ad_unit_id)""",
    "events_stream": """select ts - floor(extract(hour from ts) / 4) * 4 * interval '1' hour as timestamp,
 case when event_type in ('view','click','purchase') then 'served' else event_type end as event,
 'org_' || cast(user_id % 4 as varchar) as organizationId,
 case when event_id % 11 = 0 then null else '/unit/' || cast(event_id % 3 as varchar) end as adunit,
 case when user_id % 2 = 0 then 'display' else 'video' end as mediaType,
 case event_id % 7 when 0 then 'GAM' when 1 then 'GAM' when 2 then 'MinuteSSP' when 3 then 'Prebid'
   when 4 then 'Triplelift' when 5 then 'Magnite' end as network,
 case event_id % 2 when 0 then 'Magnite' else 'IndexExchange' end as payingEntity,
 case when user_id % 4 = 3 then null else 'https://www.site' || cast(user_id % 4 as varchar) || '.example.com/p/'
   || cast(event_id as varchar) end as url,
 case when user_id % 4 = 0 then null else cast(user_id % 4 as varchar) end as lineItem,
 case when user_id % 2 = 0 then 'open' end as adDealType,
 case when user_id % 4 = 1 then 'SI' end as demandOwner,
 case user_id % 4 when 0 then 'US' when 1 then 'NA' when 3 then 'GB' end as country,
 value as cpm from events""",
    "fact_gam_data_transfer": """select timestamp '2024-01-01 00:00:00' + (l_orderkey % 30) * interval '1' day
   + (l_partkey % 4) * interval '1' hour + (l_suppkey % 3600) * interval '1' second as timestamp,
 's' || cast(l_orderkey as varchar) as session_id, cast(1000 + (l_partkey + l_linenumber) % 4 as varchar) as ad_unit_id,
 case (l_suppkey + l_orderkey) % 5 when 1 then '1' when 2 then '2' when 3 then '3' when 4 then '9' end as line_item_id,
 case (l_suppkey + l_orderkey) % 5 when 0 then 'United States' when 1 then 'Namibia' when 3 then 'United Kingdom'
   when 4 then 'Atlantis' end as country_name,
 cast(l_quantity as bigint) as impressions, l_extendedprice / 1000 as cpm_usd from lineitem""",
    "fact_demand_partner_reports": """select cast(date '2024-01-01' + cast(o_orderkey % 30 as int) as date) as report_date,
 case o_custkey % 3 when 0 then 'Magnite' when 1 then 'Triplelift' else 'IndexExchange' end as partner_name,
 'org_' || cast((o_custkey + o_orderkey) % 4 as varchar) as property_code,
 case o_custkey % 3 when 1 then 'ALIAS_' || cast((o_custkey + o_orderkey) % 4 as varchar) when 2 then 'not_in_mapping' end as ad_unit,
 case (o_custkey + o_orderkey) % 4 when 0 then 'us' when 1 then 'Na' when 2 then 'FR' else 'gb' end as geo,
 cast(o_custkey % 1000 as bigint) as impressions, o_totalprice / 1000 as revenue_usd from orders""",
    "fact_ssp_report": """select cast(date '2024-01-01' + cast(o_orderkey % 30 as int) as date) as report_date,
 'pub_' || cast(o_custkey % 5 as varchar) as publisher_id,
 case when o_orderpriority < '3' then 'display' else 'video' end as placement_type,
 case o_custkey % 5 when 0 then 'external' when 1 then 'external' when 2 then 'ext_player' when 3 then 'external'
   else 'owned' end as site_type,
 case o_custkey % 4 when 0 then 'usa' when 1 then 'GBR' when 2 then 'fr' else 'ZZZ' end as country_code,
 cast(count(*) * 37 as bigint) as impressions, cast(round(sum(cast(o_totalprice as decimal(18,2))) * 0.001, 2) as double) as revenue_usd
 from orders group by 1,2,3,4,5""",
    "fact_syndication_revenue": """select cast(date '2024-01-01' + cast(o_orderkey % 30 as int) as date) as transaction_date,
 'prop_' || cast(o_custkey % 3 as varchar) as content_property,
 case o_custkey % 2 when 0 then 'Yahoo' else 'MSN' end as partner_name,
 cast(count(*) * 7 as bigint) as article_count, cast(round(sum(cast(o_totalprice as decimal(18,2))) * 0.002, 2) as double) as total_revenue
 from orders group by 1,2,3""",
}

# ---------------------------------------------------------------------------
# Building blocks
# ---------------------------------------------------------------------------


def _eq(k: str, mode: str, plain: list[str], t: str = "t", s: str = "s") -> str:
    if mode == "null_safe":
        return f"{t}.{k} is not distinct from {s}.{k}"
    if k in plain:
        return f"{t}.{k} = {s}.{k}"
    return f"coalesce({t}.{k}, 'NA') = coalesce({s}.{k}, 'NA')"


def merge_sql(target: str, source: str, mode: str, plain: list[str], update: dict, insert: dict | None,
              target_cond: str | None = None) -> str:
    cond = " and ".join(_eq(k, mode, plain) for k in GRAIN)
    if target_cond:
        cond += f" and {target_cond}"
    cols = []
    for c, typ in SSOT_TYPES:
        e = f"t.{c}"
        if c in update:
            e = f"case when t._tp and s._sp then {update[c]} else {e} end"
        if insert is not None:
            e = f"case when t._tp is null then {insert.get(c, 'null')} else {e} end"
        cols.append(f"cast({e} as {typ}) as {c}")
    join = "full outer join" if insert is not None else "left join"
    return (f"select {', '.join(cols)} from (select *, true as _tp from {target}) t {join} "
            f"(select *, true as _sp from {source}) s on {cond}")


def _insert(cols: list[str], run_ts: str = RUN_TS) -> dict:
    d = {c: f"s.{c}" for c in cols}
    d["dwh_created_at"] = run_ts
    d["dwh_updated_at"] = run_ts
    return d


def _typed_nulls(cols: list[str]) -> str:
    types = dict(SSOT_TYPES)
    return ", ".join(f"cast(null as {types[c]}) as {c}" for c in cols)


def pipeline_ctes(mode: str, catch_up: bool = True, run_ts: str = RUN_TS, today: str = TODAY) -> dict[str, str]:
    """Ordered CTEs of the whole pipeline for ``mode`` in {"parity", "safe"}.

    ``catch_up`` processes every pending day; without it each source takes the
    reference's single step (5-day events window, oldest partner date, next GAM day).
    """
    parity = mode == "parity"
    RUN_TS, TODAY = run_ts, today  # noqa: N806
    nm = "sentinel" if parity else "null_safe"
    c: dict[str, str] = dict(VIEWS)
    c["ssot0"] = f"select {_typed_nulls(SSOT_COLS)} where false"

    # --- events (L-01): catch-up pull from the first run's watermark
    c["ev_wm"] = ("select coalesce(date_trunc('hour', max(max_events_stream_timestamp)), "
                  "timestamp '1970-01-01 00:00:00') as increment_column from ssot0")
    ev_filter = ("timestamp > (select increment_column from ev_wm)" + (
        "" if catch_up else " and timestamp <= (select increment_column from ev_wm) + interval 5 day") if parity else
                 "(select max(max_events_stream_timestamp) from ssot0) is null or "
                 "timestamp >= (select increment_column from ev_wm)")
    # hours by arithmetic on the day; the host by cutting off scheme, path, user info and port
    c["ev_hosts"] = f"""select *, string_split(split_part(split_part(split_part(
   case when strpos(url, '//') > 0 then substr(trim(url), strpos(trim(url), '//') + 2) else trim(url) end,
   '/', 1), '?', 1), '#', 1), '@')[-1] as host_port
 from events_stream where {ev_filter}"""
    c["ev_pull"] = """with named as (select *, case when starts_with(host_port, '[') then split_part(host_port, ']', 1) || ']'
   else split_part(host_port, ':', 1) end as host from ev_hosts)
 select timestamp::date as event_date, timestamp::date + hour(timestamp) * interval '1' hour as event_hour, timestamp, event,
 organizationId as organization_id, adunit, mediaType as media_type,
 if(network is not distinct from 'Prebid', payingEntity, network) as network,
 nullif(case when starts_with(host, 'www.') then substr(host, 5) else host end, '') as domain,
 lineItem as line_item, adDealType as ad_deal_type, demandOwner as demand_owner, country,
 cpm / 1000 as revenue, cast(network is not distinct from 'MinuteSSP' as integer) as is_actual_revenue
 from named"""
    keys = "event_date, event_hour, event, organization_id, adunit, media_type, network, domain, line_item, ad_deal_type, demand_owner, country"
    c["ev_sums"] = f"""select {keys}, is_actual_revenue as own, count(*) as n, sum(revenue) as r, max(timestamp) as seen
 from ev_pull group by {keys}, own"""
    c["ev_grouped"] = f"""select {keys},
 (select d.advertiser_name from dim_line_items_mapping d where d.line_item_id = ev_sums.line_item) as advertiser,
 cast(sum(n) as bigint) as tracked_event_count, max(case own when 1 then r end) as actual_revenue,
 max(case own when 0 then r end) as estimated_revenue, max(seen) as max_events_stream_timestamp
 from ev_sums group by all"""
    actual = ("case when s.network = 'MinuteSSP' then s.actual_revenue else t.actual_revenue end" if parity else
              "case when s.network = 'MinuteSSP' then coalesce(s.actual_revenue, t.actual_revenue) "
              "else t.actual_revenue end")
    ev_update = {"tracked_event_count": "s.tracked_event_count", "estimated_revenue": "s.estimated_revenue",
                 "actual_revenue": actual, "max_events_stream_timestamp": "s.max_events_stream_timestamp",
                 "dwh_updated_at": RUN_TS}
    ev_insert = _insert(GRAIN + ["tracked_event_count", "actual_revenue", "estimated_revenue",
                                 "max_events_stream_timestamp"], RUN_TS)
    c["ssot1"] = merge_sql("ssot0", "ev_grouped", nm, REQUIRED, ev_update, ev_insert)

    # --- SSP (L-02)
    c["ssp_wm"] = ("select coalesce(max(max_ssp_date), date '1970-01-01') as increment_column from ssot1 "
                   "where network = 'MinuteSSP' and tracked_event_count is null")
    c["ssp_new"] = ("select count(*) > 0 as has_new_data from fact_ssp_report where report_date > "
                    "(select increment_column from ssp_wm) and site_type in ('external', 'ext_player')")
    c["ssp_pull"] = """select f.* exclude (country_code), upper(f.country_code) as country_code, f.report_date as max_ssp_date
 from fact_ssp_report f, ssp_wm where f.site_type like 'ext%' and not f.report_date < ssp_wm.increment_column"""
    c["ssp_daily"] = """select report_date as event_date, publisher_id as organization_id, placement_type as media_type,
 'MinuteSSP' as network, 'served' as event,
 case length(country_code) when 2 then country_code
   else (select d.country_code from dim_country_mapping d where d.country_code_alpha3 = ssp_pull.country_code) end as country,
 impressions, revenue_usd, max_ssp_date from ssp_pull"""
    c["ssp_exploded"] = _explode_sql("ssp_daily", "impressions", "revenue_usd", "max_ssp_date",
                                     ["event_date", "organization_id", "media_type", "country"],
                                     {"media_type": "media_type", "country": "country"}, parity)
    daily_update = lambda wm: {"reconciled_event_count": "s.reconciled_event_count",
                               "actual_revenue": "s.actual_revenue", wm: f"s.{wm}", "dwh_updated_at": RUN_TS}
    daily_cols = GRAIN + ["tracked_event_count", "reconciled_event_count", "actual_revenue", "estimated_revenue"]
    c["ssot2"] = merge_sql("ssot1", "(select * from ssp_exploded where (select has_new_data from ssp_new))", nm,
                           REQUIRED + ["network"], daily_update("max_ssp_date"),
                           _insert(daily_cols + ([] if parity else ["max_ssp_date"]), RUN_TS))

    # --- syndication (L-03)
    c["syn_wm"] = ("select coalesce(max(max_syndication_date), date '1970-01-01') as increment_column from ssot2 "
                   "where network = 'Syndication'")
    c["syn_new"] = ("select count(*) > 0 as has_new_data from fact_syndication_revenue where transaction_date > "
                    "(select increment_column from syn_wm)")
    c["syn_pull"] = """select transaction_date as event_date, content_property as organization_id,
 partner_name as demand_owner, 'Syndication' as network, 'syndication_view' as event, article_count, total_revenue,
 transaction_date as max_syndication_date from fact_syndication_revenue
 where transaction_date >= (select increment_column from syn_wm)"""
    c["syn_exploded"] = _explode_sql("syn_pull", "article_count", "total_revenue", "max_syndication_date",
                                     ["event_date", "organization_id", "demand_owner"],
                                     {"demand_owner": "demand_owner"}, parity)
    c["ssot3"] = merge_sql("ssot2", "(select * from syn_exploded where (select has_new_data from syn_new))", nm,
                           REQUIRED + ["network"], daily_update("max_syndication_date"),
                           _insert(daily_cols + ([] if parity else ["max_syndication_date"]), RUN_TS))

    # --- demand partner (L-04): every unprocessed date
    lookback = 0 if parity else 7
    c["dp_wm"] = ("select coalesce(max(max_demand_partner_date), date '1970-01-01') as increment_column from ssot3")
    c.update(_delta_ctes("dp", "ssot3", lookback))
    c["dp_dates"] = ("select distinct report_date from dp_unprocessed" if catch_up else
                     "select min(report_date) as report_date from dp_unprocessed having min(report_date) is not null")
    c["dp_pull"] = """select r.*, r.report_date as max_demand_partner_date
 from fact_demand_partner_reports r semi join dp_dates d on r.report_date = d.report_date"""
    c["dp_grouped"] = """select max_demand_partner_date as event_date, partner_name as network, property_code as organization_id,
 ad_unit as adunit, country, cast(total_i as bigint) as total_demand_partner_impressions,
 cast(total_r as double) as total_demand_partner_revenue_usd, max_demand_partner_date
 from (select max_demand_partner_date, partner_name, property_code, ad_unit, upper(geo) as country, sum(impressions) as total_i,
   sum(cast(revenue_usd as decimal(38,12))) as total_r from dp_pull group by all)"""
    c["dp_mapped"] = """select *, (select d.adunit_path from dim_ad_unit_mapping d
   where lower(concat_ws('|', d.partner_name, d.property_code, d.partner_ad_unit))
     = lower(dp_grouped.network || '|' || dp_grouped.organization_id || '|' || dp_grouped.adunit)) as mapped_adunit_path
 from dp_grouped"""
    slice_cols = ", ".join(GRAIN + ["tracked_event_count"])
    c["dp_slice"] = f"""select {slice_cols} from ssot3 where event = 'served' and network not in ('GAM', 'MinuteSSP')
 and event_date in (select report_date from dp_dates)"""
    c["dp_allocated"] = _dp_alloc_sql(parity)
    dp_update = {"reconciled_event_count": "s.allocated_reconciled_event_count",
                 "actual_revenue": "s.allocated_actual_revenue",
                 "max_demand_partner_date": "s.max_demand_partner_date", "dwh_updated_at": RUN_TS}
    c["ssot4"] = merge_sql("ssot3", "dp_allocated", nm, REQUIRED + ["network", "country"], dp_update, None)

    # --- GAM (L-05): every complete day after the watermark
    c["gam_wm"] = ("select coalesce(max(max_gam_timestamp), timestamp '1970-01-01 00:00:00') as increment_column "
                   "from ssot4")
    c["gam_pull"] = f"""select timestamp, session_id, ad_unit_id, line_item_id, country_name, impressions, cpm_usd
 from fact_gam_data_transfer
 where cast(timestamp as date) {'>=' if catch_up else '='} cast((select increment_column from gam_wm) as date) + 1
 and cast(timestamp as date) < {TODAY}"""
    c["gam_grouped"] = """select day as event_date, day + h * interval '1' hour as event_hour, ad_unit_id, line_item, country,
 cast(sum(i) as bigint) as total_gam_impressions, sum(cpm) / 1000 as total_gam_revenue, max(seen) as max_gam_timestamp
 from (select timestamp::date as day, hour(timestamp) as h, ad_unit_id, line_item_id as line_item,
   coalesce((select d.country_code from dim_country_mapping d where d.country_name = gam_pull.country_name), country_name) as country,
   impressions as i, cpm_usd as cpm, timestamp as seen from gam_pull)
 group by all"""
    c["gam_slice"] = f"""select {slice_cols} from ssot4 where network = 'GAM' and event = 'served'
 and event_date in (select distinct cast(timestamp as date) from gam_pull)"""
    # a traffic group's denominator: its events, once for each totals row that it meets
    same = " and ".join(f"m.{k} is not distinct from x.{k}" for k in ("event_date", "event_hour", "line_item", "country", "unit"))
    meets = (f"x.event_date = g.event_date and x.event_hour = g.event_hour and {_eq('line_item', nm, [], 'x', 'g')} "
             f"and {_eq('country', nm, [], 'x', 'g')} and x.unit = try_cast(g.ad_unit_id as bigint)")
    c["gam_units"] = """select s.*, (select d.ad_unit_id from dim_ad_unit_mapping d
   where d.partner_name ilike 'gam' and d.adunit_path = s.adunit) as unit from gam_slice s"""
    c["gam_meeting"] = f"""select x.event_date, x.event_hour, x.line_item, x.country, x.unit, x.events * count(*) as total
 from (select event_date, event_hour, line_item, country, unit, sum(tracked_event_count) as events
   from gam_units where unit is not null group by all) x join gam_grouped g on {meets}
 group by x.event_date, x.event_hour, x.line_item, x.country, x.unit, x.events"""
    c["gam_joined"] = f"""select x.* exclude (unit), g.total_gam_impressions, g.total_gam_revenue, g.max_gam_timestamp,
 cast(m.total as bigint) as total_tracked_for_group
 from gam_units x join gam_grouped g on {meets} join gam_meeting m on {same}"""
    c["gam_allocated"] = """select *, cast(round(total_gam_impressions * weight) as bigint) as allocated_reconciled_event_count,
 total_gam_revenue * weight as allocated_actual_revenue
 from (select *, if(total_tracked_for_group = 0 or tracked_event_count is null or total_tracked_for_group is null, 0.0,
   tracked_event_count / total_tracked_for_group) as weight from gam_joined)"""
    gam_update = {"reconciled_event_count": "s.allocated_reconciled_event_count",
                  "actual_revenue": "s.allocated_actual_revenue", "max_gam_timestamp": "s.max_gam_timestamp",
                  "dwh_updated_at": RUN_TS}
    c["ssot5"] = merge_sql("ssot4", "gam_allocated", nm, REQUIRED + ["network"], gam_update, None,
                           target_cond="t.network = 'GAM'")
    c["ssot_rerun"] = merge_sql("ssot5", "ev_grouped", nm, REQUIRED, ev_update, ev_insert)

    if not catch_up:
        return c
    # --- data quality (J-01..J-08) on the final table
    c.update(_dq_ctes(nm, "equal" if parity else "bounded"))
    return c


def _explode_sql(src: str, count_col: str, rev_col: str, wm_col: str, part: list[str], keep: dict,
                 parity: bool) -> str:
    types = dict(SSOT_TYPES)
    if not parity:  # pre-aggregate to output grain
        keys = ", ".join(part + ["network", "event"])
        src = (f"(select {keys}, cast(sum({count_col}) as bigint) as {count_col}, sum({rev_col}) as {rev_col}, "
               f"max({wm_col}) as {wm_col} from {src} group by all)")
    hours = (f"select *, unnest(generate_series(0, 23)) as hour_index from {src}")
    hourly = (f"select *, cast(event_date as timestamp) + hour_index * interval '1' hour as event_hour "
              f"from ({hours})")
    if parity:
        first = f"row_number() over (partition by {', '.join(part)} order by event_hour) = 1"
    else:
        first = "hour_index = 0"
    cols = []
    for g in GRAIN:
        if g in ("event_date", "event_hour", "event", "organization_id", "network") or g in keep:
            cols.append(g)
        else:
            cols.append(f"cast(null as {types[g]}) as {g}")
    cols += ["cast(null as bigint) as tracked_event_count",
             f"cast({count_col} // 24 + case when {first} then {count_col} % 24 else 0 end as bigint) "
             f"as reconciled_event_count",
             f"{rev_col} / 24 as actual_revenue", "cast(null as double) as estimated_revenue", wm_col]
    return f"select {', '.join(cols)} from ({hourly})"


def _delta_ctes(prefix: str, ssot: str, lookback: int) -> dict:
    lo = f"(select increment_column from {prefix}_wm) - {lookback}"
    return {
        f"{prefix}_arriving": f"""select distinct report_date, partner_name from fact_demand_partner_reports
 where report_date >= {lo}""",
        f"{prefix}_processed": f"""select distinct event_date, network from {ssot}
 where event_date >= {lo} and actual_revenue is not null
 and network in (select partner_name from {prefix}_arriving)""",
        f"{prefix}_unprocessed": f"""select a.report_date, a.partner_name from {prefix}_arriving a
 left join {prefix}_processed p on a.partner_name = p.network and a.report_date = p.event_date
 where p.event_date is null""",
    }


def _dp_alloc_sql(parity: bool) -> str:
    """Partner allocation: each report row meets the traffic it covers (a unit, or the site); the covered
    events are summed per cover and multiplied by the report rows that share it."""
    grain = ", ".join(GRAIN)
    site = ["event_date", "network", "organization_id", "country"]
    on = lambda a, b: " and ".join(f"{a}.{k} = {b}.{k}" for k in site)
    keys = ", ".join(site)
    money = "cast(sum(cast(total_demand_partner_revenue_usd as decimal(38,12))) as double)"
    reports = "dp_mapped" if parity else f"""(select {keys}, mapped_adunit_path,
   cast(sum(total_demand_partner_impressions) as bigint) as total_demand_partner_impressions,
   {money} as total_demand_partner_revenue_usd, max(max_demand_partner_date) as max_demand_partner_date
   from dp_mapped group by all)"""
    body = f"""with reports as (select * from {reports}),
 covers as (
   select {keys}, cast(null as varchar) as unit, sum(tracked_event_count) as events from dp_slice group by {keys}
   union all
   select {keys}, adunit as unit, sum(tracked_event_count) as events from dp_slice where adunit is not null group by {keys}, adunit),
 shared as (
   select c.*, count(*) as n from covers c join reports r on {on('c', 'r')} and r.mapped_adunit_path is not distinct from c.unit
   group by all),
 shares as (
   select d.*, r.max_demand_partner_date, r.total_demand_partner_impressions as i, r.total_demand_partner_revenue_usd as usd,
   if(s.events * s.n = 0 or s.events is null or d.tracked_event_count is null, 0.0, d.tracked_event_count / (s.events * s.n)) as weight
   from reports r
   join shared s on {on('r', 's')} and r.mapped_adunit_path is not distinct from s.unit
   join dp_slice d on {on('r', 'd')} and (s.unit is null or s.unit = d.adunit)),
 parts as (
   select {grain}, max_demand_partner_date, tracked_event_count, weight,
   cast(round(i * weight) as bigint) as allocated_reconciled_event_count, usd * weight as allocated_actual_revenue from shares)
"""
    if parity:
        return body + " select * from parts"
    return body + f""" select {grain}, max(max_demand_partner_date) as max_demand_partner_date,
 max(tracked_event_count) as tracked_event_count, sum(weight) as weight,
 cast(sum(allocated_reconciled_event_count) as bigint) as allocated_reconciled_event_count,
 sum(allocated_actual_revenue) as allocated_actual_revenue from parts group by {grain}"""


def _dq_ctes(nm: str, bounding: str) -> dict:
    def key(k):
        return k if (k in REQUIRED or nm == "null_safe") else f"coalesce({k}, 'NA')"

    keys = ", ".join(key(k) for k in GRAIN)
    c = {
        "dq_grain": f"""select cast(0 as bigint) as expected_value, count(*) as actual_value, count(*) = 0 as passed
 from (select {keys} from ssot5 group by all having count(*) > 1)""",
        "dq_required": """select cast(0 as bigint) as expected_value, count(*) as actual_value, count(*) = 0 as passed
 from ssot5 where event_date is null or event_hour is null or event is null or organization_id is null""",
        "dq_negatives": """select cast(0 as bigint) as expected_value, count(*) as actual_value, count(*) = 0 as passed
 from ssot5 where coalesce(actual_revenue < 0 or estimated_revenue < 0 or tracked_event_count < 0
 or reconciled_event_count < 0, false)""",
    }
    for name, stg in (("dq_ssp_cons", "ssp_exploded"), ("dq_syn_cons", "syn_exploded")):
        cond = " and ".join(_eq(k, nm, REQUIRED, "t", "s") for k in GRAIN)
        c[name] = f"""select e.total as expected_value, a.total as actual_value,
 abs(coalesce(e.total, 0) - coalesce(a.total, 0)) = 0 as passed
 from (select cast(round(sum(cast(actual_revenue as decimal(38,12))), 4) as double) as total from {stg}) e,
 (select cast(round(sum(cast(t.actual_revenue as decimal(38,12))), 4) as double) as total from {stg} s join ssot5 t on {cond}) a"""
    passed = ("coalesce(a.total, 0) = coalesce(e.total, 0)" if bounding == "equal"
              else "coalesce(a.total, 0) <= coalesce(e.total, 0) * 1.001")
    c["dq_gam_bound"] = f"""select e.total as expected_value, a.total as actual_value, {passed} as passed
 from (select cast(round(sum(cast(total_gam_revenue as decimal(38,12))), 4) as double) as total from gam_grouped) e,
 (select cast(round(sum(cast(actual_revenue as decimal(38,12))), 4) as double) as total from ssot5 where network = 'GAM' and max_gam_timestamp is not null
  and event_date in (select distinct event_date from gam_allocated)) a"""
    c["dq_dp_bound"] = f"""select e.total as expected_value, a.total as actual_value, {passed} as passed
 from (select cast(round(sum(cast(total_demand_partner_revenue_usd as decimal(38,12))), 4) as double) as total from dp_grouped) e,
 (select cast(round(sum(cast(actual_revenue as decimal(38,12))), 4) as double) as total from ssot5 where network not in ('GAM', 'MinuteSSP')
  and max_demand_partner_date is not null
  and event_date in (select distinct event_date from dp_allocated)) a"""
    parts = []
    checks = [(1, "ssot_grain_uniqueness", "blocking", "dq_grain", True),
              (2, "ssot_required_fields", "blocking", "dq_required", True),
              (3, "ssot_no_negatives", "blocking", "dq_negatives", True),
              (4, "ssp_revenue_conservation", "warning", "dq_ssp_cons", False),
              (5, "syndication_revenue_conservation", "warning", "dq_syn_cons", False),
              (6, "gam_revenue_bounding", "warning", "dq_gam_bound", False),
              (7, "demand_partner_revenue_bounding", "warning", "dq_dp_bound", False)]
    for n, name, sev, cte, integral in checks:
        fmt = ((lambda x: f"cast(cast({x} as bigint) as varchar)") if integral
               else (lambda x: f"printf('%.4f', {x})"))
        fail = "FAIL" if sev == "blocking" else "WARN"
        parts.append(f"""select {n} as n, '{name}' as name, '{sev}' as severity, {fmt('expected_value')} as expected_value,
 {fmt('actual_value')} as actual_value, passed, case when passed then 'PASS' else '{fail}' end as status from {cte}""")
    c["dq_suite"] = "\nunion all\n".join(parts)
    return c


def _with(ctes: dict, final: str) -> str:
    body = ",\n".join(f"{k} as (\n{v}\n)" for k, v in ctes.items())
    return f"with {body}\n{final}"


def _rounded(cols_sql: str, doubles: list[str]) -> str:
    if not doubles:
        return cols_sql
    rep = ", ".join(f"round({d}, {ROUND_DIGITS}) as {d}" for d in doubles)
    return cols_sql.replace("select *", f"select * replace ({rep})", 1)


# name -> (scenario, final select, double columns in the output)
_SSOT_D = ["actual_revenue", "estimated_revenue"]
_QUERIES = {
    "events_pull": ("parity", "select * from ev_pull", ["revenue"]),
    "events_hourly_grouping": ("parity", "select * from ev_grouped", _SSOT_D),
    "events_watermark": ("parity", "select coalesce(date_trunc('hour', max(max_events_stream_timestamp)), "
                                   "timestamp '1970-01-01 00:00:00') as increment_column from ssot5", []),
    "gam_watermark": ("parity", "select coalesce(max(max_gam_timestamp), timestamp '1970-01-01 00:00:00') "
                                "as increment_column from ssot5", []),
    "dp_watermark": ("parity", "select coalesce(max(max_demand_partner_date), date '1970-01-01') "
                               "as increment_column from ssot5", []),
    "ssp_watermark": ("parity", "select coalesce(max(max_ssp_date), date '1970-01-01') as increment_column "
                                "from ssot5 where network = 'MinuteSSP' and tracked_event_count is null", []),
    "ssp_watermark_safe": ("safe", "select coalesce(max(max_ssp_date), date '1970-01-01') as increment_column "
                                   "from ssot5 where network = 'MinuteSSP' and tracked_event_count is null", []),
    "syndication_watermark": ("parity", "select coalesce(max(max_syndication_date), date '1970-01-01') "
                                        "as increment_column from ssot5 where network = 'Syndication'", []),
    "ssp_new_data": ("parity", "select * from ssp_new", []),
    "syndication_new_data": ("parity", "select * from syn_new", []),
    "gam_pull": ("parity", "select * from gam_pull", ["cpm_usd"]),
    "gam_hourly_grouping": ("parity", "select * from gam_grouped", ["total_gam_revenue"]),
    "gam_ssot_slice": ("parity", "select * from gam_slice", []),
    "gam_allocation": ("parity", "select * from gam_allocated",
                       ["total_gam_revenue", "weight", "allocated_actual_revenue"]),
    "dp_smart_delta": ("parity", "select min(report_date) is not null as has_new_data, "
                                 "min(report_date) as increment_column from dp_unprocessed", []),
    "dp_unprocessed_pairs": ("parity", "select * from dp_unprocessed", []),
    "dp_smart_delta_after": ("parity", None, []),
    "dp_pull": ("parity", "select * from dp_pull", ["revenue_usd"]),
    "dp_grouping": ("parity", "select * from dp_grouped", ["total_demand_partner_revenue_usd"]),
    "dp_alias_mapping": ("parity", "select * from dp_mapped", ["total_demand_partner_revenue_usd"]),
    "dp_site_slice": ("parity", "select * from dp_slice", []),
    "dp_allocation": ("parity", "select * from dp_allocated", ["weight", "allocated_actual_revenue"]),
    "dp_allocation_safe": ("safe", "select * from dp_allocated", ["weight", "allocated_actual_revenue"]),
    "ssp_pull": ("parity", "select * from ssp_pull", ["revenue_usd"]),
    "ssp_country_normalised": ("parity", "select * from ssp_daily", ["revenue_usd"]),
    "ssp_explode": ("parity", "select * from ssp_exploded", _SSOT_D),
    "ssp_explode_safe": ("safe", "select * from ssp_exploded", _SSOT_D),
    "syndication_pull": ("parity", "select * from syn_pull", ["total_revenue"]),
    "syndication_explode": ("parity", "select * from syn_exploded", _SSOT_D),
    "merge_events": ("parity", "select * from ssot1", _SSOT_D),
    "merge_ssp": ("parity", "select * from ssot2", _SSOT_D),
    "merge_ssp_safe": ("safe", "select * from ssot2", _SSOT_D),
    "merge_syndication": ("parity", "select * from ssot3", _SSOT_D),
    "merge_demand_partner": ("parity", "select * from ssot4", _SSOT_D),
    "merge_gam": ("parity", "select * from ssot5 where max_gam_timestamp is not null", _SSOT_D),
    "consolidated_all_sources": ("parity", "select * from ssot5", _SSOT_D),
    "consolidated_all_sources_safe": ("safe", "select * from ssot5", _SSOT_D),
    "merge_twice_idempotent": ("parity", "select * from ssot_rerun", _SSOT_D),
    "dq_grain_uniqueness": ("parity", "select * from dq_grain", []),
    "dq_required_fields": ("parity", "select * from dq_required", []),
    "dq_no_negatives": ("parity", "select * from dq_negatives", []),
    "dq_ssp_conservation": ("parity", "select * from dq_ssp_cons", ["expected_value", "actual_value"]),
    "dq_syndication_conservation": ("parity", "select * from dq_syn_cons", ["expected_value", "actual_value"]),
    "dq_gam_bounding": ("parity", "select * from dq_gam_bound", ["expected_value", "actual_value"]),
    "dq_dp_bounding": ("parity", "select * from dq_dp_bound", ["expected_value", "actual_value"]),
    "dq_suite": ("parity", "select * from dq_suite", []),
    "dq_suite_safe": ("safe", "select * from dq_suite", []),
    "consolidated_second_run": ("second", "select * from r2_ssot5", _SSOT_D),
    "raw_retention": ("parity", f"select * from events_stream where cast(timestamp as date) >= "
                                f"{RETENTION_AS_OF} - {RETENTION_DAYS}", ["cpm"]),
    "events_stream_available_now": ("parity", "select * from ssot1", _SSOT_D),
}


def _renamed(text: str, names: dict[str, str]) -> str:
    pat = re.compile(r"\b(" + "|".join(sorted(names, key=len, reverse=True)) + r")\b")
    return pat.sub(lambda m: names[m.group(1)], text)


def _after(first: dict[str, str], step: dict[str, str], target: str = "ssot5", prefix: str = "r2_") -> dict[str, str]:
    """CTEs of ``first``, then those of ``step`` under a prefix, starting from the fact table ``target``."""
    names = {k: prefix + k for k in step if k not in VIEWS and k != "ssot0"} | {"ssot0": target}
    out = dict(first)
    for k in step:
        if k not in VIEWS and k != "ssot0":
            out[prefix + k] = _renamed(step[k], names)
    return out


def _restricted(ctes: dict[str, str], where: dict[str, str]) -> dict[str, str]:
    """The same CTEs over the views ``where`` names, cut down to rows that satisfy its conditions."""
    names = {k: "some_" + k for k in where}
    out = {k: v for k, v in ctes.items() if k in VIEWS}
    out |= {f"some_{k}": f"select * from {k} where {cond}" for k, cond in where.items()}
    return out | {k: _renamed(v, names) for k, v in ctes.items() if k not in VIEWS}


DAY_COLUMNS = {"events_stream": "timestamp", "fact_gam_data_transfer": "timestamp", "fact_demand_partner_reports": "report_date",
               "fact_ssp_report": "report_date", "fact_syndication_revenue": "transaction_date"}
CUTOFF, GAP_FROM, GAP_TO = "date '2024-01-20'", "date '2024-01-05'", "date '2024-01-25'"
TRAFFIC_FROM, GAM_UNTIL = "date '2024-01-03'", "date '2024-01-04'"
NOTHING = {k: "false" for k in DAY_COLUMNS}


def second_run_ctes() -> dict[str, str]:
    """The parity backfill followed by one reference-rule hourly run over its result."""
    return _after(pipeline_ctes("parity"), pipeline_ctes("parity", catch_up=False, run_ts=RUN_TS2, today=TODAY2))


def persisted_ctes() -> dict[str, str]:
    """A hardened run over the days before the cutoff, then one over all days.

    The second takes partner reports that the first did not know, and those that it could not
    allocate and whose date has got traffic since (events are read again from the watermark's hour on).
    """
    first = _restricted(pipeline_ctes("safe"), {k: f"cast({c} as date) < {CUTOFF}" for k, c in DAY_COLUMNS.items()})
    first["dp_done"] = "select distinct event_date, network from dp_allocated"
    step: dict[str, str] = {}
    for k, v in pipeline_ctes("safe", run_ts=RUN_TS2, today=TODAY2).items():
        if k == "dp_dates":
            step["dp_pairs"] = """select distinct report_date, partner_name from fact_demand_partner_reports r
 where not exists (select 1 from dp_done d where d.event_date = r.report_date and d.network = r.partner_name)
 and (not exists (select 1 from some_fact_demand_partner_reports s where s.report_date = r.report_date and s.partner_name = r.partner_name)
   or r.report_date >= cast((select increment_column from ev_wm) as date))"""
            v = "select distinct report_date from dp_pairs"
        elif k == "dp_pull":
            v = """select r.*, r.report_date as max_demand_partner_date from fact_demand_partner_reports r
 semi join dp_pairs p on r.report_date = p.report_date and r.partner_name = p.partner_name"""
        step[k] = v
    return _after(first, step)


def events_gap_ctes(mode: str) -> dict[str, str]:
    """Events before a gap loaded; one step over events on both sides of it."""
    day = "cast(timestamp as date)"
    first = _restricted(pipeline_ctes(mode), {"events_stream": f"{day} < {GAP_FROM}"})
    step = pipeline_ctes(mode, catch_up=False, run_ts=RUN_TS2)
    step["ev_open"] = f"select * from events_stream where {day} < {GAP_FROM} or {day} >= {GAP_TO}"
    if mode == "parity":
        bounds = "timestamp > (select increment_column from ev_wm) and timestamp <= (select increment_column from ev_wm) + interval 5 day"
    else:
        step["ev_from"] = """select if(next >= increment_column + interval 5 day, date_trunc('hour', next), increment_column) as lo from ev_wm,
 (select min(timestamp) as next from ev_open where timestamp > (select max(max_events_stream_timestamp) from ssot0))"""
        bounds = "timestamp >= (select lo from ev_from) and timestamp < (select lo from ev_from) + interval 5 day"
    step["ev_hosts"] = re.sub(r"from events_stream where .*\Z", f"from ev_open where {bounds}", step["ev_hosts"], flags=re.S)
    order = ["ev_wm", "ev_open", "ev_from", "ev_hosts", "ev_pull", "ev_sums", "ev_grouped", "ssot1"]
    return _after({k: v for k, v in first.items() if k in VIEWS or k.startswith("some_") or k in order or k == "ssot0"},
                  {k: step[k] for k in order if k in step}, target="ssot1")


def gam_no_match_ctes() -> dict[str, str]:
    """All GAM days up to the last one, over traffic that starts later."""
    where = NOTHING | {"events_stream": f"cast(timestamp as date) >= {TRAFFIC_FROM}",
                       "fact_gam_data_transfer": f"cast(timestamp as date) < {GAM_UNTIL}"}
    return _restricted(pipeline_ctes("safe"), where)


def partner_head_ctes(mode: str) -> dict[str, str]:
    """Partner reports over traffic that starts later: all that have traffic, or (reference) the oldest date."""
    c = pipeline_ctes(mode)
    if mode == "parity":
        c["dp_dates"] = "select min(report_date) as report_date from dp_unprocessed having min(report_date) is not null"
    where = NOTHING | {"events_stream": f"cast(timestamp as date) >= {TRAFFIC_FROM}"}
    del where["fact_demand_partner_reports"]
    return _restricted(c, where)


def ssp_twins_ctes(mode: str) -> dict[str, str]:
    c = pipeline_ctes(mode)
    c["ssp_pull"] = (f"with once as ({c['ssp_pull']}) select * from once union all "
                     "select * replace ('US' as country_code) from once where country_code = 'USA'")
    return c


def partner_twins_ctes(mode: str) -> dict[str, str]:
    p = pipeline_ctes("parity")
    c = {k: p[k] for k in p if k in VIEWS or k in ("ssot0", "ev_wm", "ev_hosts", "ev_pull", "ev_sums", "ev_grouped")}
    c["dp_pull"] = """select * replace (if(impressions % 2 = 1, 'unmapped_b', ad_unit) as ad_unit), report_date as max_demand_partner_date
 from fact_demand_partner_reports"""
    c["dp_grouped"], c["dp_mapped"] = p["dp_grouped"], p["dp_mapped"]
    c["dp_slice"] = f"""select {', '.join(GRAIN)}, tracked_event_count from ev_grouped
 where event = 'served' and network not in ('GAM', 'MinuteSSP')
 and event_date in (select report_date from fact_demand_partner_reports)"""
    c["dp_allocated"] = _dp_alloc_sql(mode == "parity")
    return c


def late_files_ctes(found: bool) -> dict[str, str]:
    """Events but for late ones loaded; then the hours of the late ones and those after the watermark, over all events."""
    late = "(organizationId = 'org_2' and cast(timestamp as date) between date '2024-01-03' and date '2024-01-06')"
    first = _restricted(pipeline_ctes("safe"), NOTHING | {"events_stream": f"not coalesce({late}, false)"})
    step = pipeline_ctes("safe", run_ts=RUN_TS2)
    after = "timestamp >= (select increment_column from ev_wm)"
    again = f" or date_trunc('hour', timestamp) in (select date_trunc('hour', timestamp) from events_stream where {late})" if found else ""
    step["ev_hosts"] = re.sub(r"from events_stream where .*\Z", f"from events_stream where {after}{again}", step["ev_hosts"], flags=re.S)
    order = ["ev_wm", "ev_hosts", "ev_pull", "ev_sums", "ev_grouped", "ssot1"]
    return _after(first, {k: step[k] for k in order}, target="ssot1")


def ledger_ctes() -> dict[str, str]:
    """Partner reports of a first run, then those that are new or differ in the second: each pair's rows are compared as sorted text."""
    where = NOTHING | {"fact_demand_partner_reports": "not (partner_name = 'Triplelift' and day(report_date) % 2 = 0)"}
    del where["events_stream"]
    first = _restricted(pipeline_ctes("safe"), where)
    p = pipeline_ctes("safe", run_ts=RUN_TS2, today=TODAY2)
    again = "partner_name = 'Magnite' and report_date <= date '2024-01-10'"
    text = "concat_ws('|', " + ", ".join(f"coalesce({c}::varchar, '~')" for c in ("property_code", "ad_unit", "geo", "impressions", "revenue_usd")) + ")"
    forms = lambda t: f"select report_date, partner_name, string_agg({text}, ';' order by {text}) as form from {t} group by all"
    step = {
        "ssot3": "select * from ssot0",
        "reports": f"""select * replace (if({again}, revenue_usd * 2, revenue_usd) as revenue_usd) from fact_demand_partner_reports
 where not ({again} and property_code = 'org_0')""",
        "forms_then": forms("some_fact_demand_partner_reports"), "forms_now": forms("reports"),
        "dp_dates": """select n.report_date, n.partner_name, t.form is not null as restated from forms_now n
 left join forms_then t on n.report_date = t.report_date and n.partner_name = t.partner_name where t.form is distinct from n.form""",
        "dp_pull": """select r.*, r.report_date as max_demand_partner_date from reports r
 semi join dp_dates d on r.report_date = d.report_date and r.partner_name = d.partner_name""",
        "dp_grouped": p["dp_grouped"], "dp_mapped": p["dp_mapped"], "dp_slice": p["dp_slice"], "dp_allocated": p["dp_allocated"],
        "merged": p["ssot4"],
        "ssot4": f"""select m.* replace (if(gone, null, m.reconciled_event_count) as reconciled_event_count, if(gone, null, m.actual_revenue) as actual_revenue,
   if(gone, null, m.max_demand_partner_date) as max_demand_partner_date, if(gone, {RUN_TS2}, m.dwh_updated_at) as dwh_updated_at) from (
   select *, max_demand_partner_date is not null and dwh_updated_at < {RUN_TS2} and exists (select 1 from dp_dates d
     where d.restated and d.report_date = merged.event_date and d.partner_name = merged.network) as gone from merged) m""",
    }
    out = _after(first, step, target="ssot4")
    out["ledger_final"] = "select * exclude (gone) from r2_ssot4"
    return out


def replace_hours_ctes() -> dict[str, str]:
    """Events and partners loaded; one day's events again without a line item."""
    where = {k: v for k, v in NOTHING.items() if k not in ("events_stream", "fact_demand_partner_reports")}
    first = _restricted(pipeline_ctes("safe"), where)
    step = pipeline_ctes("safe", run_ts=RUN_TS2)
    step["ev_hosts"] = re.sub(r"from events_stream where .*\Z", f"from events_stream where cast(timestamp as date) = {CUTOFF} "
                              "and lineItem is distinct from '1'", step["ev_hosts"], flags=re.S)
    order = ["ev_hosts", "ev_pull", "ev_sums", "ev_grouped", "ssot1"]
    out = _after(first, {k: step[k] for k in order}, target="ssot4")
    gone = f"event_date = {CUTOFF} and tracked_event_count is not null and dwh_updated_at < {RUN_TS2}"
    out["replaced"] = f"""select * replace (if({gone}, null, tracked_event_count) as tracked_event_count,
   if({gone}, null, estimated_revenue) as estimated_revenue, if({gone}, null, max_events_stream_timestamp) as max_events_stream_timestamp,
   if({gone}, {RUN_TS2}, dwh_updated_at) as dwh_updated_at)
 from r2_ssot1 where not ({gone} and reconciled_event_count is null and max_demand_partner_date is null)"""
    return out


def _merge_counts_sql() -> str:
    """Matched and inserted rows of each merge, by joins of its target and source."""
    on = " and ".join(f"t.{k} is not distinct from s.{k}" for k in GRAIN)
    parts = []
    for source, target, src, result, inserts, cond in (
            ("events_stream", "ssot0", "ev_grouped", "ssot1", True, "true"), ("ssp", "ssot1", "ssp_exploded", "ssot2", True, "true"),
            ("syndication", "ssot2", "syn_exploded", "ssot3", True, "true"),
            ("demand_partner", "ssot3", "dp_allocated", "ssot4", False, "true"),
            ("gam", "ssot4", "gam_allocated", "ssot5", False, "t.network = 'GAM'")):
        over = "count(*) filter (t.tracked_event_count is not null)" if source in ("ssp", "syndication") else "0"
        parts.append(f"""select '{source}' as source, m.n as matched, {f"(select count(*) from {src}) - m.n" if inserts else "0"} as inserted,
 0 as withdrawn, 0 as deleted, m.o as overlapping, (select count(*) from {result}) as fact_rows
 from (select count(*) as n, {over} as o from {target} t join {src} s on {on} and {cond}) m""")
    return "select source, " + ", ".join(f"cast({c} as bigint) as {c}" for c in (
        "matched", "inserted", "withdrawn", "deleted", "overlapping", "fact_rows")) + " from (" + "\nunion all\n".join(parts) + ")"


def exact_counts_ctes() -> dict[str, str]:
    """GAM over events only; shares in whole numbers, what is missing by rank of the remainders."""
    where = {k: v for k, v in NOTHING.items() if k not in ("events_stream", "fact_gam_data_transfer")}
    c = _restricted(pipeline_ctes("safe"), where)
    group = "event_date, event_hour, line_item, country, unit"
    meets = "x.event_date = g.event_date and x.event_hour = g.event_hour and x.line_item is not distinct from g.line_item " \
        "and x.country is not distinct from g.country and x.unit = try_cast(g.ad_unit_id as bigint)"
    total, events = "cast(total_gam_impressions as hugeint)", "cast(tracked_event_count as hugeint)"
    c["gam_exact"] = f"""with j as (select x.*, g.total_gam_impressions, g.total_gam_revenue, g.max_gam_timestamp from gam_units x join gam_grouped g on {meets}),
 d as (select *, sum(tracked_event_count) over (partition by {group}) as whole from j),
 s as (select *, {total} * {events} // whole as base, {total} * {events} % whole as rest from d),
 r as (select *, total_gam_impressions - sum(base) over (partition by {group}) as missing, row_number() over (
   partition by {group} order by rest desc, {', '.join(k + ' nulls first' for k in GRAIN)}) as place from s)
 select {', '.join(GRAIN)}, tracked_event_count, total_gam_impressions, total_gam_revenue, max_gam_timestamp,
 cast(whole as bigint) as total_tracked_for_group, tracked_event_count / whole as weight,
 cast(base + if(place <= missing, 1, 0) as bigint) as allocated_reconciled_event_count,
 total_gam_revenue * (tracked_event_count / whole) as allocated_actual_revenue from r"""
    return c


URL_SHAPES = """select domain, count(*) as events from (
 select case event_id % 8 when 0 then 'site' || k || '.example.com' when 1 then 'cdn.site' || k || '.example.com'
   when 2 then 'site' || k || '.example.com' when 3 then 'b\u00fccher' || k || '.de' when 4 then '[::' || k || ']'
   when 5 then 'site' || k || '.example.com' when 6 then 'site' || k || '.example.com' end as domain
 from (select event_id, cast(user_id % 4 as varchar) as k from events)) group by all"""
_PROFILE = "\nunion all\n".join(
    f"select '{name}' as source, max(n) as most from (select count(*) as n from {cte} group by {', '.join(GRAIN)})"
    for name, cte in (("events_stream", "ev_grouped"), ("ssp", "ssp_exploded"), ("syndication", "syn_exploded"),
                      ("demand_partner", "dp_allocated"), ("gam", "gam_allocated")))
# name -> (CTEs, final select, double columns)
_SCENARIOS = {
    "persisted_two_runs": (persisted_ctes, "select * from r2_ssot5", _SSOT_D),
    "persisted_two_runs_staged": (persisted_ctes, "select * from r2_ssot5", _SSOT_D),
    "safe_single_step_events_gap": (lambda: events_gap_ctes("safe"), "select * from r2_ssot1", _SSOT_D),
    "parity_single_step_events_gap": (lambda: events_gap_ctes("parity"), "select * from r2_ssot1", _SSOT_D),
    "safe_single_step_gam_no_match": (gam_no_match_ctes, "select * from ssot5", _SSOT_D),
    "safe_single_step_dp_head_of_line": (lambda: partner_head_ctes("safe"), "select * from ssot4", _SSOT_D),
    "parity_single_step_dp_head_of_line": (lambda: partner_head_ctes("parity"), "select * from ssot4", _SSOT_D),
    "ssp_explode_twins": (lambda: ssp_twins_ctes("parity"), "select * from ssp_exploded", _SSOT_D),
    "ssp_explode_twins_safe": (lambda: ssp_twins_ctes("safe"), "select * from ssp_exploded", _SSOT_D),
    "dp_allocation_twins": (lambda: partner_twins_ctes("parity"), "select * from dp_allocated", ["weight", "allocated_actual_revenue"]),
    "dp_allocation_twins_safe": (lambda: partner_twins_ctes("safe"), "select * from dp_allocated", ["weight", "allocated_actual_revenue"]),
    "url_shapes": (dict, URL_SHAPES, []),
    "staging_by_expression": (lambda: dict(VIEWS), f"""select cast(timestamp as date) as event_date, event, count(*) as events
 from events_stream where cast(timestamp as date) < {CUTOFF} group by all""", []),
    "merge_skipped_source": (lambda: pipeline_ctes("safe"), "select * from ssot5", _SSOT_D),
    "merge_key_profile": (lambda: pipeline_ctes("safe"), _PROFILE, []),
    "events_late_files": (lambda: late_files_ctes(True), "select * from r2_ssot1", _SSOT_D),
    "parity_events_late_files": (lambda: late_files_ctes(False), "select * from r2_ssot1", _SSOT_D),
    "events_stream_stateful": (lambda: pipeline_ctes("safe"), "select * from ssot1", _SSOT_D),
    "persisted_crash_recovery": (persisted_ctes, "select * from (select *, 'after_crash' as state from ssot5 union all "
                                 "select *, 'recovered' as state from r2_ssot5)", _SSOT_D),
    "dp_ledger_late_and_restated": (ledger_ctes, "select * from ledger_final", _SSOT_D),
    "merge_replace_hours": (replace_hours_ctes, "select * from replaced", _SSOT_D),
    "merge_overlap_counts": (lambda: pipeline_ctes("safe"), _merge_counts_sql(), []),
    "gam_allocation_exact_counts": (exact_counts_ctes, "select * from gam_exact", ["total_gam_revenue", "weight", "allocated_actual_revenue"]),
    "gam_hour_gate": (lambda: dict(VIEWS), """select h as hour_of_day, h = 17 as due, count(*) as events
 from (select hour(ts) as h from events) group by all""", []),
}


def oracle_queries() -> dict[str, str]:
    out = {}
    ctes = {"parity": pipeline_ctes("parity"), "safe": pipeline_ctes("safe"), "second": second_run_ctes()}
    for name, (scenario, final, doubles) in _QUERIES.items():
        c = dict(ctes[scenario])
        if name == "dp_smart_delta_after":
            c["dpa_wm"] = ("select coalesce(max(max_demand_partner_date), date '1970-01-01') as increment_column "
                           "from ssot5")
            c.update(_delta_ctes("dpa", "ssot5", 0))
            final = ("select min(report_date) is not null as has_new_data, min(report_date) as increment_column "
                     "from dpa_unprocessed")
        out[name] = _with(c, _rounded(final, doubles))
    for name, (make, final, doubles) in _SCENARIOS.items():
        c = make()
        out[name] = _with(c, _rounded(final, doubles)) if c else final
    return out
