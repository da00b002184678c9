"""Input views over the generic test tables, in the input shapes of the plans.

Each view is one statement in SQL that Spark and the checking database both accept, so
the plans and the independent check start from the same rows. ``$name`` refers to a
base table or to an earlier view. Views only project, filter and stack base rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

VIEWS: dict[str, str] = {}

VIEWS["ev"] = """
select event_id, user_id, event_type,
  cast(ts as timestamp) as ts, cast(ts as date) as day,
  cast(value as decimal(18,8)) as amount,
  cast(regexp_extract(props, '[0-9]+', 0) as int) as k,
  case when user_id = 0 then ''
       when user_id = 1 then '00000000-0000-0000-0000-000000000000'
       when user_id = 2 then cast(null as string)
       else 'c' || cast(user_id as string) end as client_id,
  case when user_id % 25 = 24 then ''
       when user_id % 3 = 0 then 'App A'
       when user_id % 3 = 1 then 'App A GP'
       else 'app b ios' end as app_name,
  case when user_id % 4 = 0 then 'iOS' when user_id % 4 = 1 then 'ANDROID'
       when user_id % 4 = 2 then 'web' else cast(null as string) end as platform,
  'NATION_' || cast(user_id % 25 as string) as country,
  'CUR_' || cast(user_id % 25 as string) as currency_code
from $events
"""

# --- attribution ---

VIEWS["install_fields"] = """
select event_id, app_name, client_id, ts, platform, k, day,
  case when event_id % 5 = 0 then 'reattribution' when event_id % 5 = 1 then 'reinstall'
       else 'install' end as activity_kind,
  country as country_code,
  case when event_id % 4 = 3 then cast(null as string)
       else 'net_' || cast(event_id % 4 as string) end as media_source,
  'camp_' || cast(event_id % 3 as string) as promo_campaign,
  'cid_' || cast(event_id % 3 as string) as promo_campaign_id,
  case when k % 6 = 0 then cast(null as string) else 'ad_' || cast(event_id % 2 as string) end as ad,
  'set_' || cast(event_id % 2 as string) as adset,
  case when k % 5 = 0 then cast(null as string) else 'phone ' || cast(k % 5 as string) end as install_device_name,
  case when k % 2 = 0 then 'phone' else 'tablet' end as install_device_type
from $ev where event_type = 'signup'
"""

VIEWS["installs"] = """
select app_name, client_id, ts as install_time, activity_kind, platform, country_code, media_source,
  promo_campaign, promo_campaign_id, ad, adset, install_device_name, install_device_type
from $install_fields
"""

_RAW_INSTALL_COLUMNS = """
  app_name, client_id, activity_kind, platform, country_code, media_source, promo_campaign,
  promo_campaign_id, ad, 'x' || ad as ad_id, adset, 'x' || adset as adset_id,
  install_device_name, install_device_type,
  'v' || cast(k % 4 as string) as app_version, 'sdk' || cast(k % 3 as string) as sdk_version,
  'USD' as cost_currency, case when k % 2 = 0 then 'CPI' else 'CPM' end as cost_model,
  cast(k as decimal(18,8)) as cost_value, ts as click_time,
  'd' || cast(k % 9 as string) as donor_id, 'site' || cast(k % 7 as string) as site_id
"""

# Start times in all usual spellings, one of them unreadable.
VIEWS["raw_installs"] = f"""
select {_RAW_INSTALL_COLUMNS},
  case when k % 10 = 0 then 'n/a'
       when k % 10 = 1 then replace(cast(ts as string), ' ', 'T') || 'Z'
       when k % 10 = 2 then cast(day as string)
       when k % 10 = 3 then '17040672' || cast(10 + k as string)
       when k % 20 = 4 then '17040672' || cast(10 + k as string) || '123'
       when k % 20 = 14 then substr(cast(ts as string), 1, 16)
       when k % 20 = 5 then substr(cast(ts as string), 1, 19) || '+0000'
       when k % 20 = 15 then substr(cast(ts as string), 1, 19) || ' +00:00'
       when k % 10 = 6 then substr(cast(ts as string), 1, 19) || '.123456000'
       else cast(ts as string) end as installed_at,
  ts as version
from $install_fields where event_id % 3 <> 0
union all
select {_RAW_INSTALL_COLUMNS}, cast(ts as string) as installed_at, ts + interval 1 hour as version
from $install_fields where event_id % 3 <> 0 and k % 10 >= 7
"""

VIEWS["raw_reinstalls"] = f"""
select {_RAW_INSTALL_COLUMNS}, cast(ts as string) as installed_at,
  case when k % 2 = 0 then cast(ts + interval 5 minute as string) else cast(null as string) end as reattributed_at,
  ts as version
from $install_fields where event_id % 3 = 0
"""

# --- events of users ---

_PRICES = """
  cast(amount * 0.7 as decimal(18,8)) as price, amount as price_gross,
  cast(amount * 2 as decimal(18,8)) as local_price,
  case when k % 3 = 0 then 'USD' when k % 3 = 1 then 'EUR' else cast(null as string) end as currency,
  case when k % 4 = 0 then cast(null as decimal(18,8)) when k % 4 = 1 then cast(0 as decimal(18,8))
       when k % 4 = 2 then cast(2 as decimal(18,8)) else cast(1.25 as decimal(18,8)) end
    as currency_rates_denominator
"""

VIEWS["inapp"] = f"""
select case when event_type = 'error' then 'refund' else 'purchase' end as event_name,
  client_id, app_name, platform, ts as event_time, {_PRICES},
  case when k % 5 = 0 then cast(null as decimal(18,8)) when k % 5 = 1 then cast(-1 as decimal(18,8))
       else cast(0.85 as decimal(18,8)) end as vat_income_multiplier
from $ev
where (event_type = 'purchase' and event_id % 2 = 0) or (event_type = 'error' and event_id % 6 = 0)
"""

VIEWS["subscription"] = f"""
select case when event_type = 'error' then 'refund' else 'purchase' end as event_name,
  client_id, app_name, platform, ts as event_time, {_PRICES},
  case when k % 3 = 0 then 'NORMAL' when k % 3 = 1 then 'TRIAL' else 'normal' end as period_type,
  case when k % 7 = 0 then 1 else 0 end as is_trial_conversion,
  case when k % 2 = 0 then 'RENEWAL' else 'INITIAL_PURCHASE' end as type,
  case when k % 11 = 0 then 1 else cast(null as int) end as cancel_ind
from $ev
where (event_type = 'purchase' and event_id % 2 = 1) or (event_type = 'error' and event_id % 6 = 1)
"""

# Sessions of an hour; every ninth event belongs to one that spans the day around them.
VIEWS["session_events"] = """
select app_name, client_id, ts as event_time, event_type as event_name,
  case when k % 9 = 0 then cast(user_id as string) || '-' || cast(day as string)
       else cast(user_id as string) || '-' || cast(day as string) || '-' || cast(hour(ts) as string) end as session_id,
  cast(extract(day from ts) * 24 + extract(hour from ts) as int) as session_number,
  'v' || cast(k % 4 as string) as app_version, country,
  'd' || cast(k % 3 as string) as device_name, 'os' || cast(k % 5 as string) as device_version
from $ev where event_type in ('click', 'view')
"""

_AD_FORMAT = """
  case when k % 7 = 0 then 'BANNER' when k % 7 = 1 then 'interstitial' when k % 7 = 2 then 'rewarded'
       when k % 7 = 3 then 'native' when k % 7 = 4 then 'mrec' when k % 7 = 5 then 'playable'
       else cast(null as string) end
"""

VIEWS["ad_primary"] = f"""
select app_name, case when user_id % 2 = 0 then 'App A' else cast(null as string) end as project,
  client_id, platform, country, ts as event_time, {_AD_FORMAT} as ad_format, {_AD_FORMAT} as ad_type,
  amount as revenue
from $ev where event_type = 'view' and day >= date '2024-01-04'
"""

VIEWS["ad_history"] = f"""
select app_name, cast(null as string) as project, client_id, platform, country, ts as event_time,
  {_AD_FORMAT} as ad_format, {_AD_FORMAT} as ad_type, cast(amount * 0.5 as decimal(18,8)) as revenue
from $ev where event_type in ('view', 'click')
"""

# --- spend and rates ---

VIEWS["spend_a"] = """
select ts as report_time, platform as os, app_name as app, country as geo,
  'camp_' || cast(event_id % 3 as string) as campaign, 'cid_' || cast(event_id % 3 as string) as campaign_id,
  'set_' || cast(event_id % 2 as string) as ad_group, 'xset_' || cast(k % 2 as string) as ad_group_id,
  case when k % 6 = 0 then cast(null as string) else 'ad_' || cast(event_id % 2 as string) end as creative,
  case when k % 6 = 0 then cast(null as string) else 'xad_' || cast(k % 4 as string) end as creative_id,
  'site' || cast(k % 3 as string) as publisher,
  amount as spend, k % 4 as clicks, k as shows
from $ev where event_type = 'click' and k < 60
"""

VIEWS["spend_b"] = """
select day as report_day, platform, app_name as application,
  'keyword_' || cast(k % 5 as string) as keyword, currency_code as currency,
  amount as local_cost, 1 as clicks, k as impressions
from $ev where event_type = 'click' and k >= 60
"""

VIEWS["rate_snapshots"] = """
select 'USD' as base_currency, currency_code as currency, ts as rate_time,
  cast(1 + (k % 5) * 0.25 as decimal(18,8)) as value
from $ev where event_type = 'error'
union all
select 'EUR' as base_currency, currency_code as currency, ts as rate_time, cast(9 as decimal(18,8)) as value
from $ev where event_type = 'error' and k % 3 = 0
"""

# --- payments and revenue feeds ---

_PAYMENT_COLUMNS = """
  event_id as payment_id, ts as purchased_at_ms, app_name as application,
  case when event_id % 5 = 0 then 'app_store' when event_id % 5 = 1 then 'App Store'
       when event_id % 5 = 2 then 'play_store' when event_id % 5 = 3 then 'google'
       else cast(null as string) end as store_name,
  case when k % 5 = 0 then 'sub_month' when k % 5 = 1 then 'Consumable' when k % 5 = 2 then 'non_consumable'
       when k % 5 = 3 then 'other' else cast(null as string) end as product_id_type,
  case when k % 3 = 0 then 'INITIAL_PURCHASE' when k % 3 = 1 then 'NON_RENEWING_PURCHASE'
       else 'CANCELLATION' end as type,
  case when k % 13 = 0 then cast(null as decimal(18,8)) else amount end as price,
  case when k % 4 = 0 then cast(null as decimal(18,8)) when k % 4 = 1 then cast(0 as decimal(18,8))
       when k % 4 = 2 then cast(2 as decimal(18,8)) else cast(1.25 as decimal(18,8)) end
    as currencyRatesDenominator
"""

VIEWS["payments"] = f"""
select {_PAYMENT_COLUMNS}, ts as received_at from $ev where event_type = 'purchase'
union all
select {_PAYMENT_COLUMNS}, ts + interval 2 hour as received_at
from $ev where event_type = 'purchase' and k % 10 = 0
"""

VIEWS["store_raw"] = """
select cast(o_orderdate as timestamp) as event_time,
  case when o_custkey % 3 = 0 then 'APP A' when o_custkey % 3 = 1 then 'app b ios' else 'Other' end as app_name,
  case when o_custkey % 2 = 0 then 'iOS' else 'IOS' end as platform,
  cast(o_totalprice as decimal(18,8)) as gross_usd,
  cast(cast(o_totalprice as decimal(18,8)) * 0.7 as decimal(18,8)) as net_usd,
  case when o_orderkey % 2 = 0 then 1 else 0 end as is_subscription
from $orders
"""

VIEWS["attribution_raw"] = """
select cast(l_shipdate as timestamp) as event_time,
  case when l_suppkey % 3 = 0 then 'App A' when l_suppkey % 3 = 1 then 'App A GP' else '' end as app_name,
  case when l_suppkey % 4 = 0 then 'android' when l_suppkey % 4 = 1 then 'Android TV'
       when l_suppkey % 4 = 2 then 'ios' else cast(null as string) end as platform,
  case when l_linenumber % 3 = 0 then 'subscription' when l_linenumber % 3 = 1 then 'inapp' else 'ad' end
    as revenue_kind,
  cast(l_extendedprice as decimal(18,8)) as revenue_usd
from $lineitem
"""

# --- raw in-app purchases ---

_PURCHASE_COLUMNS = """
  't' || cast(event_id as string) as transaction_id, app_name, client_id, platform, country,
  case when event_id % 26 = 0 then ts + interval 60 days when event_id % 26 = 2 then ts - interval 60 days
       else ts end as event_time,
  'v' || cast(k % 4 as string) as app_version, case when k % 3 = 0 then k else cast(null as int) end as session_number,
  'd' || cast(k % 3 as string) as device_name, 'os' || cast(k % 5 as string) as device_version,
  'offer_' || cast(k % 3 as string) as trigger_name, k as trigger_number, k % 6 as session_trigger_number,
  case when k % 2 = 0 then 'none' else 'active' end as subscription_status, cast(k % 12 as string) as level,
  case when k % 2 = 0 then 'classic' else cast(null as string) end as mode,
  'cid_' || cast(event_id % 4 as string) as campaign_id,
  case when event_id % 3 = 0 then 'play' when event_id % 3 = 1 then 'app_store' else 'aggregator' end as source,
  cast(amount * (case when event_id % 3 = 0 then 1000000 when event_id % 3 = 1 then 1000 else 1 end)
    as decimal(28,8)) as price,
  case when k % 2 = 0 then cast(0.85 as decimal(9,6)) else cast(null as decimal(9,6)) end as takehome_percentage,
  currency_code as currency, 'p' || cast(event_id % 250 as string) as product_id
"""

# Some purchases lie before the first and long after the last exchange rate.
VIEWS["purchases_raw"] = f"""
select {_PURCHASE_COLUMNS}, ts as version from $ev where event_type = 'purchase' and event_id % 2 = 0
union all
select {_PURCHASE_COLUMNS}, ts + interval 1 hour as version
from $ev where event_type = 'purchase' and event_id % 6 = 0
"""

VIEWS["products"] = """
select 'p' || cast(p_partkey as string) as product_id,
  case when p_size % 3 = 0 then 'consumable' when p_size % 3 = 1 then 'non_consumable' else 'sub' end
    as product_id_type
from $part
"""

VIEWS["campaigns"] = """
select 'cid_' || cast(r_regionkey as string) as campaign_id, 'Campaign ' || r_name as campaign_name,
  case when r_regionkey % 2 = 0 then 'Parent' else cast(null as string) end as parent_campaign_name,
  'type_' || cast(r_regionkey % 2 as string) as campaign_type
from $region where r_regionkey < 3
"""

VIEWS["validations"] = """
select app_name, 't' || cast(event_id as string) as transaction_id
from $ev where event_type = 'purchase' and event_id % 7 <> 0
union all
select app_name, 't' || cast(event_id as string) as transaction_id
from $ev where event_type = 'purchase' and event_id % 10 = 0
"""

VIEWS["fees"] = """
select 'IOS' as platform, n_name as country,
  cast(0.7 + n_regionkey * 0.05 as decimal(18,8)) as vat_income_multiplier from $nation
union all
select 'ANDROID' as platform, n_name as country,
  cast(0.85 as decimal(18,8)) as vat_income_multiplier from $nation
"""

VIEWS["refund_candidates"] = """
select app_name, 't' || cast(event_id as string) as transaction_id,
  case when k % 9 = 0 then ts - interval 1 hour else ts + interval 2 hour end as refund_time,
  'r' || cast(event_id as string) as refund_transaction_id,
  case when k % 3 = 0 then 'play' when k % 3 = 1 then 'app_store' else 'aggregator' end as source,
  case when k % 2 = 0 then 101 when k % 5 = 0 then 5 else 0 end as state,
  case when k % 4 = 1 then 'REFUND' else cast(null as string) end as notification,
  case when k % 4 = 3 then 'CUSTOMER_SUPPORT' when k % 4 = 2 then 'UNSUBSCRIBE'
       else cast(null as string) end as cancel_reason
from $ev where event_type = 'purchase' and event_id % 2 = 0 and k % 5 <> 1
union all
select app_name, 't' || cast(event_id as string) as transaction_id, ts + interval 3 hour as refund_time,
  'rr' || cast(event_id as string) as refund_transaction_id, 'play' as source, 101 as state,
  cast(null as string) as notification, cast(null as string) as cancel_reason
from $ev where event_type = 'purchase' and event_id % 2 = 0 and k % 4 = 0
"""

# --- raw subscriptions: three feeds that partly know the same transactions ---

_SUB_COLUMNS = """
  app_name, 's' || cast(event_id as string) as transaction_id,
  case when k % 11 = 0 then cast(null as string)
       else 'chain' || cast(user_id as string) || '_' || cast(k % 3 as string) end as original_transaction_id,
  'p' || cast(event_id % 250 as string) as product_id,
  case when k % 3 = 0 then 'NORMAL' when k % 3 = 1 then 'TRIAL' else 'normal' end as period_type,
  case when k % 7 = 0 then 1 else 0 end as is_trial_conversion,
  currency_code as currency
"""

VIEWS["sub_aggregator"] = f"""
select {_SUB_COLUMNS}, 'a' || cast(event_id as string) as event_transaction_id, 'aggregator' as source,
  case when k % 5 = 0 then cast(null as string) else client_id end as client_id, ts as event_time,
  case when k % 2 = 0 then 'RENEWAL' else 'INITIAL_PURCHASE' end as type,
  cast(amount as decimal(28,8)) as price, cast(0.85 as decimal(9,6)) as takehome_percentage,
  cast(0.15 as decimal(9,6)) as comission_percentage,
  case when k % 2 = 0 then 'App_Store' else 'play_store' end as store, country,
  cast(null as int) as state, cast(null as string) as notification, cast(null as string) as cancel_reason
from $ev where event_type = 'purchase' and event_id % 2 = 1 and k % 3 <> 0
union all
select {_SUB_COLUMNS}, 'ar' || cast(event_id as string) as event_transaction_id, 'aggregator' as source,
  cast(null as string) as client_id, ts + interval 3 hour as event_time, 'CANCELLATION' as type,
  cast(amount as decimal(28,8)) as price, cast(0.85 as decimal(9,6)) as takehome_percentage,
  cast(0.15 as decimal(9,6)) as comission_percentage,
  case when k % 2 = 0 then 'App_Store' else 'play_store' end as store, country,
  cast(null as int) as state, cast(null as string) as notification, 'CUSTOMER_SUPPORT' as cancel_reason
from $ev where event_type = 'purchase' and event_id % 2 = 1 and k % 6 = 1
union all
select {_SUB_COLUMNS}, 'au' || cast(event_id as string) as event_transaction_id, 'aggregator' as source,
  cast(null as string) as client_id, ts + interval 2 days as event_time, 'CANCELLATION' as type,
  cast(amount as decimal(28,8)) as price, cast(0.85 as decimal(9,6)) as takehome_percentage,
  cast(0.15 as decimal(9,6)) as comission_percentage,
  case when k % 2 = 0 then 'App_Store' else 'play_store' end as store, country,
  cast(null as int) as state, cast(null as string) as notification, 'UNSUBSCRIBE' as cancel_reason
from $ev where event_type = 'purchase' and event_id % 2 = 1 and k % 5 = 2
"""

VIEWS["sub_app_store"] = f"""
select {_SUB_COLUMNS}, 'b' || cast(event_id as string) as event_transaction_id, 'app_store' as source,
  cast(null as string) as client_id, ts + interval 1 minute as event_time,
  case when k % 4 = 0 then 'DID_RENEW' else 'SUBSCRIBED' end as type,
  cast(amount * 1000 as decimal(28,8)) as price, cast(null as decimal(9,6)) as takehome_percentage,
  'App_Store' as store, cast(null as string) as country,
  case when k % 10 = 0 then 5 else 1 end as state,
  case when k % 12 = 0 then 'REFUND' else 'DID_RENEW' end as notification,
  cast(null as string) as cancel_reason
from $ev where event_type = 'purchase' and event_id % 2 = 1 and k % 2 = 0
"""

VIEWS["sub_play"] = f"""
select {_SUB_COLUMNS}, 'g' || cast(event_id as string) as event_transaction_id, 'play' as source,
  client_id, ts + interval 2 minute as event_time, 'PLAY_PURCHASE' as type,
  cast(amount * 1000000 as decimal(28,8)) as price, cast(null as decimal(9,6)) as takehome_percentage,
  'play_store' as store, country, case when k % 14 = 0 then 101 else 0 end as state,
  cast(null as string) as notification, case when k % 14 = 0 or k % 14 = 9 then '101' else cast(null as string) end
    as cancel_reason
from $ev where event_type = 'purchase' and event_id % 2 = 1
"""

_ACTIVATION_COLUMNS = """
  app_name, 's' || cast(event_id as string) as transaction_id, client_id, country,
  'v' || cast(k % 4 as string) as app_version
"""

VIEWS["paid_activations"] = f"""
select {_ACTIVATION_COLUMNS}, ts as event_time, 'paywall_' || cast(k % 3 as string) as trigger_name
from $ev where event_type = 'purchase' and event_id % 2 = 1 and k % 4 < 2
"""

VIEWS["trial_activations"] = f"""
select {_ACTIVATION_COLUMNS}, ts - interval 10 minute as event_time, 'trial' as trigger_name
from $ev where event_type = 'purchase' and event_id % 2 = 1 and k % 4 = 1
"""

# --- campaign snapshots ---

_SNAPSHOT_COLUMNS = """
  'acc' || cast(user_id % 3 as string) as account_id, 'c' || cast(user_id as string) as campaign_id,
  ts as snapshot_ts, 'Campaign ' || cast(k % 8 as string) as campaign_name,
  '{"goal":{"goal_type":"' || (case when k % 2 = 0 then 'ROAS' else 'CPI' end)
  || '","country_code_to_goal_value":{"US":' || cast(k as string) || ',"DE":1.5}},'
  || '"budget":{"country_code_to_daily_budget":{"US":' || cast(k * 10 as string) || ',"' || country || '":25.25}},'
  || '"targeting":{"countries":["US","' || country || '"]}}' as payload
"""

VIEWS["snapshots_raw"] = f"""
select {_SNAPSHOT_COLUMNS} from $ev where event_type = 'error'
union all
select {_SNAPSHOT_COLUMNS} from $ev where event_type = 'error' and k % 10 = 0
"""

_REF = re.compile(r"\$([a-z_]+)")


class Sample:
    """Views over one directory of test tables, built on first use."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark, self.directory = spark, directory
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        if name not in VIEWS:
            return self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        text = VIEWS[name].replace("{", "{{").replace("}", "}}")
        inputs = {ref: self[ref] for ref in _REF.findall(text)}
        return self.spark.sql(_REF.sub(r"{\1}", text), **inputs)


def view_ctes() -> list[tuple[str, str]]:
    """The views as ``(name, statement)`` in dependency order, for the checking database."""
    return [(name, _REF.sub(r"\1", text)) for name, text in VIEWS.items()]
