"""Check SQL, written separately from the plans and run by another engine.

Shared inputs are the sample views. Everything after them is formulated on its own:
as-of joins use the engine's ASOF JOIN, curves use a full day grid, buckets use one
conditional sum per column.
"""

from __future__ import annotations

from installarc.sources.sample import view_ctes

MONEY = "DECIMAL(18,8)"
RUN = "DATE '2024-02-01'"
VERSION = "TIMESTAMP '2024-02-01 00:00:00' AS version"
APPS = "('App A', 'App A GP', 'app b ios')"
ZERO = "'00000000-0000-0000-0000-000000000000'"

DIMS = ["platform", "application", "country", "media_source", "promo_campaign", "promo_campaign_id", "ad", "adset"]
KEY = ["cohort_date", *DIMS]
PARTS = "cohort_date, cast(date_trunc('month', cohort_date) AS DATE) AS cohort_month, cast(date_trunc('week', cohort_date) AS DATE) AS cohort_week"

SESSION = ["sessions_count", "session_duration_seconds_total", "session_event_count_total"]
BUYS = [
    "purchases",
    "refunds",
    "inapp_purchases",
    "inapp_refunds_num",
    "subscription_purchases",
    "subscription_refunds_num",
    "trial_purchases",
    "trial_converted_purchases",
    "renewal_purchases",
    "cancelations",
]
ADS = ["ad_impressions", "ad_impressions_rewarded", "ad_impressions_interstitial", "ad_impressions_banner"]
CASH = [
    "inapp_revenue_gross",
    "subs_revenue_gross",
    "ad_revenue_gross",
    "inapp_refunds_revenue_net",
    "subs_refunds_revenue_net",
    "inapp_revenue_net",
    "subs_revenue_net",
    "ad_revenue_rewarded_gross",
    "ad_revenue_interstitial_gross",
    "ad_revenue_banner_gross",
]
TOTALS = ["total_revenue_gross", "total_revenue_net"]
BUCKETS = [0, 1, 2, 3, 7, 14, 30, 180, 360]


_EARLY_DAYS = 6
_LATER = ["sessions_count", "purchases", "ad_impressions", "total_revenue_net"]


def _feature_cells():
    """Lists of (place, name, value) of all features of one lifetime in the aggregate over its days."""
    cells = [(f"{m}_d{d}", d, f"sum({m}) FILTER (day_idx = {d})") for m in [*SESSION, *BUYS, *ADS, *CASH, *TOTALS] for d in range(_EARLY_DAYS)]
    cells += [(f"{m}_later", _EARLY_DAYS, f"sum({m}) FILTER (day_idx >= {_EARLY_DAYS})") for m in _LATER]
    values = [f"CASE WHEN {RUN} - min(cohort_date) > {day} THEN coalesce(cast({value} AS DOUBLE), 0) END" for _, day, value in cells]
    return f"unnest(range({len(cells)})) AS place, unnest([{', '.join(repr(c[0]) for c in cells)}]) AS name, unnest([{', '.join(values)}]) AS x"


def _list(names, prefix=""):
    return ", ".join(prefix + n for n in names)


def _nothing(names):
    return ", ".join(f"cast(NULL AS VARCHAR) AS {n}" for n in names.split())


def _platform(col):
    return f"CASE WHEN {col} ILIKE '%ios%' THEN 'ios' WHEN {col} ILIKE '%and%' THEN 'android' ELSE 'unknown' END"


def _store(col):
    return (
        f"CASE WHEN {col} ILIKE '%app_store%' OR {col} ILIKE '%ios%' THEN 'ios' "
        f"WHEN {col} ILIKE '%play_store%' OR {col} ILIKE '%google%' OR {col} ILIKE '%android%' THEN 'android' "
        "ELSE 'unknown' END"
    )


def _blank(names):
    return ", ".join(f"coalesce({n}, '') AS {n}" for n in names)


def _money(expr):
    return f"cast(coalesce({expr}, 0) AS {MONEY})"


def _factor(col):
    return f"(CASE WHEN {col} > 0 THEN cast({col} AS DOUBLE) ELSE 1.0::DOUBLE END)"


def _gross(price, rate):
    return f"cast(coalesce(cast({price} AS DOUBLE), 0) / {_factor(rate)} AS DECIMAL(38,8))"


def _net(price, rate, fee):
    return f"cast(coalesce(cast({price} AS DOUBLE), 0) / {_factor(rate)} * {_factor(fee)} AS DECIMAL(38,8))"


def _unit_price(source="source", price="price", takehome="takehome_percentage"):
    return (
        f"CASE {source} WHEN 'aggregator' THEN cast({price} * coalesce({takehome}, 1) AS {MONEY}) "
        f"WHEN 'play' THEN cast(cast({price} AS DOUBLE) / 1000000 AS {MONEY}) "
        f"WHEN 'app_store' THEN cast(cast({price} AS DOUBLE) / 1000 AS {MONEY}) ELSE cast({price} AS {MONEY}) END"
    )


def _refund_signal():
    return (
        "coalesce((source = 'play' AND (state = 101 OR coalesce(cancel_reason, '') = '101')) OR (source = 'app_store' AND (notification = 'REFUND' OR state = 5)) "
        "OR (source = 'aggregator' AND cancel_reason = 'CUSTOMER_SUPPORT'), false)"
    )


def _revenue_type(kind, etype):
    return (
        f"CASE WHEN {kind} ILIKE '%sub%' THEN 'subscription' "
        f"WHEN {kind} ILIKE '%consumable%' OR {kind} ILIKE '%inapp%' OR {etype} = 'NON_RENEWING_PURCHASE' THEN 'inapp' "
        "ELSE 'subscription' END"
    )


STAMP = "strftime(install_time, '%Y-%m-%d %H:%M:%S.%f')"
OWNABLE = f"app_name <> '' AND client_id <> '' AND client_id <> {ZERO}"

CTES: dict[str, str] = {}

CTES["users_scd2"] = f"""
SELECT app_name, client_id, app_name || '|' || client_id || '|' || {STAMP} AS user_lifetime_id,
  cast(row_number() OVER w AS INTEGER) AS user_lifetime_number, install_time,
  cast(install_time AS DATE) AS install_date, lead(install_time) OVER w AS lifetime_end_time,
  platform, country_code, media_source, promo_campaign, promo_campaign_id, ad, adset,
  install_device_name, install_device_type
FROM installs WHERE client_id IS NOT NULL
WINDOW w AS (PARTITION BY app_name, client_id ORDER BY install_time)
"""

CTES["sess"] = """
SELECT app_name, client_id, session_id, min(session_number) AS session_number,
  min(event_time) AS session_start, max(event_time) AS session_end,
  date_diff('second', date_trunc('second', min(event_time)), date_trunc('second', max(event_time))) AS session_duration_seconds,
  count(*) AS session_event_count,
  arg_min(event_name, event_time) AS first_event_name, arg_max(event_name, event_time) AS last_event_name,
  arg_max(app_version, event_time) AS app_version, arg_max(country, event_time) AS country,
  arg_max(device_name, event_time) AS device_name, arg_max(device_version, event_time) AS device_version
FROM session_events GROUP BY ALL
"""

CTES["activity"] = f"""
SELECT d.*, 1 AS is_active, TIMESTAMP '2024-02-01 00:00:00' AS updated_at_utc,
  CASE WHEN u.lifetime_end_time IS NULL OR d.last_session_end_utc < u.lifetime_end_time THEN u.install_device_name END AS install_device_name,
  CASE WHEN u.lifetime_end_time IS NULL OR d.last_session_end_utc < u.lifetime_end_time THEN u.install_device_type END AS install_device_type
FROM (
  SELECT app_name, client_id, cast(session_start AS DATE) AS activity_date_utc,
    count(*) AS sessions_count, cast(sum(session_duration_seconds) AS BIGINT) AS session_duration_seconds_total,
    cast(sum(session_event_count) AS BIGINT) AS session_event_count_total,
    min(session_start) AS first_session_start_utc, max(session_end) AS last_session_end_utc,
    arg_max(app_version, session_end) AS app_version_last, arg_max(country, session_end) AS country_last,
    arg_max(device_name, session_end) AS device_name_last, arg_max(device_version, session_end) AS device_version_last
  FROM sess WHERE cast(session_start AS DATE) < {RUN} AND client_id <> '' GROUP BY ALL
) d ASOF LEFT JOIN users_scd2 u
  ON d.app_name = u.app_name AND d.client_id = u.client_id AND u.install_time <= d.last_session_end_utc
"""

_FORMATS = ["banner", "interstitial", "rewarded", "native", "mrec"]
CTES["ad_daily"] = (
    """
SELECT cast(event_time AS DATE) AS event_date, app_name, client_id, source_table, TIMESTAMP '2024-02-01 00:00:00' AS updated_at_utc,
  count(*) AS impressions_total, count(*) AS impressions_count,
  cast(sum(revenue) AS DECIMAL(18,8)) AS revenue_total, cast(sum(revenue) AS DECIMAL(18,8)) AS ad_revenue_total"""
    + "".join(
        f""",
  count(*) FILTER (fmt = '{f}') AS impressions_{f},
  cast(coalesce(sum(revenue) FILTER (fmt = '{f}'), 0) AS DECIMAL(18,8)) AS revenue_{f}"""
        for f in [*_FORMATS, "other"]
    )
    + f"""
FROM (
  SELECT *, CASE WHEN lower(ad_format) IN ({', '.join(repr(f) for f in _FORMATS)}) THEN lower(ad_format) ELSE 'other' END AS fmt
  FROM (
    SELECT *, 'primary' AS source_table FROM ad_primary
    UNION ALL
    SELECT *, 'history' AS source_table FROM ad_history
    WHERE cast(event_time AS DATE) NOT IN (SELECT cast(event_time AS DATE) FROM ad_primary)
  )
) GROUP BY 1, 2, 3, 4
"""
)

CTES["rates"] = """
SELECT base_currency, currency, d AS valid_from_date,
  cast(lead(d) OVER (PARTITION BY base_currency, currency ORDER BY d) - INTERVAL 1 DAY AS DATE) AS valid_to_date, value
FROM (
  SELECT *, lag(value) OVER (PARTITION BY base_currency, currency ORDER BY d) AS old
  FROM (SELECT base_currency, currency, cast(rate_time AS DATE) AS d, arg_max(value, rate_time) AS value
        FROM rate_snapshots GROUP BY 1, 2, 3)
) WHERE old IS NULL OR old <> value
"""

CTES["costs"] = f"""
SELECT day, platform, application, country, media_source, promo_campaign, promo_campaign_id, adset, adset_id, ad, ad_id, site_id, keywords,
  cast(sum(usd) AS {MONEY}) AS cost, cast(sum(clicks) AS BIGINT) AS clicks, cast(sum(impressions) AS BIGINT) AS impressions
FROM (
  SELECT cast(report_time AS DATE) AS day, os AS platform, app AS application, geo AS country, 'net_1' AS media_source,
    campaign AS promo_campaign, campaign_id AS promo_campaign_id, ad_group AS adset, ad_group_id AS adset_id, creative AS ad,
    creative_id AS ad_id, publisher AS site_id, NULL AS keywords, spend AS usd, clicks, shows AS impressions
  FROM spend_a
  UNION ALL
  SELECT g.day, platform, application, NULL, 'net_2', NULL, NULL, NULL, NULL, ad, NULL, NULL, ad, cast({_gross('cost', 'r.value')} AS {MONEY}), clicks, impressions
  FROM (SELECT report_day AS day, platform, application, keyword AS ad, currency, sum(local_cost) AS cost,
          sum(clicks) AS clicks, sum(impressions) AS impressions FROM spend_b GROUP BY 1, 2, 3, 4, 5) g
  LEFT JOIN rates r ON r.base_currency = 'USD' AND r.currency = g.currency AND g.day >= r.valid_from_date
    AND (r.valid_to_date IS NULL OR g.day <= r.valid_to_date)
) GROUP BY ALL
"""

_PROFILE = f"""
  cast(install_time AS DATE) AS cohort_date,
  {_platform('platform')} AS platform, app_name AS application, coalesce(country_code, '') AS country,
  {_blank(['media_source', 'promo_campaign', 'promo_campaign_id', 'ad', 'adset', 'install_device_name', 'install_device_type'])},
  client_id, user_lifetime_id, user_lifetime_number, install_time, lifetime_end_time,
  cast(install_time AS DATE) AS lifetime_start_date, cast(lifetime_end_time AS DATE) AS lifetime_end_date
"""
CTES["users"] = f"SELECT {_PROFILE} FROM users_scd2 WHERE {OWNABLE} AND install_date >= DATE '2024-01-01'"


def _asof(source, measures):
    """Rows of a timed source with the lifetime found by ASOF JOIN and the end check."""
    return f"""
SELECT s.app_name AS application, s.client_id, u.install_time, {measures}
FROM (SELECT * FROM {source} WHERE {OWNABLE}) s ASOF JOIN users u
  ON s.app_name = u.application AND s.client_id = u.client_id AND u.install_time <= s.event_time
WHERE u.lifetime_end_time IS NULL OR s.event_time < u.lifetime_end_time
"""


_BUY, _RET = "event_name = 'purchase'", "event_name = 'refund'"
_PAID = f"({_BUY} AND lower(period_type) = 'normal')"
CTES["inapp_owned"] = _asof(
    "inapp",
    f"""cast(s.event_time AS DATE) AS event_date,
  ({_BUY})::INT AS purchases, ({_RET})::INT AS refunds, ({_BUY})::INT AS inapp_purchases, ({_RET})::INT AS inapp_refunds_num,
  CASE WHEN {_BUY} THEN abs(price_gross) END AS inapp_revenue_gross,
  CASE WHEN {_RET} THEN abs(price) END AS inapp_refunds_revenue_net,
  CASE WHEN {_BUY} THEN abs(price) WHEN {_RET} THEN -abs(price) END AS inapp_revenue_net""",
)
CTES["subs_owned"] = _asof(
    "subscription",
    f"""cast(s.event_time AS DATE) AS event_date,
  {_PAID}::INT AS purchases, {_PAID}::INT AS subscription_purchases,
  ({_RET})::INT AS refunds, ({_RET})::INT AS subscription_refunds_num,
  ({_BUY} AND period_type ILIKE '%trial%')::INT AS trial_purchases,
  ({_BUY} AND is_trial_conversion = 1)::INT AS trial_converted_purchases,
  ({_BUY} AND upper(type) = 'RENEWAL')::INT AS renewal_purchases,
  coalesce(cancel_ind = 1, false)::INT AS cancelations,
  CASE WHEN {_PAID} THEN abs(price_gross) END AS subs_revenue_gross,
  CASE WHEN {_RET} THEN abs(price) END AS subs_refunds_revenue_net,
  CASE WHEN {_PAID} THEN abs(price) WHEN {_RET} THEN -abs(price) END AS subs_revenue_net""",
)
CTES["activity_owned"] = _asof(
    "(SELECT *, last_session_end_utc AS event_time FROM activity)",
    "activity_date_utc AS event_date, app_version_last, " + _list(SESSION),
)
CTES["ads_owned"] = """
SELECT u.application, u.client_id, u.install_time, u.user_lifetime_id, a.event_date,
  a.impressions_count AS ad_impressions, a.impressions_rewarded AS ad_impressions_rewarded,
  a.impressions_interstitial AS ad_impressions_interstitial, a.impressions_banner AS ad_impressions_banner,
  a.ad_revenue_total AS ad_revenue_gross, a.revenue_rewarded AS ad_revenue_rewarded_gross,
  a.revenue_interstitial AS ad_revenue_interstitial_gross, a.revenue_banner AS ad_revenue_banner_gross
FROM ad_daily a JOIN users u ON u.application = a.app_name AND u.client_id = a.client_id
  AND a.event_date >= u.lifetime_start_date AND (u.lifetime_end_date IS NULL OR a.event_date < u.lifetime_end_date)
"""

_ALL_COUNTS = [*SESSION, *BUYS, *ADS]
CTES["daily"] = f"""
SELECT {PARTS}, event_date, cast(date_diff('day', cohort_date, event_date) AS INTEGER) AS day_idx,
  {_list(DIMS)}, install_device_name, install_device_type, client_id, user_lifetime_id, user_lifetime_number,
  install_time, lifetime_start_date, lifetime_end_date, {_list(_ALL_COUNTS)}, app_version_last, {_list(CASH)},
  cast(inapp_revenue_gross + subs_revenue_gross + ad_revenue_gross AS {MONEY}) AS total_revenue_gross,
  cast(inapp_revenue_net + subs_revenue_net + ad_revenue_gross AS {MONEY}) AS total_revenue_net, {VERSION}
FROM users JOIN (
  SELECT event_date, application, client_id, install_time, max(app_version_last) AS app_version_last,
    {', '.join(f'cast(coalesce(sum({c}), 0) AS BIGINT) AS {c}' for c in _ALL_COUNTS)},
    {', '.join(f'{_money(f"sum({c})")} AS {c}' for c in CASH)}
  FROM (
    SELECT * FROM activity_owned UNION ALL BY NAME SELECT * FROM inapp_owned
    UNION ALL BY NAME SELECT * FROM subs_owned UNION ALL BY NAME SELECT * EXCLUDE (user_lifetime_id) FROM ads_owned
  ) GROUP BY ALL
) f USING (application, client_id, install_time)
WHERE event_date >= cohort_date
"""

_LONG_COUNTS = ["installs", "impressions", "clicks", "clients_sdk", *BUYS, *ADS]
CTES["cohort_long"] = f"""
SELECT {PARTS}, event_date, cast(event_date - cohort_date AS INTEGER) AS day_idx, {_list(DIMS)},
  {', '.join(f'cast(coalesce(sum({c}), 0) AS BIGINT) AS {c}' for c in _LONG_COUNTS)},
  {', '.join(f'{_money(f"sum({c})")} AS {c}' for c in ['cost', *CASH])},
  {_money('sum(coalesce(inapp_revenue_gross, 0) + coalesce(subs_revenue_gross, 0) + coalesce(ad_revenue_gross, 0))')} AS total_revenue_gross,
  {_money('sum(coalesce(inapp_revenue_net, 0) + coalesce(subs_revenue_net, 0) + coalesce(ad_revenue_gross, 0))')} AS total_revenue_net,
  {VERSION}
FROM (
  SELECT {_list(KEY)}, cohort_date AS event_date, 1 AS installs FROM users
  UNION ALL BY NAME
  SELECT day AS cohort_date, {_platform('platform')} AS platform, coalesce(nullif(application, ''), 'unknown') AS application,
    {_blank(DIMS[2:])}, day AS event_date, impressions, clicks, cost FROM costs WHERE day >= DATE '2024-01-01'
  UNION ALL BY NAME
  SELECT {_list(KEY)}, event_date, (sessions_count > 0)::INT AS clients_sdk, {_list([*BUYS, *ADS, *CASH])} FROM daily
) GROUP BY {_list(KEY)}, event_date
"""

CTES["utn"] = f"""
SELECT {PARTS}, {_list(DIMS)}, count(DISTINCT user_lifetime_id) FILTER (sessions_count > 0) AS clients_sdk_utn, {VERSION}
FROM daily GROUP BY {_list(KEY)}
"""


def _payer_kind(kind):
    of = f"FILTER (kind = '{kind}')"
    return f"""
  count(*) {of} AS {kind}_purchases,
  CASE WHEN count(*) {of} = 0 THEN NULL WHEN count(DISTINCT currency) {of} = 1 THEN min(currency) {of} ELSE 'MULTI' END AS {kind}_currency,
  CASE WHEN count(DISTINCT currency) {of} = 1 THEN {_money(f'sum(local_price) {of}')} END AS {kind}_amount_local_total,
  {_money(f'sum(price) {of}')} AS {kind}_amount_usd_total,
  min(cast(event_time AS DATE)) {of} AS first_{kind}_purchase_date"""


CTES["payers"] = f"""
SELECT {PARTS}, {_list(DIMS)}, client_id, user_lifetime_id,
  (inapp_purchases > 0)::INT AS is_inapp_payer, (subscription_purchases > 0)::INT AS is_subscription_payer,
  p.* EXCLUDE (user_lifetime_id), cast(first_purchase_timestamp AS DATE) AS first_purchase_date, {VERSION}
FROM users JOIN (
  SELECT user_lifetime_id, count(*) AS purchases_total, min(event_time) AS first_purchase_timestamp,
    {_payer_kind('inapp')}, {_payer_kind('subscription')}
  FROM (
    SELECT 'inapp' AS kind, app_name, client_id, event_time, currency, local_price, price FROM inapp WHERE event_name = 'purchase'
    UNION ALL
    SELECT 'subscription', app_name, client_id, event_time, currency, local_price, price FROM subscription WHERE event_name = 'purchase'
  ) b JOIN users u ON b.app_name = u.application AND b.client_id = u.client_id
    AND cast(event_time AS DATE) >= lifetime_start_date AND (lifetime_end_date IS NULL OR cast(event_time AS DATE) < lifetime_end_date)
  GROUP BY user_lifetime_id
) p USING (user_lifetime_id)
"""

_WIDE_COUNTS = ["ad_impressions", *BUYS, *ADS[1:]]
_WIDE_CASH = [*CASH[:3], "total_revenue_net", "total_revenue_gross", *CASH[3:]]
_PAYER = {
    "paying_users": ("first_purchase_date", "<="),
    "inapp_payers": ("first_inapp_purchase_date", "<="),
    "subs_payers": ("first_subscription_purchase_date", "<="),
    "new_payers": ("first_purchase_date", "="),
}


def _ripe(bucket):
    return "true" if bucket == 0 else f"(DATE '2024-01-31' - cohort_date) >= {bucket}"


def _wide():
    sums, payer_sums, out = [], [], []
    for name in ["installs", "impressions", "clicks"]:
        sums.append(f"cast(coalesce(sum({name}) FILTER (day_idx = 0), 0) AS BIGINT) AS {name}_0")
    sums.append(f"{_money('sum(cost) FILTER (day_idx = 0)')} AS cost_0")
    for b in BUCKETS:
        upto = f"FILTER (day_idx <= {b} AND {_ripe(b)})"
        at = f"FILTER (day_idx = {b} AND {_ripe(b)})"
        sums.append(f"cast(coalesce(sum(clients_sdk) {at}, 0) AS BIGINT) AS active_users_{b}")
        sums += [f"cast(coalesce(sum({m}) {upto}, 0) AS BIGINT) AS {m}_{b}" for m in _WIDE_COUNTS]
        sums += [f"{_money(f'sum({m}) {upto}')} AS {m}_{b}" for m in _WIDE_CASH]
        payer_sums += [
            f"count(*) FILTER ({day} - cohort_date {op} {b} AND {day} >= cohort_date AND {_ripe(b)}) AS {m}_{b}"
            for m, (day, op) in _PAYER.items()
        ]
    sums += [f"cast(sum({m}) AS BIGINT) AS {m}_utn" for m in _WIDE_COUNTS]
    sums += [f"{_money(f'sum({m})')} AS {m}_utn" for m in _WIDE_CASH]
    payer_sums += [f"count(*) FILTER ({day} >= cohort_date) AS {m}_utn" for m, (day, _) in _PAYER.items()]
    for b in [*BUCKETS, "utn"]:
        out.append(
            f"cast(inapp_refunds_revenue_net_{b} + subs_refunds_revenue_net_{b} AS {MONEY}) AS total_refunds_revenue_{b}"
        )
        out += [f"coalesce({m}_{b}, 0) AS {m}_{b}" for m in _PAYER]
    on = " AND ".join(f"m.{k} = x.{k}" for k in KEY)
    return f"""
SELECT {PARTS.replace('cohort_date', 'm.cohort_date', 1).replace("('month', cohort_date)", "('month', m.cohort_date)").replace("('week', cohort_date)", "('week', m.cohort_date)")},
  m.* EXCLUDE (cohort_date), {', '.join(out)}, coalesce(a.n, 0) AS active_users_utn, {VERSION}
FROM (SELECT {_list(KEY)}, {', '.join(sums)} FROM cohort_long WHERE application IN {APPS} GROUP BY {_list(KEY)}) m
LEFT JOIN (SELECT {_list(KEY)}, {', '.join(payer_sums)} FROM payers
  WHERE application IN {APPS} AND first_purchase_date >= cohort_date GROUP BY {_list(KEY)}) x ON {on}
LEFT JOIN (SELECT {_list(KEY)}, clients_sdk_utn AS n FROM utn WHERE application IN {APPS}) a ON {on.replace('x.', 'a.')}
"""


CTES["cohort_wide"] = _wide()

_ON_KEY = " AND ".join(f"g.{k} = l.{k}" for k in KEY)
CTES["curves"] = f"""
SELECT {PARTS}, cohort_day, {_list(DIMS)}, installs, spend,
  {', '.join(
      f'''cast({v} AS {MONEY}) AS {v}, cast(sum({v}) OVER upto AS {MONEY}) AS {v}_cumulative,
  cast(coalesce(sum({v}) OVER before, 0) AS {MONEY}) AS {v}_prev_day,
  cast(first_value({v}) OVER upto AS {MONEY}) AS {v}_day0'''
      for v in ['ad_revenue_gross', 'total_revenue_net'])}, {VERSION}
FROM (
  SELECT g.*, coalesce(l.ad_revenue_gross, 0) AS ad_revenue_gross, coalesce(l.total_revenue_net, 0) AS total_revenue_net
  FROM (
    SELECT {_list(KEY)}, cast(coalesce(sum(installs) FILTER (day_idx = 0), 0) AS BIGINT) AS installs,
      {_money('sum(cost) FILTER (day_idx = 0)')} AS spend,
      unnest(range(0, cast(least(greatest(DATE '2024-01-31' - cohort_date, 0), 30) AS INTEGER) + 1))::INTEGER AS cohort_day
    FROM cohort_long WHERE application IN {APPS} AND cohort_date < {RUN} AND day_idx BETWEEN 0 AND 30 GROUP BY {_list(KEY)}
  ) g LEFT JOIN cohort_long l ON {_ON_KEY} AND l.day_idx = g.cohort_day
)
WINDOW upto AS (PARTITION BY {_list(KEY)} ORDER BY cohort_day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  before AS (PARTITION BY {_list(KEY)} ORDER BY cohort_day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
"""

# --- revenue ---

_LA_TS = "cast((({0} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles') AS DATE)"


def _own(source, name, target):
    signed = f"CASE WHEN event_name = 'refund' THEN -abs(g) ELSE abs(g) END"
    return f"""
SELECT {_LA_TS.format('event_time')} AS event_date, coalesce(nullif(app_name, ''), 'unknown') AS app_name,
  {_platform('platform')} AS platform, 'own_events' AS source_tag, '{name}' AS source_model, {signed} AS {target},
  (event_name = 'purchase')::INT AS buys, (event_name = 'refund')::INT AS rets, 1 AS n
FROM (SELECT *, {_gross('local_price', 'currency_rates_denominator')} AS g FROM {source})
"""


def _feed(source, keys):
    return f"""
SELECT cast(event_time AS DATE) AS event_date, {keys}, sum(revenue) AS revenue, count(*) AS imps
FROM {source} GROUP BY ALL
"""


CTES["store_feed"] = f"""
SELECT cast(event_time AS DATE) AS event_date, 'store' AS source_table, app_name, platform, cast(sum(gross_usd) AS {MONEY}) AS revenue_gross_usd,
  cast(sum(net_usd) AS {MONEY}) AS revenue_net_usd,
  {_money('sum(gross_usd) FILTER (is_subscription = 1)')} AS revenue_gross_usd_subscription,
  {_money('sum(gross_usd) FILTER (is_subscription = 0)')} AS revenue_gross_usd_inapp, count(*) AS rows_count
FROM store_raw GROUP BY 1, 2, 3, 4
"""
CTES["attribution_feed"] = f"""
SELECT cast(event_time AS DATE) AS event_date, 'attribution' AS source_table, app_name, platform, cast(sum(revenue_usd) AS {MONEY}) AS revenue_total,
  {', '.join(f"{_money(f'''sum(revenue_usd) FILTER (revenue_kind = '{k}')''')} AS revenue_{k}" for k in ['subscription', 'inapp', 'ad'])},
  count(*) FILTER (revenue_kind = 'ad') AS count_impression, count(*) AS count_total
FROM attribution_raw GROUP BY 1, 2, 3, 4
"""
CTES["imp_feed"] = f"""
SELECT cast(event_time AS DATE) AS event_date, 'ad_impressions' AS source_table, app_name, project, platform, ad_type,
  cast(sum(revenue) AS {MONEY}) AS revenue_total, count(*) AS impressions_count FROM ad_primary GROUP BY 1, 2, 3, 4, 5, 6
"""
CTES["user_feed"] = f"""
SELECT cast(event_time AS DATE) AS event_date, 'ad_users' AS source_table, app_name, platform, ad_type,
  cast(sum(revenue) AS {MONEY}) AS revenue_total, count(*) AS impressions_count FROM ad_history GROUP BY 1, 2, 3, 4, 5
"""


def _ad_rows(source, tag, model, app):
    return f"""
SELECT {_LA_TS.format('cast(event_date AS TIMESTAMP)')} AS event_date, {app} AS app_name, {_platform('platform')} AS platform,
  '{tag}' AS source_tag, '{model}' AS source_model, revenue_total AS ad, impressions_count AS imps, 1 AS n FROM {source}
"""


CTES["revenue"] = f"""
SELECT event_date, app_name, platform, source_tag, source_model,
  {', '.join(f"cast({_money(f'sum({s})')} AS DOUBLE) AS {t}_revenue_gross" for s, t in [('ad', 'ad'), ('ia', 'inapp'), ('sub', 'subs')])},
  {', '.join(f"cast(coalesce(sum({s}), 0) AS BIGINT) AS {t}" for s, t in [('buys', 'purchase_events_count'), ('rets', 'refund_events_count'), ('imps', 'impressions_count'), ('n', 'rows_count')])}
FROM (
  {_own('subscription', 'subscription_fact', 'sub')} UNION ALL BY NAME {_own('inapp', 'inapp_fact', 'ia')}
  UNION ALL BY NAME
  SELECT {_LA_TS.format('purchased_at_ms')} AS event_date, coalesce(nullif(application, ''), 'unknown') AS app_name,
    {_store('store_name')} AS platform, 'payments' AS source_tag, 'payment_stream' AS source_model,
    CASE WHEN kind = 'subscription' THEN signed END AS sub, CASE WHEN kind = 'inapp' THEN signed END AS ia,
    (type <> 'CANCELLATION')::INT AS buys, (type = 'CANCELLATION')::INT AS rets, 1 AS n
  FROM (SELECT *, {_revenue_type('product_id_type', 'type')} AS kind,
      CASE WHEN type = 'CANCELLATION' THEN -abs({_gross('price', 'currencyRatesDenominator')}) ELSE abs({_gross('price', 'currencyRatesDenominator')}) END AS signed
    FROM payments)
  UNION ALL BY NAME {_ad_rows('user_feed', 'payments', 'revenue_ad_user', "coalesce(nullif(app_name, ''), 'unknown')")}
  UNION ALL BY NAME
  SELECT event_date, coalesce(nullif(app_name, ''), 'unknown') AS app_name, {_platform('platform')} AS platform,
    'store' AS source_tag, 'revenue_store' AS source_model, revenue_gross_usd_subscription AS sub,
    revenue_gross_usd_inapp AS ia, rows_count AS n FROM store_feed
  UNION ALL BY NAME
  SELECT event_date, coalesce(nullif(app_name, ''), 'unknown') AS app_name, {_platform('platform')} AS platform,
    'attribution' AS source_tag, 'revenue_attribution' AS source_model, revenue_subscription AS sub,
    revenue_inapp AS ia, revenue_ad AS ad, count_impression AS imps, count_total AS n FROM attribution_feed
  UNION ALL BY NAME {_ad_rows('imp_feed', 'ad_network', 'revenue_ad_impression', "coalesce(nullif(app_name, ''), nullif(project, ''), 'unknown')")}
) WHERE event_date >= DATE '1995-01-01' AND lower(app_name) IN ('app a', 'app a gp', 'app b ios') GROUP BY 1, 2, 3, 4, 5
"""

# --- silver ---

_KINDS = "activity_kind, platform, country_code, media_source, promo_campaign, promo_campaign_id, ad, ad_id, adset, adset_id, install_device_name, install_device_type"
_PARSED = """CASE WHEN regexp_full_match({0}, '[0-9]{{9,11}}') THEN make_timestamp(cast({0} AS BIGINT) * 1000000)
  WHEN regexp_full_match({0}, '[0-9]{{13}}') THEN make_timestamp(cast({0} AS BIGINT) * 1000)
  ELSE try_cast(regexp_replace(CASE WHEN length({0}) = 16 THEN {0} || ':00' ELSE replace({0}, 'T', ' ') END, ' ?([+]00:?00|Z)$', '') AS TIMESTAMP) END"""
CTES["attr_events"] = f"""
SELECT * EXCLUDE (rn, installed_at, reattributed_at) FROM (
  SELECT *, row_number() OVER (PARTITION BY app_name, client_id, install_time
      ORDER BY version DESC, source_table DESC, activity_kind DESC) AS rn
  FROM (
    SELECT *, NULL AS reattributed_at, {_PARSED.format('installed_at')} AS install_time, 'installs' AS source_table, 1 AS is_install FROM raw_installs
    UNION ALL BY NAME
    SELECT *, coalesce({_PARSED.format('reattributed_at')}, {_PARSED.format('installed_at')}) AS install_time, 'reinstalls' AS source_table, 0 AS is_install FROM raw_reinstalls
  ) WHERE install_time IS NOT NULL AND client_id <> ''
) WHERE rn = 1
"""

CTES["seen"] = """
SELECT app_name, client_id, min(event_time) AS first_event_time, cast(min(event_time) AS DATE) AS first_event_date,
  'sessions' AS source_table
FROM session_events WHERE client_id <> '' AND event_time >= DATE '2020-01-01' GROUP BY 1, 2
"""

_FIRST = ["media_source", "promo_campaign", "promo_campaign_id", "adset", "adset_id", "ad", "ad_id", "country_code", "platform"]
_LAST = ["app_version", "sdk_version", "cost_currency", "cost_model", "cost_value", "click_time", "donor_id", "site_id"]
_RETIRED = ["device_type", "device_name", "device_version", "lang", "is_idfa_available"]
CTES["profile"] = f"""
SELECT *, cast(first_install_time AS DATE) AS first_install_date, {', '.join(f'cast(NULL AS VARCHAR) AS {r}' for r in _RETIRED)}
FROM (
  SELECT f.app_name, f.client_id, f.install_time AS first_install_time, l.install_time AS last_event_time,
    l.activity_kind AS last_activity_kind,
    CASE WHEN l.activity_kind ILIKE 'reattrib%' THEN 'reattributed' ELSE 'installed' END AS last_attribution_status,
    l.is_install AS last_is_install, {', '.join(f'f.{c} AS first_{c}' for c in _FIRST)},
    {', '.join(f'l.{c} AS last_{c}' for c in [*_FIRST, *_LAST])}, l.source_table AS last_source_table,
    n.* EXCLUDE (app_name, client_id), 'attribution' AS user_presence_source
  FROM (SELECT * FROM attr_events QUALIFY row_number() OVER (PARTITION BY app_name, client_id ORDER BY install_time) = 1) f
  JOIN (SELECT * FROM attr_events QUALIFY row_number() OVER (PARTITION BY app_name, client_id ORDER BY install_time DESC) = 1) l
    USING (app_name, client_id)
  JOIN (SELECT app_name, client_id, max(version) AS source_max_version, count(*) AS attribution_events_count,
      count(*) FILTER (is_install = 1) AS install_events_count, count(*) FILTER (is_install = 0) AS reinstall_events_count,
      count(*) FILTER (activity_kind ILIKE 'reattrib%') AS reattribution_events_count
    FROM attr_events GROUP BY 1, 2) n USING (app_name, client_id)
  UNION ALL BY NAME
  SELECT app_name, client_id, first_event_time AS first_install_time, first_event_time AS last_event_time,
    'session' AS last_activity_kind, 'unknown' AS last_attribution_status, source_table AS last_source_table,
    0 AS attribution_events_count, 0 AS install_events_count, 0 AS reinstall_events_count, 0 AS reattribution_events_count,
    'sessions' AS user_presence_source
  FROM seen s WHERE NOT EXISTS (SELECT 1 FROM attr_events a WHERE a.app_name = s.app_name AND a.client_id = s.client_id)
)
"""


def _in_session(source, columns, found):
    return f"""
SELECT {columns}, z.session_id, {found}
FROM {source} e LEFT JOIN sess z
  ON z.app_name = e.app_name AND z.client_id = e.client_id AND e.event_time BETWEEN z.session_start AND z.session_end
QUALIFY row_number() OVER (PARTITION BY e.app_name, e.transaction_id ORDER BY z.session_start DESC, z.session_id DESC) = 1
"""


def _rate(alias, day):
    return f"""LEFT JOIN rates r ON r.base_currency = 'USD' AND r.currency = {alias}.currency AND {day} >= r.valid_from_date
  AND (r.valid_to_date IS NULL OR {day} <= r.valid_to_date)"""


CTES["staged"] = f"""
SELECT s.*, CASE WHEN client_id <> '' THEN cast(row_number() OVER (PARTITION BY app_name, client_id ORDER BY event_time, transaction_id) AS INTEGER) END AS purchase_number
FROM ({_in_session(f'''(
  SELECT p.app_name, p.transaction_id, nullif(p.client_id, '') AS client_id, upper({_platform('p.platform')}) AS platform, p.country, p.event_time,
    p.source, {_unit_price('p.source', 'p.price', 'p.takehome_percentage')} AS local_price, p.currency, p.product_id, d.product_id_type,
    p.app_version, p.session_number, p.device_name, p.device_version, p.trigger_name, p.trigger_number, p.session_trigger_number,
    p.subscription_status, p.level, p.mode, c.campaign_name, c.parent_campaign_name, c.campaign_type,
    f.vat_income_multiplier, r.value AS currency_rates_denominator,
    (EXISTS (SELECT 1 FROM validations v WHERE v.app_name = p.app_name AND v.transaction_id = p.transaction_id))::INT AS validator_matched
  FROM (SELECT * FROM purchases_raw QUALIFY row_number() OVER (PARTITION BY app_name, transaction_id ORDER BY event_time, version) = 1) p
  LEFT JOIN products d USING (product_id) LEFT JOIN campaigns c USING (campaign_id)
  LEFT JOIN fees f ON f.platform = upper({_platform('p.platform')}) AND f.country = p.country
  {_rate('p', 'cast(p.event_time AS DATE)')}
)''', 'e.* EXCLUDE (session_number)', 'coalesce(e.session_number, z.session_number) AS session_number, ' + _nothing('media_source creative promo_campaign'))}) s
"""

CTES["refunds"] = f"""
SELECT app_name, platform, transaction_id, 1 AS refund_ind, refund_time, refund_transaction_id, source AS refund_source
FROM (SELECT * FROM refund_candidates WHERE {_refund_signal()})
JOIN (SELECT app_name, transaction_id, platform, event_time FROM staged) USING (app_name, transaction_id)
WHERE refund_time >= event_time
QUALIFY row_number() OVER (PARTITION BY app_name, transaction_id ORDER BY refund_time, refund_transaction_id) = 1
"""

_FACT = "client_id, price, price_gross, local_price, currency, product_id, product_id_type, transaction_id, purchase_number, refund_ind, refund_time, refund_transaction_id, platform, app_name, session_id, session_number, app_version, trigger_name, device_name, device_version, country, currency_rates_denominator, vat_income_multiplier"
CTES["inapp_facts"] = f"""
SELECT z.*, coalesce((cast(event_time AS DATE) = d)::INT, 0) AS new_user
FROM (
  SELECT 'purchase' AS event_name, event_time, {_FACT} FROM valid_tx
  UNION ALL
  SELECT 'refund', refund_time, {_FACT} FROM valid_tx WHERE refund_ind = 1
) z LEFT JOIN (SELECT app_name, client_id, min(cast(event_time AS DATE)) AS d FROM valid_tx GROUP BY 1, 2) USING (app_name, client_id)
"""
_VALID = f"""
SELECT s.*, cast({_net('local_price', 'currency_rates_denominator', 'vat_income_multiplier')} AS {MONEY}) AS price,
  cast({_gross('local_price', 'currency_rates_denominator')} AS {MONEY}) AS price_gross,
  coalesce(x.refund_ind, 0) AS refund_ind, x.refund_time, x.refund_transaction_id
FROM staged s LEFT JOIN refunds x USING (app_name, transaction_id) WHERE validator_matched = 1
"""
CTES = {k: v for k, v in CTES.items() if k != "inapp_facts"} | {"valid_tx": _VALID, "inapp_facts": CTES["inapp_facts"]}

_SUB_OUT = "client_id, app_name, transaction_id, event_time, event_transaction_id, original_transaction_id, product_id, type, period_type, is_trial_conversion, takehome_percentage, comission_percentage, currency, store, country, cancel_reason, event_kind, event_name, (coalesce(type, '') = 'CANCELLATION')::INT AS cancel_ind"
CTES["sub_stream"] = f"""
SELECT s.*, f.vat_income_multiplier, r.value AS currency_rates_denominator,
  cast({_net('s.local_price', 'r.value', 'f.vat_income_multiplier')} AS {MONEY}) AS price
FROM (
SELECT {_SUB_OUT}, source AS event_source, priority,
  CASE WHEN event_kind = 'cancellation' THEN cast(0 AS {MONEY}) ELSE {_unit_price()} END AS local_price,
  CASE WHEN event_kind <> 'purchase' THEN event_transaction_id END AS refund_transaction_id
FROM (
  SELECT *, CASE WHEN event_kind = 'purchase' THEN 'purchase' ELSE 'refund' END AS event_name FROM (
  SELECT *, CASE WHEN {_refund_signal()} THEN 'refund' WHEN type = 'CANCELLATION' THEN 'cancellation' ELSE 'purchase' END AS event_kind
  FROM (SELECT *, 1 AS priority FROM sub_aggregator UNION ALL BY NAME SELECT *, 2 AS priority FROM sub_app_store
    UNION ALL BY NAME SELECT *, 3 AS priority FROM sub_play))
) QUALIFY row_number() OVER (PARTITION BY app_name, transaction_id, event_kind
    ORDER BY priority, event_time DESC, event_transaction_id) = 1
) s LEFT JOIN fees f ON f.platform = upper({_store('s.store')}) AND f.country = s.country
{_rate('s', 'cast(s.event_time AS DATE)')}
"""

CTES["sub_context"] = _in_session(
    """(SELECT * FROM (SELECT * FROM paid_activations UNION ALL BY NAME SELECT * FROM trial_activations)
  QUALIFY row_number() OVER (PARTITION BY app_name, transaction_id ORDER BY event_time, trigger_name) = 1)""",
    "e.*",
    "z.session_number, z.device_name, z.device_version",
)

CTES["sub_clients"] = """
SELECT s.* EXCLUDE (client_id, country, price, vat_income_multiplier, currency_rates_denominator, cancel_ind, refund_transaction_id),
  c.trigger_name, c.app_version, c.session_id, c.session_number, c.device_name, c.device_version, coalesce(s.country, c.country) AS country,
  coalesce(nullif(s.client_id, ''), nullif(c.client_id, '')) AS own_client
FROM sub_stream s LEFT JOIN sub_context c USING (app_name, transaction_id)
"""
CTES["sub_rows"] = f"""
SELECT a.*, coalesce(own_client, chain_client) AS client_id, upper({_store('store')}) AS platform
FROM sub_clients a LEFT JOIN (
  SELECT app_name, original_transaction_id, arg_min(own_client, (event_time, transaction_id)) AS chain_client
  FROM sub_clients WHERE own_client IS NOT NULL AND original_transaction_id IS NOT NULL GROUP BY 1, 2
) USING (app_name, original_transaction_id)
"""
CTES["sub_priced"] = f"""
SELECT p.* EXCLUDE (own_client), f.vat_income_multiplier, r.value AS currency_rates_denominator,
  coalesce(x.one, 0) AS refund_ind, x.refund_time, x.refund_transaction_id,
  (coalesce(p.type = 'CANCELLATION', false) OR p.cancel_reason IS NOT NULL)::INT AS cancel_ind
FROM sub_rows p LEFT JOIN fees f ON f.platform = p.platform AND f.country = p.country
{_rate('p', 'cast(p.event_time AS DATE)')}
LEFT JOIN (SELECT app_name, transaction_id, 1 AS one, event_time AS refund_time, event_transaction_id AS refund_transaction_id
  FROM sub_stream WHERE event_kind = 'refund') x ON x.app_name = p.app_name AND x.transaction_id = p.transaction_id
"""
CTES["sub_fact"] = f"""
SELECT event_name, trigger_name, client_id, app_name, transaction_id, event_time,
  cast({_net('local_price', 'currency_rates_denominator', 'vat_income_multiplier')} AS {MONEY}) AS price,
  cast({_gross('local_price', 'currency_rates_denominator')} AS {MONEY}) AS price_gross,
  local_price, currency, currency_rates_denominator, vat_income_multiplier, type, period_type, product_id,
  original_transaction_id, is_trial_conversion, store, refund_ind, refund_time, refund_transaction_id, platform,
  (counts AND lid IS NOT NULL AND row_number() OVER (PARTITION BY lid, counts ORDER BY event_time, transaction_id) = 1)::INT AS new_user,
  app_version, session_id, session_number, device_name, device_version, country, cancel_ind, CASE WHEN cancel_ind = 1 THEN event_time END AS cancel_time, cancel_reason
FROM (
  SELECT p.*, u.user_lifetime_id AS lid, p.event_name = 'purchase' AND p.cancel_ind = 0 AS counts
  FROM sub_priced p ASOF LEFT JOIN users_scd2 u
    ON u.app_name = p.app_name AND u.client_id = p.client_id AND u.install_time <= p.event_time
)
"""

CTES["snaps"] = """
SELECT account_id, cast(snapshot_ts AS DATE) AS snapshot_date, snapshot_ts, campaign_id, campaign_name,
  json_extract_string(payload, '$.goal.goal_type') AS goal_type, payload
FROM (SELECT DISTINCT * FROM snapshots_raw)
"""

_SNAP = "account_id, snapshot_ts, campaign_id"


def _exploded(path, kind, value, extra=""):
    return f"""
SELECT {_SNAP}, {extra} c AS country_code, cast(json_extract_string(payload, '{path}."' || c || '"') AS DOUBLE) AS {value}, '{kind}' AS kind
FROM (SELECT *, unnest(json_keys(payload, '{path}')) AS c FROM snaps)
"""


_DAILY_SUMS = f"""
SELECT event_date, count(*) AS lifetimes, cast(sum(sessions_count) AS BIGINT) AS sessions_count,
  cast(sum(purchases) AS BIGINT) AS purchases, cast(sum(total_revenue_gross) AS {MONEY}) AS total_revenue_gross,
  cast(sum(total_revenue_net) AS {MONEY}) AS total_revenue_net FROM daily GROUP BY 1"""

_UNKNOWN = ", ".join(f"nullif({c}, '') AS {c}" for c in DIMS)
_NULLABLE_UTN = f"SELECT * REPLACE ({_UNKNOWN}, nullif(cohort_date, DATE '2024-01-05') AS cohort_date) FROM utn"

_HELD = """inapp e {join} users_scd2 u ON e.app_name = u.app_name AND e.client_id = u.client_id AND event_time >= install_time
    AND (lifetime_end_time IS NULL OR event_time < lifetime_end_time + INTERVAL 3 DAY)"""

CTES["feature_ranks"] = f"""
SELECT *, rank() OVER (PARTITION BY place ORDER BY x) + (count(*) OVER (PARTITION BY place, x) - 1) / 2.0 AS r
FROM (SELECT user_lifetime_id, {_feature_cells()} FROM daily GROUP BY 1) WHERE x IS NOT NULL"""


_OWNED = """
SELECT i.app_name, i.client_id, event_name, event_time, price, u.user_lifetime_id, u.user_lifetime_number
FROM inapp i JOIN users_scd2 u ON i.app_name = u.app_name AND i.client_id = u.client_id
  AND event_time >= install_time AND (lifetime_end_time IS NULL OR event_time < lifetime_end_time)"""

QUERIES: dict[str, str] = {
    "scd2_lifetimes": f"""
SELECT app_name, client_id, app_name || '|' || client_id || '|' || {STAMP} AS user_lifetime_id,
  cast(row_number() OVER w AS INTEGER) AS user_lifetime_number, install_time, cast(install_time AS DATE) AS install_date,
  lead(install_time) OVER w AS lifetime_end_time, (lead(install_time) OVER w IS NULL)::INT AS is_current_lifetime,
  {_KINDS}, source_table, version AS source_version
FROM attr_events WINDOW w AS (PARTITION BY app_name, client_id ORDER BY install_time)""",
    "asof_join": """
SELECT i.app_name, i.client_id, event_name, event_time, price, u.user_lifetime_id, u.install_time, u.lifetime_end_time
FROM inapp i ASOF LEFT JOIN users_scd2 u
  ON i.app_name = u.app_name AND i.client_id = u.client_id AND u.install_time <= i.event_time""",
    "overlap_join": f"""
SELECT e.app_name, e.client_id, event_name, event_time, price, user_lifetime_id, install_time, 'all' AS mode FROM {_HELD.format(join='JOIN')}
UNION ALL
SELECT app_name, client_id, event_name, event_time, price, user_lifetime_id, install_time, 'latest' FROM (
  SELECT e.*, u.user_lifetime_id, u.install_time, row_number() OVER (PARTITION BY e.n ORDER BY u.install_time DESC NULLS LAST, u.user_lifetime_id DESC) AS nth
  FROM {_HELD.format(join='LEFT JOIN').replace('inapp e', '(SELECT *, row_number() OVER () AS n FROM inapp) e')}
) WHERE nth = 1""",
    "interval_join": _OWNED,
    "bucketed_join": _OWNED,
    "date_range_join": """
SELECT event_date, application, client_id, user_lifetime_id, ad_impressions, ad_revenue_gross FROM ads_owned""",
    "active_lifetimes": f"""
SELECT {PARTS}, * EXCLUDE (cohort_date) FROM users u
WHERE install_time < TIMESTAMP '2024-01-20' AND (lifetime_end_date IS NULL OR lifetime_end_date >= DATE '2024-01-13')
  AND EXISTS (SELECT 1 FROM (
    SELECT app_name, client_id, activity_date_utc AS d FROM activity
    UNION ALL SELECT app_name, client_id, cast(event_time AS DATE) FROM inapp
    UNION ALL SELECT app_name, client_id, cast(event_time AS DATE) FROM subscription
    UNION ALL SELECT app_name, client_id, event_date FROM ad_daily) e
  WHERE e.app_name = u.application AND e.client_id = u.client_id AND d BETWEEN DATE '2024-01-13' AND DATE '2024-01-19')""",
    "cohort_users": f"SELECT {PARTS}, * EXCLUDE (cohort_date, install_time, lifetime_end_time) FROM users",
    "lifetime_activity_daily": "SELECT * FROM daily",
    "cohort_long": "SELECT * FROM cohort_long",
    "cohort_activity_utn": "SELECT * FROM utn",
    "payers": "SELECT * FROM payers",
    "cohort_wide": "SELECT * FROM cohort_wide",
    "monetization_curves": "SELECT * FROM curves",
    "revenue_by_source": "SELECT * FROM revenue",
    "price_usd": f"""
SELECT client_id, event_time, local_price,
  {_net('local_price', 'currency_rates_denominator', 'vat_income_multiplier')} AS price_usd,
  {_gross('local_price', 'currency_rates_denominator')} AS price_gross_usd FROM inapp""",
    "sessions": "SELECT * FROM sess",
    "activity_daily": "SELECT * FROM activity",
    "user_profile": "SELECT * FROM profile",
    "first_seen": "SELECT * FROM seen",
    "inapp_staged": "SELECT * FROM staged",
    "inapp_refunds": "SELECT * FROM refunds",
    "inapp_fact": f"SELECT *, {_nothing('media_source creative promo_campaign')} FROM inapp_facts",
    "subscription_stream": "SELECT * FROM sub_stream",
    "subscription_context": f"SELECT *, {_nothing('media_source creative promo_campaign')} FROM sub_context",
    "subscription_fact": f"SELECT *, {_nothing('media_source creative promo_campaign')} FROM sub_fact",
    "rates_scd2": "SELECT * FROM rates",
    "rate_lookup": f"""
SELECT transaction_id, version, p.currency, event_time, r.value AS rate
FROM purchases_raw p {_rate('p', 'cast(event_time AS DATE)')}""",
    "ad_user_daily": "SELECT * FROM ad_daily",
    "ua_costs": "SELECT * FROM costs",
    "dimension_lookup": f"""
SELECT coalesce(r_name, 'unknown') AS region, {_platform('platform')} AS platform, count(*) AS lifetimes
FROM users_scd2 LEFT JOIN nation ON n_name = country_code LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2""",
    "revenue_feed": """
SELECT *, 'attribution' AS feed FROM attribution_feed UNION ALL BY NAME SELECT *, 'store' AS feed FROM store_feed
UNION ALL BY NAME SELECT *, 'ad_impression' AS feed FROM imp_feed UNION ALL BY NAME SELECT *, 'ad_user' AS feed FROM user_feed""",
    "latest_snapshot": """
SELECT * EXCLUDE (payload) FROM snaps
QUALIFY row_number() OVER (PARTITION BY account_id, campaign_id ORDER BY snapshot_ts DESC) = 1""",
    "campaign_snapshots": """
SELECT * EXCLUDE (payload), cast(json_extract(payload, '$.goal.country_code_to_goal_value') AS VARCHAR) AS goal_country_values_raw,
  cast(json_extract(payload, '$.budget.country_code_to_daily_budget') AS VARCHAR) AS budget_country_values_raw FROM snaps""",
    "json_country_explode": f"""
{_exploded('$.goal.country_code_to_goal_value', 'goal', 'goal_value', 'goal_type,')} UNION ALL BY NAME
{_exploded('$.budget.country_code_to_daily_budget', 'budget', 'daily_budget')} UNION ALL BY NAME
SELECT {_SNAP}, unnest(json_extract_string(payload, '$.targeting.countries[*]')) AS country_code, 'target' AS kind FROM snaps""",
    "payment_stream": f"""
SELECT * EXCLUDE (received_at), coalesce(nullif(application, ''), 'unknown') AS app_name, {_store('store_name')} AS platform,
  {_revenue_type('product_id_type', 'type')} AS revenue_type
FROM payments QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY received_at DESC) = 1""",
    "first_24h": f"""
SELECT e.app_name, e.client_id, u.user_lifetime_id, count(*) AS events_24h, count(*) FILTER (event_name = 'click') AS clicks_24h,
  count(*) FILTER (event_name = 'view') AS views_24h, min(event_time) AS first_event_time, max(event_time) AS last_event_time
FROM session_events e JOIN users u ON u.application = e.app_name AND u.client_id = e.client_id
  AND event_time >= install_time AND event_time < install_time + INTERVAL 24 HOUR
  AND (lifetime_end_time IS NULL OR event_time < lifetime_end_time)
GROUP BY 1, 2, 3""",
    "revenue_compare": f"""
SELECT event_date, app_name, platform,
  {', '.join(f"{_money(f'''sum(total) FILTER (source_tag = '{t}')''')} AS {t}_revenue" for t in ['own_events', 'payments', 'store', 'attribution', 'ad_network'])},
  {', '.join(f"cast({_money(f'''sum(total) FILTER (source_tag = '{t}')''')} - {_money('''sum(total) FILTER (source_tag = 'own_events')''')} AS {MONEY}) AS {t}_delta" for t in ['payments', 'store', 'attribution', 'ad_network'])},
  {_money("sum(total) FILTER (source_tag IN ('own_events', 'payments', 'store', 'attribution', 'ad_network'))")} AS total_revenue_all_sources_usd
FROM (SELECT *, cast(ad_revenue_gross AS {MONEY}) + cast(inapp_revenue_gross AS {MONEY}) + cast(subs_revenue_gross AS {MONEY}) AS total FROM revenue)
GROUP BY 1, 2, 3""",
    "source_compare": f"""
SELECT event_date, app_name, ad_type, {_money('l')} AS left_revenue, {_money('r')} AS right_revenue,
  cast({_money('l')} - {_money('r')} AS {MONEY}) AS difference,
  CASE WHEN coalesce(r, 0) <> 0 THEN round(cast({_money('l')} AS DOUBLE) / cast(r AS DOUBLE), 6) END AS ratio
FROM (
  SELECT cast(event_date AS VARCHAR) AS event_date, coalesce(app_name, '') AS app_name, coalesce(ad_type, '') AS ad_type,
    sum(rev) FILTER (side = 'l') AS l, sum(rev) FILTER (side = 'r') AS r
  FROM (SELECT *, revenue_total AS rev, 'l' AS side FROM (SELECT cast(event_time AS DATE) AS event_date, app_name, ad_type, revenue AS revenue_total FROM ad_primary)
    UNION ALL SELECT *, revenue_total, 'r' FROM (SELECT cast(event_time AS DATE), app_name, ad_type, revenue AS revenue_total FROM ad_history))
  GROUP BY 1, 2, 3
)""",
    "feature_corr": """
SELECT feature, round(corr(x, later), 6) AS correlation FROM (
  SELECT unnest(['early_sessions_count', 'early_session_event_count_total', 'early_purchases', 'early_ad_impressions', 'early_total_revenue_net']) AS feature,
    unnest([cast(f1 AS DOUBLE), cast(f2 AS DOUBLE), cast(f3 AS DOUBLE), cast(f4 AS DOUBLE), cast(f5 AS DOUBLE)]) AS x, cast(later AS DOUBLE) AS later
  FROM (SELECT user_lifetime_id, coalesce(sum(sessions_count) FILTER (day_idx < 2), 0) AS f1,
      coalesce(sum(session_event_count_total) FILTER (day_idx < 2), 0) AS f2, coalesce(sum(purchases) FILTER (day_idx < 2), 0) AS f3,
      coalesce(sum(ad_impressions) FILTER (day_idx < 2), 0) AS f4, coalesce(sum(total_revenue_net) FILTER (day_idx < 2), 0) AS f5,
      coalesce(sum(total_revenue_net) FILTER (day_idx >= 2), 0) AS later FROM daily GROUP BY 1)
) GROUP BY 1""",
    "feature_pairs": """
SELECT feature_a, feature_b, count(user_lifetime_id) AS rows_count,
  round(CASE WHEN min(xa) < max(xa) AND min(xb) < max(xb) THEN covar_pop(xa, xb) / nullif(stddev_pop(xa) * stddev_pop(xb), 0) END, 6) AS pearson,
  round(CASE WHEN min(ra) < max(ra) AND min(rb) < max(rb) THEN covar_pop(ra, rb) / nullif(stddev_pop(ra) * stddev_pop(rb), 0) END, 6) AS spearman
FROM (SELECT a.name AS feature_a, b.name AS feature_b, a.user_lifetime_id, a.x AS xa, b.x AS xb, cast(a.r AS DOUBLE) AS ra, cast(b.r AS DOUBLE) AS rb
  FROM feature_ranks a JOIN feature_ranks b ON a.user_lifetime_id = b.user_lifetime_id AND a.place < b.place)
GROUP BY 1, 2""",
    "incremental_equals_full": _DAILY_SUMS,
    "late_data_equals_full": _DAILY_SUMS,
    "incremental_sessions": "SELECT * FROM sess",
    "incremental_activity": "SELECT * FROM activity",
    "incremental_curves": "SELECT * FROM curves",
    "odd_payloads": """
SELECT account_id, snapshot_ts, campaign_id, kind, country_code, cast(json_extract_string(payload, path || '."' || country_code || '"') AS DOUBLE) AS amount,
  cast(NULL AS BIGINT) AS rows_count, cast(NULL AS BIGINT) AS broken_count
FROM (SELECT *, unnest(json_keys(payload, path)) AS country_code
  FROM snaps, (VALUES ('goal', '$.goal.country_code_to_goal_value'), ('budget', '$.budget.country_code_to_daily_budget')) b(kind, path)
  WHERE length(payload) % 4 <> 3)
UNION ALL
SELECT account_id, NULL, campaign_id, 'payloads', NULL, NULL, count(*), count(*) FILTER (length(payload) % 4 = 3) FROM snaps GROUP BY 1, 3""",
    "sql_prices": f"""
SELECT payment_id, received_at, coalesce(nullif(application, ''), 'unknown') AS app_name, {_store('store_name')} AS platform,
  {_revenue_type('product_id_type', 'type')} AS revenue_type, {_gross('price', 'currencyRatesDenominator')} AS price_gross_usd,
  {_net('price', 'currencyRatesDenominator', '0.5')} AS price_usd FROM payments""",
    "sql_lifetimes": f"""
SELECT {_platform('platform')} AS platform, count(*) AS lifetimes, count(*) FILTER (lifetime_end_time IS NULL) AS open_lifetimes, min(install_time) AS first_install
FROM users_scd2 WHERE install_time < TIMESTAMP '2024-01-13' AND (lifetime_end_time IS NULL OR lifetime_end_time >= TIMESTAMP '2024-01-10') GROUP BY 1""",
    "active_users": """
SELECT * FROM (WITH seen AS (
  SELECT DISTINCT period, cast(date_trunc(period, event_date) AS DATE) AS period_start, application, platform, user_lifetime_id,
    cast(date_trunc(period, event_date) - CASE period WHEN 'day' THEN INTERVAL 1 DAY WHEN 'week' THEN INTERVAL 7 DAY ELSE INTERVAL 1 MONTH END AS DATE) AS earlier
  FROM daily, (VALUES ('day'), ('week'), ('month')) p(period) WHERE sessions_count > 0
)
SELECT a.period, a.period_start, a.application, a.platform, count(*) AS active_users, count(b.user_lifetime_id) AS returning_users
FROM seen a LEFT JOIN seen b ON b.period = a.period AND b.period_start = a.earlier AND b.user_lifetime_id = a.user_lifetime_id
  AND b.application IS NOT DISTINCT FROM a.application AND b.platform IS NOT DISTINCT FROM a.platform
GROUP BY 1, 2, 3, 4)""",
    "upsert_partitions": _NULLABLE_UTN,
    "upsert_keys": _NULLABLE_UTN,
    "published_partitions": _NULLABLE_UTN,
    "built_marts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, cast({day} AS DATE) AS day, count(*) AS rows_count, cast({total} AS {MONEY}) AS total FROM {table} GROUP BY 2"
        for name, table, day, total in (
            ("cohort_users", "users", "cohort_date", "0"),
            ("daily", "daily", "event_date", "sum(total_revenue_net)"),
            ("cohort_long", "cohort_long", "event_date", "sum(total_revenue_net)"),
            ("utn", "utn", "cohort_date", "sum(clients_sdk_utn)"),
            ("payers", "payers", "cohort_date", "sum(purchases_total)"),
            ("cohort_wide", "cohort_wide", "cohort_date", "sum(ad_revenue_gross_utn)"),
            ("curves", "curves", "cohort_date", "sum(total_revenue_net)"),
        )
    ),
    "trusted_times": """
SELECT cast(event_time AS DATE) AS event_date, count(*) AS rows_count, feed FROM session_events,
  (SELECT unnest(['session_events', 'transactions', 'session_bounds', 'ad_impressions', 'installs', 'reinstalls', 'purchases',
    'play_purchases', 'aggregator_subscriptions', 'store_notifications', 'play_subscriptions']) AS feed) GROUP BY ALL""",
    "run_windows": f"""
SELECT mode, cast(event_time AS DATE) AS event_date, count(*) AS rows_count FROM inapp JOIN (VALUES
  ('bounds', DATE '2024-01-05', DATE '2024-01-09'), ('start', DATE '2024-01-20', DATE '2024-01-31'),
  ('end', DATE '1970-01-01', DATE '2024-01-09'), ('lookback', DATE '2024-01-13', DATE '2024-01-19'),
  ('full', DATE '1970-01-01', DATE '2024-01-31')) w(mode, a, z) ON cast(event_time AS DATE) BETWEEN a AND z
WHERE {OWNABLE} GROUP BY ALL""",
    "unreadable_starts": f"""
SELECT source_table, count(*) AS rows_count, count(*) FILTER (at IS NULL) AS unreadable_count, min(installed_at) FILTER (at IS NULL) AS unreadable_example
FROM (SELECT 'installs' AS source_table, installed_at, {_PARSED.format('installed_at')} AS at FROM raw_installs
  UNION ALL SELECT 'reinstalls', installed_at, coalesce({_PARSED.format('reattributed_at')}, {_PARSED.format('installed_at')}) FROM raw_reinstalls)
GROUP BY 1""".replace(" AS at ", " AS begins ").replace("(at IS", "(begins IS"),
}

TABLE_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


FACT_TABLES = ("orders", "lineitem", "events", "conversations")


def _table_profile() -> str:
    parts = []
    for table, columns in TABLE_COLUMNS.items():
        names = columns.split()
        nulls = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in names)
        parts.append(
            f"SELECT '{'facts' if table in FACT_TABLES else 'dimensions'}' AS layer, '{table}' AS table_name, {len(names)} AS column_count, count(*) AS row_count, "
            f"{nulls} AS null_cells, count(DISTINCT {names[0]}) AS key_count FROM {table}"
        )
    return " UNION ALL ".join(parts)


def statements() -> dict[str, str]:
    """One complete statement per query: sample views, shared steps, final SELECT."""
    steps = [*view_ctes(), *CTES.items()]
    head = "WITH " + ",\n".join(f"{name} AS ({text.strip()})" for name, text in steps)
    out = {name: f"{head}\n{text.strip()}" for name, text in QUERIES.items()}
    profile = _table_profile()
    out["table_profile"] = profile
    out["column_profile"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS rows_count, count(*) - count({c}) AS null_count, true AS within_error FROM {t}"
        for t in ("customer", "orders", "lineitem", "events")
        for c in TABLE_COLUMNS[t].split()
    )
    out["layer_totals"] = (
        "SELECT layer, count(*) AS table_count, cast(sum(row_count) AS BIGINT) AS total_rows, "
        f"cast(sum(column_count) AS BIGINT) AS column_count FROM ({profile}) GROUP BY 1"
    )
    out["largest_tables"] = (
        f"SELECT table_name, row_count FROM ({profile}) WHERE table_name <> 'lineitem' "
        "ORDER BY row_count DESC, table_name LIMIT 5"
    )
    return out
