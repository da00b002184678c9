"""Names of the measures, fixed by the tables they describe."""

SESSION_COUNTS = ("sessions_count", "session_duration_seconds_total", "session_event_count_total")

PURCHASE_COUNTS = (
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
)

AD_COUNTS = (
    "ad_impressions",
    "ad_impressions_rewarded",
    "ad_impressions_interstitial",
    "ad_impressions_banner",
)

DAILY_MONEY = (
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
)

TOTALS = ("total_revenue_gross", "total_revenue_net")

# Column order of the long mart differs from the daily fact.
LONG_MONEY = (
    "inapp_revenue_gross",
    "subs_revenue_gross",
    "inapp_refunds_revenue_net",
    "subs_refunds_revenue_net",
    "inapp_revenue_net",
    "subs_revenue_net",
)
LONG_AD_MONEY = (
    "ad_revenue_gross",
    "ad_revenue_rewarded_gross",
    "ad_revenue_interstitial_gross",
    "ad_revenue_banner_gross",
)

# Column order inside one bucket of the wide mart.
WIDE_COUNTS = ("ad_impressions", *PURCHASE_COUNTS, *AD_COUNTS[1:])
WIDE_MONEY = (
    "inapp_revenue_gross",
    "subs_revenue_gross",
    "ad_revenue_gross",
    "total_revenue_net",
    "total_revenue_gross",
    "inapp_refunds_revenue_net",
    "subs_refunds_revenue_net",
    "inapp_revenue_net",
    "subs_revenue_net",
    "ad_revenue_rewarded_gross",
    "ad_revenue_interstitial_gross",
    "ad_revenue_banner_gross",
)
PAYER_COUNTS = ("paying_users", "inapp_payers", "subs_payers", "new_payers")
