"""Cross-source daily revenue and comparisons between sources."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from installarc.functions import dims, events
from installarc.functions.money import money, money_or_zero, price_gross_usd, signed, sum_long
from installarc.functions.times import first_day_reaching, local_date, local_date_of_day, local_midnight
from installarc.operators.lookup import rate_lookup
from installarc.operators.shape import padded_union
from installarc.settings import MartConfig
from installarc.sources.tables import as_is

KEYS = ("event_date", "app_name", "platform", "source_tag", "source_model")
AMOUNTS = ("ad_revenue_gross", "inapp_revenue_gross", "subs_revenue_gross")
COUNTS = ("purchase_events_count", "refund_events_count", "impressions_count", "rows_count")


@dataclass(frozen=True)
class SourceLabels:
    """``(source_tag, source_model)`` written on the rows of each revenue source."""

    subscription: tuple[str, str] = ("own_events", "subscription_fact")
    inapp: tuple[str, str] = ("own_events", "inapp_fact")
    payments: tuple[str, str] = ("payments", "payment_stream")
    ad_user: tuple[str, str] = ("payments", "revenue_ad_user")
    store: tuple[str, str] = ("store", "revenue_store")
    attribution: tuple[str, str] = ("attribution", "revenue_attribution")
    ad_impression: tuple[str, str] = ("ad_network", "revenue_ad_impression")


def _one(when: Column | None = None) -> Column:
    one = F.lit(1).cast("long")
    return one if when is None else F.when(when, one)


def _rows(df: DataFrame, label: tuple[str, str], day: Column, app: Column, platform: Column, measures: Mapping[str, Column]) -> DataFrame:
    """Source rows in the shared shape; absent measures are padded by the union."""
    return df.select(
        day.alias("event_date"),
        app.alias("app_name"),
        platform.alias("platform"),
        F.lit(label[0]).alias("source_tag"),
        F.lit(label[1]).alias("source_model"),
        *[col.alias(name) for name, col in measures.items()],
    )


def _own_events(df: DataFrame, label: tuple[str, str], amount: str, config: MartConfig) -> DataFrame:
    refund = F.col("event_name") == "refund"
    gross = price_gross_usd(F.col("local_price"), F.col("currency_rates_denominator"))
    recent = df.filter(F.col("event_time") >= local_midnight(config.revenue_start, config.revenue_zone))
    return _rows(
        recent,
        label,
        local_date(F.col("event_time"), config.revenue_zone),
        dims.app_of(F.col("app_name")),
        dims.platform_of(F.col("platform")),
        {
            amount: money(signed(gross, F.coalesce(refund, F.lit(False)))),
            "purchase_events_count": _one(F.col("event_name") == "purchase"),
            "refund_events_count": _one(refund),
            "rows_count": _one(),
        },
    )


def _payments(df: DataFrame, label: tuple[str, str], config: MartConfig) -> DataFrame:
    cancelled = F.col("type") == "CANCELLATION"
    gross = money(price_gross_usd(F.col("price"), F.col("currencyRatesDenominator")))
    amount = signed(gross, F.coalesce(cancelled, F.lit(False)))
    kind = events.revenue_type_of(F.col("product_id_type"), F.col("type"))
    recent = df.filter(F.col("purchased_at_ms") >= local_midnight(config.revenue_start, config.revenue_zone))
    return _rows(
        recent,
        label,
        local_date(F.col("purchased_at_ms"), config.revenue_zone),
        dims.app_of(F.col("application")),
        dims.store_platform_of(F.col("store_name")),
        {
            "subs_revenue_gross": F.when(kind == "subscription", amount),
            "inapp_revenue_gross": F.when(kind == "inapp", amount),
            "purchase_events_count": _one(~cancelled),
            "refund_events_count": _one(cancelled),
            "rows_count": _one(),
        },
    )


def _ads(df: DataFrame, label: tuple[str, str], config: MartConfig, *apps: str) -> DataFrame:
    day = local_date_of_day(F.col("event_date"), config.revenue_zone)
    recent = df.filter(F.col("event_date") >= first_day_reaching(config.revenue_start, config.revenue_zone))
    return _rows(
        recent,
        label,
        day,
        dims.app_of(*[F.col(a) for a in apps]),
        dims.platform_of(F.col("platform")),
        {
            "ad_revenue_gross": money(F.col("revenue_total")),
            "impressions_count": F.col("impressions_count").cast("long"),
            "rows_count": _one(),
        },
    )


def _daily_export(
    df: DataFrame, label: tuple[str, str], config: MartConfig, measures: Mapping[str, Column]
) -> DataFrame:
    """A feed whose dates are already reporting dates."""
    day = F.to_date("event_date")
    recent = df.filter(day >= F.lit(config.revenue_start))
    return _rows(
        recent, label, day, dims.app_of(F.col("app_name")), dims.platform_of(F.col("platform")), measures
    )


def revenue_by_source(
    subscription: DataFrame,
    inapp: DataFrame,
    payments: DataFrame,
    ad_user: DataFrame,
    store: DataFrame,
    attribution: DataFrame,
    ad_impression: DataFrame,
    config: MartConfig,
    labels: SourceLabels = SourceLabels(),
) -> DataFrame:
    """Daily revenue of every source side by side, in the reporting time zone.

    All seven sources are brought to one row shape and summed in a single grouped
    aggregate; map-side sums shrink each source before the only shuffle.
    """
    stacked = padded_union(
        [
            _own_events(subscription, labels.subscription, "subs_revenue_gross", config),
            _own_events(inapp, labels.inapp, "inapp_revenue_gross", config),
            _payments(payments, labels.payments, config),
            _ads(ad_user, labels.ad_user, config, "app_name"),
            _daily_export(
                store,
                labels.store,
                config,
                {
                    "subs_revenue_gross": money(F.col("revenue_gross_usd_subscription")),
                    "inapp_revenue_gross": money(F.col("revenue_gross_usd_inapp")),
                    "rows_count": F.col("rows_count").cast("long"),
                },
            ),
            _daily_export(
                attribution,
                labels.attribution,
                config,
                {
                    "subs_revenue_gross": money(F.col("revenue_subscription")),
                    "inapp_revenue_gross": money(F.col("revenue_inapp")),
                    "ad_revenue_gross": money(F.col("revenue_ad")),
                    "impressions_count": F.col("count_impression").cast("long"),
                    "rows_count": F.col("count_total").cast("long"),
                },
            ),
            _ads(ad_impression, labels.ad_impression, config, "app_name", "project"),
        ]
    )
    return (
        stacked.filter(config.has_revenue_app(F.col("app_name")))
        .groupBy(*KEYS)
        .agg(
            *[money_or_zero(F.sum(m)).cast("double").alias(m) for m in AMOUNTS],
            *[sum_long(F.col(m)).alias(m) for m in COUNTS],
        )
    )


def compare_sources(revenue: DataFrame, tags: Sequence[str], base: str) -> DataFrame:
    """One row per day, app and platform: each source's total, its gap to ``base``, and the sum of all sources."""
    ad, inapp, subs = [money(F.col(m)) for m in AMOUNTS]
    wide = (
        revenue.withColumn("total", money(ad + inapp + subs))
        .groupBy("event_date", "app_name", "platform")
        .pivot("source_tag", list(tags))
        .agg(F.sum("total"))
    )
    totals = [money_or_zero(F.col(t)).alias(f"{t}_revenue") for t in tags]
    gaps = [
        money(money_or_zero(F.col(t)) - money_or_zero(F.col(base))).alias(f"{t}_delta")
        for t in tags
        if t != base
    ]
    everything = reduce(lambda a, b: a + b, [money_or_zero(F.col(t)) for t in tags])
    return wide.select(
        "event_date", "app_name", "platform", *totals, *gaps, money(everything).alias("total_revenue_all_sources_usd")
    )


def compare_ad_sources(left: DataFrame, right: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """Two ad revenue sources side by side per key, kept when only one side has it."""

    def side(df: DataFrame, name: str) -> DataFrame:
        cleaned = df.select(*[dims.empty_if_null(F.col(k).cast("string")).alias(k) for k in keys], amount)
        return cleaned.groupBy(*keys).agg(F.sum(money(F.col(amount))).alias(name))

    joined = side(left, "left_revenue").join(side(right, "right_revenue"), list(keys), "full_outer")
    l, r = money_or_zero(F.col("left_revenue")), money_or_zero(F.col("right_revenue"))
    return joined.select(
        *keys,
        l.alias("left_revenue"),
        r.alias("right_revenue"),
        money(l - r).alias("difference"),
        F.when(r != 0, F.round(l.cast("double") / r.cast("double"), 6)).alias("ratio"),
    )


# --- daily revenue feeds ----------------------------------------------------------


def daily_feed(
    rows: DataFrame, day: Column, keys: Mapping[str, Column], measures: Mapping[str, Column]
) -> DataFrame:
    """Fold raw revenue rows to a daily feed: named keys, summed decimals and counts."""
    shaped = rows.select(
        day.alias("event_date"),
        *[c.alias(n) for n, c in keys.items()],
        *[c.alias(n) for n, c in measures.items()],
    )
    decimals = {f.name for f in shaped.schema.fields if f.dataType.typeName() == "decimal"}
    sums = [
        (money_or_zero(F.sum(m)) if m in decimals else sum_long(F.col(m))).alias(m) for m in measures
    ]
    return shaped.groupBy("event_date", *keys).agg(*sums)


def attribution_feed(rows: DataFrame, source_table: str = "attribution") -> DataFrame:
    """Attribution-tool revenue split into subscription, in-app and ad buckets."""
    amount, kind = money(F.col("revenue_usd")), F.col("revenue_kind")
    return daily_feed(
        rows,
        F.to_date("event_time"),
        {"source_table": F.lit(source_table), "app_name": F.col("app_name"), "platform": F.col("platform")},
        {
            "revenue_total": amount,
            "revenue_subscription": F.when(kind == "subscription", amount),
            "revenue_inapp": F.when(kind == "inapp", amount),
            "revenue_ad": F.when(kind == "ad", amount),
            "count_impression": _one(kind == "ad"),
            "count_total": _one(),
        },
    )


def store_feed(rows: DataFrame, source_table: str = "store") -> DataFrame:
    """Store-report revenue: gross and net, subscription and in-app."""
    gross, net = money(F.col("gross_usd")), money(F.col("net_usd"))
    is_sub = F.col("is_subscription") == 1
    return daily_feed(
        rows,
        F.to_date("event_time"),
        {"source_table": F.lit(source_table), "app_name": F.col("app_name"), "platform": F.col("platform")},
        {
            "revenue_gross_usd": gross,
            "revenue_net_usd": net,
            "revenue_gross_usd_subscription": F.when(is_sub, gross),
            "revenue_gross_usd_inapp": F.when(~is_sub, gross),
            "rows_count": _one(),
        },
    )


def ad_feed(rows: DataFrame, *extra_keys: str, source_table: str = "ad") -> DataFrame:
    """Ad revenue by ad type; used for the impression feed and the user feed."""
    keys = {k: F.col(k) for k in ("app_name", *extra_keys, "platform", "ad_type")}
    keys = {"source_table": F.lit(source_table), **keys}
    return daily_feed(
        rows,
        F.to_date("event_time"),
        keys,
        {"revenue_total": money(F.col("revenue")), "impressions_count": _one()},
    )


# --- ad revenue per user and acquisition spend ------------------------------------

AD_FORMATS = ("banner", "interstitial", "rewarded", "native", "mrec")


def _ad_days(rows: DataFrame) -> DataFrame:
    """Impressions and revenue of one source folded to user and UTC day."""
    kind = F.lower(F.coalesce("ad_format", F.lit("")))
    kind = F.when(kind.isin(*AD_FORMATS), kind).otherwise("other")
    amount = money(F.col("revenue"))
    formats = (*AD_FORMATS, "other")
    shaped = rows.select(
        F.to_date("event_time").alias("event_date"),
        "app_name",
        "client_id",
        kind.alias("_kind"),
        amount.alias("_amount"),
    )
    return shaped.groupBy("event_date", "app_name", "client_id").agg(
        F.count(F.lit(1)).alias("impressions_total"),
        F.count(F.lit(1)).alias("impressions_count"),
        money_or_zero(F.sum("_amount")).alias("revenue_total"),
        money_or_zero(F.sum("_amount")).alias("ad_revenue_total"),
        *[F.count_if(F.col("_kind") == f).alias(f"impressions_{f}") for f in formats],
        *[money_or_zero(F.sum(F.when(F.col("_kind") == f, F.col("_amount")))).alias(f"revenue_{f}") for f in formats],
    )


def ad_user_daily(
    primary: DataFrame,
    history: DataFrame | None,
    run_ts: datetime,
    stage: Callable[[DataFrame], DataFrame] = as_is,
) -> DataFrame:
    """Impressions and ad revenue per user and UTC day, split by ad format.

    ``history`` fills the dates the primary source does not cover. Both sources are folded before they
    meet; the folded primary is staged, and its dates, one row per calendar day, are read from there.
    """
    first = stage(_ad_days(primary).withColumn("source_table", F.lit("primary")))
    rows = first
    if history is not None:
        covered = first.select("event_date").distinct()
        older = _ad_days(history).join(covered, "event_date", "left_anti")
        rows = padded_union([first, older.withColumn("source_table", F.lit("history"))])
    return rows.withColumn("updated_at_utc", F.lit(run_ts).cast("timestamp"))


SPEND_DIMS = (
    "day",
    "platform",
    "application",
    "country",
    "media_source",
    "promo_campaign",
    "promo_campaign_id",
    "adset",
    "adset_id",
    "ad",
    "ad_id",
    "site_id",
    "keywords",
)


def network_spend(raw: DataFrame, media_source: str, columns: Mapping[str, str]) -> DataFrame:
    """One ad network's report in the shared spend shape.

    ``columns`` maps shared names to the network's own; dimensions a network does not
    report stay NULL.
    """

    def pick(name: str, kind: str) -> Column:
        col = F.col(columns[name]) if name in columns else F.lit(None)
        return col.cast(kind).alias(name)

    texts = [pick(d, "string") for d in SPEND_DIMS[1:] if d != "media_source"]
    return raw.select(
        F.to_date(columns["day"]).alias("day"),
        F.lit(media_source).alias("media_source"),
        *texts,
        pick("currency", "string"),
        pick("cost", "decimal(18,8)"),
        pick("clicks", "long"),
        pick("impressions", "long"),
    )


def ua_costs(
    networks: Sequence[DataFrame], rates: DataFrame, stage: Callable[[DataFrame], DataFrame] = as_is
) -> DataFrame:
    """Spend of all networks by day and campaign, in one currency.

    Reports are summed before conversion, so the rate join sees one row per group.
    A missing currency means the report is already converted.
    """
    grouped = (
        padded_union(list(networks))
        .groupBy(*SPEND_DIMS, "currency")
        .agg(*[F.sum(m).alias(m) for m in ("cost", "clicks", "impressions")])
    )
    rated = rate_lookup(stage(grouped), rates, "currency", F.col("day"), "rate", stage=stage)
    usd = money(price_gross_usd(F.col("cost"), F.col("rate")))
    return (
        rated.withColumn("cost", usd)
        .groupBy(*SPEND_DIMS)
        .agg(
            money_or_zero(F.sum("cost")).alias("cost"),
            sum_long(F.col("clicks")).alias("clicks"),
            sum_long(F.col("impressions")).alias("impressions"),
        )
    )
