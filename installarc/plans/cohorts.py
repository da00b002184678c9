"""Cohort marts: users, daily lifetime facts, long and wide cohorts, payers, curves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from installarc.functions import dims, events, metrics
from installarc.functions.money import (
    money,
    money_or_zero,
    signed,
    sum_long,
    sum_money,
    total_gross,
    total_net,
    zero,
)
from installarc.operators.shape import UNLIMITED, bucket_labels, dense_days, padded_union
from installarc.operators.timeline import interval_join
from installarc.settings import MartConfig, RunWindow, from_day, stamped
from installarc.sources.tables import as_is

CLIENT = ["application", "client_id"]
DEVICE_DIMS = ("install_device_name", "install_device_type")


def _profile() -> list[Column]:
    """Cleaned acquisition dimensions of a lifetime."""
    return [
        dims.platform_of(F.col("platform")).alias("platform"),
        dims.app_of(F.col("app_name")).alias("application"),
        dims.empty_if_null(F.col("country_code")).alias("country"),
        *[dims.empty_if_null(F.col(c)).alias(c) for c in (*dims.TEXT_DIMS, *DEVICE_DIMS)],
    ]


def cohort_users(lifetimes: DataFrame, config: MartConfig) -> DataFrame:
    """One row per attributable install lifetime."""
    day = F.to_date("install_date")
    return lifetimes.filter(
        (day >= F.lit(config.cohort_start)) & dims.attributable(F.col("app_name"), F.col("client_id"))
    ).select(
        *dims.cohort_parts(day),
        *_profile(),
        "client_id",
        "user_lifetime_id",
        "user_lifetime_number",
        F.to_date("install_time").alias("lifetime_start_date"),
        F.to_date("lifetime_end_time").alias("lifetime_end_date"),
    )


# --- daily lifetime facts ---------------------------------------------------------


def _in_window(df: DataFrame, time: str, window: RunWindow, config: MartConfig) -> DataFrame:
    """Events of the run window that can belong to a lifetime."""
    keep = window.has_time(F.col(time)) & from_day(F.col(time), config.cohort_start)
    return _of_clients(df.filter(keep))


def _of_clients(df: DataFrame) -> DataFrame:
    kept = df.filter(dims.attributable(F.col("app_name"), F.col("client_id")))
    return kept.withColumnRenamed("app_name", "application")


def activity_rows(activity: DataFrame, window: RunWindow, config: MartConfig) -> DataFrame:
    day = F.col("activity_date_utc")
    kept = activity.filter(window.has_day(day) & (day >= F.lit(config.cohort_start)))
    return _of_clients(kept).select(
        *CLIENT,
        day.alias("event_date"),
        F.col("last_session_end_utc").alias("event_time"),
        *[F.col(c).cast("long") for c in metrics.SESSION_COUNTS],
        "app_version_last",
        F.lit(1).alias("app_version_priority"),
    )


def _ones(predicates: dict[str, Column]) -> list[Column]:
    return [F.when(p, F.lit(1).cast("long")).alias(name) for name, p in predicates.items()]


def inapp_rows(inapp: DataFrame, window: RunWindow, config: MartConfig) -> DataFrame:
    bought, returned = events.is_purchase(F.col("event_name")), events.is_refund_event(F.col("event_name"))
    net, gross = money_or_zero(F.col("price")), money_or_zero(F.col("price_gross"))
    counts = {
        "purchases": bought,
        "refunds": returned,
        "inapp_purchases": bought,
        "inapp_refunds_num": returned,
    }
    return _in_window(inapp, "event_time", window, config).select(
        *CLIENT,
        F.to_date("event_time").alias("event_date"),
        "event_time",
        *_ones(counts),
        F.when(bought, F.abs(gross)).alias("inapp_revenue_gross"),
        F.when(returned, F.abs(net)).alias("inapp_refunds_revenue_net"),
        F.when(bought | returned, signed(net, returned)).alias("inapp_revenue_net"),
    )


def subscription_rows(subscription: DataFrame, window: RunWindow, config: MartConfig) -> DataFrame:
    name = F.col("event_name")
    paid, returned = events.is_paid_period(name, F.col("period_type")), events.is_refund_event(name)
    net, gross = money_or_zero(F.col("price")), money_or_zero(F.col("price_gross"))
    return _in_window(subscription, "event_time", window, config).select(
        *CLIENT,
        F.to_date("event_time").alias("event_date"),
        "event_time",
        *_ones(events.subscription_counters()),
        F.when(paid, F.abs(gross)).alias("subs_revenue_gross"),
        F.when(returned, F.abs(net)).alias("subs_refunds_revenue_net"),
        F.when(paid | returned, signed(net, returned)).alias("subs_revenue_net"),
    )


def ad_rows(ad_daily: DataFrame, window: RunWindow, config: MartConfig) -> DataFrame:
    day = F.col("event_date")
    kept = ad_daily.filter(window.has_day(day) & (day >= F.lit(config.cohort_start)))
    counts = ("impressions_count", "impressions_rewarded", "impressions_interstitial", "impressions_banner")
    amounts = ("ad_revenue_total", "revenue_rewarded", "revenue_interstitial", "revenue_banner")
    outputs = (
        "ad_revenue_gross",
        "ad_revenue_rewarded_gross",
        "ad_revenue_interstitial_gross",
        "ad_revenue_banner_gross",
    )
    return _of_clients(kept).select(
        *CLIENT,
        "event_date",
        *[F.col(c).cast("long").alias(n) for c, n in zip(counts, metrics.AD_COUNTS)],
        *[money(F.col(c)).alias(n) for c, n in zip(amounts, outputs)],
    )


def window_clients(frames: list[DataFrame]) -> DataFrame:
    """Distinct (application, client_id) with any event in the run window."""
    return padded_union([f.select(*CLIENT) for f in frames]).distinct()


def window_lifetimes(
    lifetimes: DataFrame, clients: DataFrame | None, window: RunWindow, config: MartConfig
) -> DataFrame:
    """Lifetimes that can own an event of the run window.

    ``clients`` narrows them to clients seen in the window. That pays for itself in a
    partial run only; a full run sees nearly every client, so it passes None.
    """
    start, end = F.col("install_time"), F.col("lifetime_end_time")
    day = F.to_date(start)
    keep = from_day(start, config.cohort_start) & window.overlaps(start, end)
    if config.cohort_end is not None:
        keep = keep & (day <= F.lit(config.cohort_end))
    kept = lifetimes.filter(keep & dims.attributable(F.col("app_name"), F.col("client_id"))).select(
        *dims.cohort_parts(day),
        *_profile(),
        "client_id",
        "user_lifetime_id",
        "user_lifetime_number",
        "install_time",
        "lifetime_end_time",
        day.alias("lifetime_start_date"),
        F.to_date(end).alias("lifetime_end_date"),
    )
    return kept if clients is None else kept.join(clients, CLIENT, "left_semi")


def match_by_time(rows: DataFrame, lifetimes: DataFrame) -> DataFrame:
    """Timestamped rows to the lifetime running at that instant."""
    return interval_join(
        rows, lifetimes, CLIENT, "event_time", "install_time", "lifetime_end_time", ["install_time"]
    )


def match_by_day(rows: DataFrame, lifetimes: DataFrame, payload: list[str], order: str) -> DataFrame:
    """Dated rows to the lifetime holding that date in ``[start date, end date)``.

    Of several lifetimes started on one date only the last (by ``order``) can hold it.
    A client has few dated rows per month, so chunks are months.
    """
    return interval_join(
        rows,
        lifetimes,
        CLIENT,
        "event_date",
        "lifetime_start_date",
        "lifetime_end_date",
        payload,
        tie_break=[order],
        chunk="month",
    )


def lifetime_activity_daily(
    activity: DataFrame,
    inapp: DataFrame,
    subscription: DataFrame,
    ad_daily: DataFrame,
    lifetimes: DataFrame,
    window: RunWindow,
    config: MartConfig,
    stage: Callable[[DataFrame], DataFrame] = as_is,
) -> DataFrame:
    """Sessions, purchases, subscriptions and ad revenue per lifetime and UTC day.

    Matching reads its rows and its lifetimes more than once. The stacked rows are staged for that, and in a partial
    run, where the lifetimes come from a semi join with these rows, so are the lifetimes.
    """
    timed = [
        activity_rows(activity, window, config),
        inapp_rows(inapp, window, config),
        subscription_rows(subscription, window, config),
    ]
    dated = ad_rows(ad_daily, window, config)
    stacked = stage(padded_union(timed))
    if window.first_day is None:
        users = window_lifetimes(lifetimes, None, window, config)
    else:
        users = stage(window_lifetimes(lifetimes, window_clients([stacked, dated]), window, config))

    owned = padded_union(
        [match_by_time(stacked, users), match_by_day(dated, users, ["install_time"], "install_time")]
    )
    counts = (*metrics.SESSION_COUNTS, *metrics.PURCHASE_COUNTS, *metrics.AD_COUNTS)
    daily = owned.groupBy("event_date", *CLIENT, "install_time").agg(
        F.max_by("app_version_last", "app_version_priority").alias("app_version_last"),
        *[sum_long(F.col(m)).alias(m) for m in counts],
        *[sum_money(F.col(m)).alias(m) for m in metrics.DAILY_MONEY],
    )
    full = daily.join(users, [*CLIENT, "install_time"]).filter(F.col("event_date") >= F.col("cohort_date"))
    return stamped(
        full.select(
            "cohort_date",
            "cohort_month",
            "cohort_week",
            "event_date",
            F.date_diff("event_date", "cohort_date").alias("day_idx"),
            *dims.COHORT_DIMS,
            *DEVICE_DIMS,
            "client_id",
            "user_lifetime_id",
            "user_lifetime_number",
            "install_time",
            "lifetime_start_date",
            "lifetime_end_date",
            *metrics.SESSION_COUNTS,
            "app_version_last",
            *metrics.PURCHASE_COUNTS,
            *metrics.AD_COUNTS,
            *metrics.DAILY_MONEY,
            total_gross().alias("total_revenue_gross"),
            total_net().alias("total_revenue_net"),
        ),
        config,
    )


# --- cohort aggregates ------------------------------------------------------------


def cohort_long(users: DataFrame, costs: DataFrame, daily: DataFrame, config: MartConfig) -> DataFrame:
    """Cohort by event day: installs and spend on day 0, activity and revenue on every day.

    The three inputs are stacked and summed once, so spend without installs and
    installs without spend both keep their row, and one shuffle serves all of them.
    """
    installs = users.filter(config.in_cohort_range(F.col("cohort_date"))).select(
        *dims.COHORT_KEY, F.col("cohort_date").alias("event_date"), F.lit(1).cast("long").alias("installs")
    )
    day = F.to_date("day")
    spend = costs.filter(config.in_cohort_range(day)).select(
        day.alias("cohort_date"),
        day.alias("event_date"),
        dims.platform_of(F.col("platform")).alias("platform"),
        dims.app_of(F.col("application")).alias("application"),
        dims.empty_if_null(F.col("country")).alias("country"),
        *[dims.empty_if_null(F.col(c)).alias(c) for c in dims.TEXT_DIMS],
        F.col("impressions").cast("long").alias("impressions"),
        F.col("clicks").cast("long").alias("clicks"),
        money(F.col("cost")).alias("cost"),
    )
    amounts = (*metrics.LONG_MONEY, *metrics.LONG_AD_MONEY)
    counts = (*metrics.PURCHASE_COUNTS, *metrics.AD_COUNTS)
    activity = daily.filter(
        config.in_cohort_range(F.col("cohort_date")) & (F.col("event_date") >= F.lit(config.cohort_start))
    ).select(
        *dims.COHORT_KEY,
        "event_date",
        F.when(F.col("sessions_count") > 0, F.lit(1).cast("long")).alias("clients_sdk"),
        *counts,
        *amounts,
    )
    long_counts = ("installs", "impressions", "clicks", "clients_sdk", *counts)
    summed = (
        padded_union([installs, spend, activity])
        .groupBy(*dims.COHORT_KEY, "event_date")
        .agg(
            *[sum_long(F.col(m)).alias(m) for m in long_counts],
            *[sum_money(F.col(m)).alias(m) for m in ("cost", *amounts)],
        )
        .withColumn("day_idx", F.date_diff("event_date", "cohort_date"))
        .filter(F.col("day_idx") >= 0)
    )
    return stamped(
        summed.select(
            *dims.cohort_parts(F.col("cohort_date")),
            "event_date",
            "day_idx",
            *dims.COHORT_DIMS,
            "installs",
            "impressions",
            "clicks",
            "cost",
            "clients_sdk",
            *metrics.PURCHASE_COUNTS,
            *metrics.LONG_MONEY,
            *metrics.AD_COUNTS,
            *metrics.LONG_AD_MONEY,
            total_gross().alias("total_revenue_gross"),
            total_net().alias("total_revenue_net"),
        ),
        config,
    )


def cohort_activity_utn(daily: DataFrame, config: MartConfig) -> DataFrame:
    """Distinct lifetimes with a session, per cohort, over all days."""
    active = F.when(F.col("sessions_count") > 0, F.col("user_lifetime_id"))
    counted = daily.groupBy(*dims.COHORT_KEY).agg(F.count_distinct(active).alias("clients_sdk_utn"))
    return stamped(
        counted.select(*dims.cohort_parts(F.col("cohort_date")), *dims.COHORT_DIMS, "clients_sdk_utn"),
        config,
    )


def _purchases(df: DataFrame, kind: str, config: MartConfig) -> DataFrame:
    kept = df.filter(
        events.is_purchase(F.col("event_name")) & from_day(F.col("event_time"), config.cohort_start)
    )
    return _of_clients(kept).select(
        *CLIENT,
        F.to_date("event_time").alias("event_date"),
        F.lit(kind).alias("purchase_type"),
        "currency",
        "event_time",
        money(F.col("local_price")).alias("local_amount"),
        money(F.col("price")).alias("amount_usd"),
    )


def payers(users: DataFrame, inapp: DataFrame, subscription: DataFrame, config: MartConfig) -> DataFrame:
    """Purchase summary of every lifetime that bought something.

    Purchases are matched by date, so they are first folded to one row per client,
    day, type and currency: a client with any number of purchases stays small.
    """
    bought = padded_union(
        [_purchases(inapp, "inapp", config), _purchases(subscription, "subscription", config)]
    )
    per_day = bought.groupBy(*CLIENT, "event_date", "purchase_type", "currency").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("event_time").alias("first_time"),
        F.sum("local_amount").alias("local_amount"),
        F.sum("amount_usd").alias("amount_usd"),
    )
    base = users.filter(config.in_cohort_range(F.col("cohort_date")))
    owned = match_by_day(per_day, base, ["user_lifetime_id"], "user_lifetime_number")

    kind = F.col("purchase_type")
    aggs = [F.sum("n").alias("purchases_total"), F.min("first_time").alias("first_purchase_timestamp")]
    for name in ("inapp", "subscription"):
        of_kind = kind == name
        currency = F.when(of_kind, F.col("currency"))
        aggs += [
            sum_long(F.when(of_kind, F.col("n"))).alias(f"{name}_n"),
            F.min(currency).alias(f"{name}_lo"),
            F.max(currency).alias(f"{name}_hi"),
            sum_money(F.col("local_amount"), of_kind).alias(f"{name}_local"),
            sum_money(F.col("amount_usd"), of_kind).alias(f"{name}_usd"),
            F.min(F.when(of_kind, F.col("event_date"))).alias(f"{name}_first"),
        ]
    summed = owned.groupBy(*CLIENT, "user_lifetime_id").agg(*aggs)

    def one_currency(name: str) -> Column:
        """Exactly one distinct non-NULL currency: lowest and highest agree."""
        return F.coalesce(F.col(f"{name}_lo") == F.col(f"{name}_hi"), F.lit(False))

    def label(name: str) -> Column:
        return (
            F.when(F.col(f"{name}_n") == 0, F.lit(None).cast("string"))
            .when(one_currency(name), F.col(f"{name}_lo"))
            .otherwise("MULTI")
        )

    def local_total(name: str) -> Column:
        return F.when(one_currency(name), F.col(f"{name}_local"))

    return stamped(
        base.join(summed, [*CLIENT, "user_lifetime_id"]).select(
            "cohort_date",
            "cohort_month",
            "cohort_week",
            *dims.COHORT_DIMS,
            "client_id",
            "user_lifetime_id",
            (F.col("inapp_n") > 0).cast("int").alias("is_inapp_payer"),
            (F.col("subscription_n") > 0).cast("int").alias("is_subscription_payer"),
            "purchases_total",
            F.col("subscription_n").alias("subscription_purchases"),
            F.col("inapp_n").alias("inapp_purchases"),
            label("inapp").alias("inapp_currency"),
            label("subscription").alias("subscription_currency"),
            local_total("inapp").alias("inapp_amount_local_total"),
            local_total("subscription").alias("subscription_amount_local_total"),
            F.col("inapp_usd").alias("inapp_amount_usd_total"),
            F.col("subscription_usd").alias("subscription_amount_usd_total"),
            "first_purchase_timestamp",
            F.to_date("first_purchase_timestamp").alias("first_purchase_date"),
            F.col("inapp_first").alias("first_inapp_purchase_date"),
            F.col("subscription_first").alias("first_subscription_purchase_date"),
        ),
        config,
    )


# --- wide buckets and curves ------------------------------------------------------

_DAY0 = ("installs", "impressions", "clicks")
_FLAG = "_in_long"


def _bucket_inputs(long: DataFrame, payer_rows: DataFrame, utn: DataFrame, config: MartConfig) -> DataFrame:
    """The three marts as rows of (cohort, day, measures), at most one per mart and day."""
    keep = config.in_cohort_range(F.col("cohort_date")) & config.has_app(F.col("application"))
    cohort_days = long.filter(keep).select(
        *dims.COHORT_KEY,
        F.col("day_idx").alias("day"),
        *_DAY0,
        "cost",
        F.col("clients_sdk").alias("active_users"),
        *metrics.WIDE_COUNTS,
        *metrics.WIDE_MONEY,
        F.lit(1).cast("long").alias(_FLAG),
    )

    def first_day(column: str, *measures: str) -> Column:
        return F.struct(
            F.date_diff(column, "cohort_date").alias("day"),
            *[F.lit(int(m in measures)).cast("long").alias(m) for m in metrics.PAYER_COUNTS],
        )

    firsts = F.array(
        first_day("first_purchase_date", "paying_users", "new_payers"),
        first_day("first_inapp_purchase_date", "inapp_payers"),
        first_day("first_subscription_purchase_date", "subs_payers"),
    )
    first_days = (
        payer_rows.filter(keep & (F.col("first_purchase_date") >= F.col("cohort_date")))
        .select(*dims.COHORT_KEY, F.inline(firsts))
        .filter(F.col("day") >= 0)
        .groupBy(*dims.COHORT_KEY, "day")
        .agg(*[F.sum(m).alias(m) for m in metrics.PAYER_COUNTS])
    )
    distinct = utn.filter(keep).select(
        *dims.COHORT_KEY, F.lit(None).cast("int").alias("day"), F.col("clients_sdk_utn").alias("active_users_all")
    )
    return padded_union([cohort_days, first_days, distinct])


def cohort_wide(long: DataFrame, payer_rows: DataFrame, utn: DataFrame, config: MartConfig) -> DataFrame:
    """One row per cohort with every measure at each day bucket and over all days.

    Each input row is labelled with the buckets it counts into: one grouped sum per
    (cohort, bucket), then the at most ten sums of a cohort side by side. Rows are
    placed by cohort first (a few hundred days each), so both steps run where the rows
    already are and the labelled copies are never shuffled.
    """
    matured = F.date_diff(F.lit(config.last_full_day), "cohort_date")
    placed = _bucket_inputs(long, payer_rows, utn, config).repartition(*dims.COHORT_KEY)
    labelled = placed.withColumn(
        "bucket", F.explode(bucket_labels(F.col("day"), matured, config.day_buckets))
    )
    exact = F.col("bucket") == F.col("day")
    any_day = F.col("bucket") == UNLIMITED
    plain = (*_DAY0, *metrics.WIDE_COUNTS, *metrics.PAYER_COUNTS[:3], "active_users_all", _FLAG)
    exact_sums = [
        F.sum(F.when(exact, F.col("active_users"))).alias("active_users"),
        F.sum(F.when(exact | any_day, F.col("new_payers"))).alias("new_payers"),
    ]
    money_sums = [money(F.sum(m)).alias(m) for m in ("cost", *metrics.WIDE_MONEY)]
    per_bucket = labelled.groupBy(*dims.COHORT_KEY, "bucket").agg(
        *[F.sum(m).alias(m) for m in plain], *exact_sums, *money_sums
    )
    measures = [c for c in per_bucket.columns if c not in (*dims.COHORT_KEY, "bucket")]
    cell = F.struct("bucket", F.struct(*measures))
    by_bucket = per_bucket.groupBy(*dims.COHORT_KEY).agg(F.map_from_entries(F.collect_list(cell)).alias("_cells"))
    labels = (*config.day_buckets, UNLIMITED)
    pivoted = by_bucket.select(
        *dims.COHORT_KEY, *[F.try_element_at("_cells", F.lit(b)).alias(f"b{b}") for b in labels]
    ).filter(F.col(f"b{UNLIMITED}.{_FLAG}") > 0)

    def named(bucket: int, name: str) -> str:
        return f"{name}_{'utn' if bucket == UNLIMITED else bucket}"

    def count_at(bucket: int, name: str, source: str | None = None) -> Column:
        return F.coalesce(F.col(f"b{bucket}.{source or name}"), F.lit(0).cast("long")).alias(named(bucket, name))

    def money_at(bucket: int, name: str) -> Column:
        return F.coalesce(F.col(f"b{bucket}.{name}"), zero()).alias(named(bucket, name))

    def refunds_at(bucket: int) -> Column:
        parts = ("inapp_refunds_revenue_net", "subs_refunds_revenue_net")
        both = [F.coalesce(F.col(f"b{bucket}.{m}"), zero()) for m in parts]
        return money(both[0] + both[1]).alias(named(bucket, "total_refunds_revenue"))

    out = [count_at(0, m) for m in _DAY0] + [money_at(0, "cost")]
    for b in config.day_buckets:
        out.append(count_at(b, "active_users"))
        out += [count_at(b, m) for m in metrics.WIDE_COUNTS]
        out += [money_at(b, m) for m in metrics.WIDE_MONEY]
        out.append(refunds_at(b))
        out += [count_at(b, m) for m in metrics.PAYER_COUNTS]
    out += [count_at(UNLIMITED, m) for m in metrics.WIDE_COUNTS]
    out.append(count_at(UNLIMITED, "active_users", "active_users_all"))
    out += [money_at(UNLIMITED, m) for m in metrics.WIDE_MONEY]
    out.append(refunds_at(UNLIMITED))
    out += [count_at(UNLIMITED, m) for m in metrics.PAYER_COUNTS]
    return stamped(
        pivoted.select(*dims.cohort_parts(F.col("cohort_date")), *dims.COHORT_DIMS, *out), config
    )


def monetization_curves(long: DataFrame, config: MartConfig) -> DataFrame:
    """Daily and cumulative revenue of each cohort on every day up to its mature day.

    Rows are placed by cohort once; the sums, the running totals and the dense day
    grid all work on that placement. A cohort has at most ``max_cohort_day + 1`` days.
    """
    kept = long.filter(
        config.has_app(F.col("application"))
        & (F.col("cohort_date") >= F.lit(config.curve_start))
        & (F.col("cohort_date") < F.lit(config.curve_end))
        & F.col("day_idx").between(0, config.max_cohort_day)
    )
    values = ["ad_revenue_gross", "total_revenue_net"]
    per_day = (
        kept.repartition(*dims.COHORT_KEY)
        .groupBy(*dims.COHORT_KEY, "day_idx")
        .agg(
            *[sum_money(F.col(v)).alias(v) for v in values],
            sum_long(F.when(F.col("day_idx") == 0, F.col("installs"))).alias("_installs"),
            sum_money(F.when(F.col("day_idx") == 0, F.col("cost"))).alias("_spend"),
        )
    )
    age = F.greatest(F.date_diff(F.lit(config.last_full_day), "cohort_date"), F.lit(0))
    cohort = Window.partitionBy(*dims.COHORT_KEY)
    dated = per_day.withColumns(
        {
            "last_day": F.least(age, F.lit(config.max_cohort_day)),
            "installs": F.sum("_installs").over(cohort),
            "spend": money(F.sum("_spend").over(cohort)),
        }
    )
    grid = dense_days(dated, dims.COHORT_KEY, "day_idx", "last_day", values, ["installs", "spend"])
    measures = [f"{v}{s}" for v in values for s in ("", "_cumulative", "_prev_day", "_day0")]
    return stamped(
        grid.select(
            *dims.cohort_parts(F.col("cohort_date")),
            "cohort_day",
            *dims.COHORT_DIMS,
            "installs",
            "spend",
            *measures,
        ),
        config,
    )



def early_signals(daily: DataFrame, days: int) -> DataFrame:
    """Per lifetime: activity of the first ``days`` days beside all later net revenue."""
    early = F.col("day_idx") < days
    names = ("sessions_count", "session_event_count_total", "purchases", "ad_impressions", "total_revenue_net")
    return daily.groupBy("application", "client_id", "user_lifetime_id").agg(
        *[F.coalesce(F.sum(F.when(early, F.col(n))), F.lit(0)).alias(f"early_{n}") for n in names],
        money_or_zero(F.sum(F.when(~early, F.col("total_revenue_net")))).alias("later_revenue"),
    )
