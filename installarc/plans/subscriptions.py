"""Subscriptions: prioritised transaction stream, activation context, event fact."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from installarc.functions import dims, events
from installarc.functions.money import money, price_gross_usd, price_usd
from installarc.operators.lookup import attach, rate_lookup, session_match
from installarc.operators.shape import in_shape, one_per_key, padded_union
from installarc.operators.timeline import asof_join
from installarc.sources.tables import as_is

USER = ["app_name", "client_id"]
TX = ["app_name", "transaction_id"]
CHAIN = ["app_name", "original_transaction_id"]

CONTEXT_FIELDS = ("trigger_name", "app_version", "session_number", "session_id", "device_name", "device_version")
# Attribution columns that the contract keeps NULL.
PLACEHOLDERS = {"media_source": "string", "creative": "string", "promo_campaign": "string"}
FACT_COLUMNS = (
    "event_name",
    "trigger_name",
    "client_id",
    "app_name",
    "transaction_id",
    "event_time",
    "price",
    "price_gross",
    "local_price",
    "currency",
    "currency_rates_denominator",
    "vat_income_multiplier",
    "type",
    "period_type",
    "product_id",
    "original_transaction_id",
    "is_trial_conversion",
    "store",
    "refund_ind",
    "refund_time",
    "refund_transaction_id",
    "platform",
    "new_user",
    "app_version",
    "session_number",
    "session_id",
    "country",
    "device_name",
    "device_version",
    "media_source",
    "creative",
    "promo_campaign",
    "cancel_ind",
    "cancel_time",
    "cancel_reason",
)


def priced(rows: DataFrame, rates: DataFrame, fees: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Adds platform, net multiplier, rate, and net and gross USD prices to rows with a store, country and local price."""
    rows = rows.withColumn("platform", dims.store_label_of(dims.store_platform_of(F.col("store"))))
    rows = attach(rows, fees.select("platform", "country", "vat_income_multiplier"), ["platform", "country"])
    rows = rate_lookup(rows, rates, "currency", F.to_date("event_time"), stage=stage)
    rate, fee, local = F.col("currency_rates_denominator"), F.col("vat_income_multiplier"), F.col("local_price")
    return rows.withColumns(
        {"price": money(price_usd(local, rate, fee)), "price_gross": money(price_gross_usd(local, rate))}
    )


PRICED = ("platform", "vat_income_multiplier", "currency_rates_denominator", "price", "price_gross")


def subscription_stream(
    sources: Sequence[DataFrame], rates: DataFrame, fees: DataFrame, stage: Callable[[DataFrame], DataFrame] = as_is
) -> DataFrame:
    """Transactions of several feeds in falling priority, one row per transaction and kind.

    The kinds are purchase, refund and cancellation, so neither of the latter ever replaces
    a purchase or counts as one. A cancellation that is no refund is named ``refund`` with
    ``cancel_ind`` 1, as the contract knows two names, and pays nothing back: its amount is 0.
    The best feed that knows a transaction describes it; within a feed the latest delivery wins.
    """
    ranked = [df.withColumn("priority", F.lit(i + 1)) for i, df in enumerate(sources)]
    rows = padded_union(ranked)
    refund = events.is_refund_signal(
        F.col("source"), F.col("state"), F.col("notification"), F.col("cancel_reason")
    )
    cancelled = F.coalesce(F.col("type") == "CANCELLATION", F.lit(False))
    kind = F.when(refund, "refund").when(cancelled, "cancellation").otherwise("purchase")
    amount = events.source_price(F.col("source"), F.col("price"), F.col("takehome_percentage"))
    kinds = rows.withColumns({"event_kind": kind, "cancel_ind": cancelled.cast("int")}).withColumns(
        {
            "event_name": F.when(F.col("event_kind") == "purchase", "purchase").otherwise("refund"),
            "local_price": F.when(F.col("event_kind") == "cancellation", money(F.lit(0))).otherwise(amount),
            "refund_transaction_id": F.when(F.col("event_kind") != "purchase", F.col("event_transaction_id")),
        }
    )
    best = [F.col("priority"), -F.unix_micros("event_time"), F.col("event_transaction_id")]
    once = one_per_key(kinds.drop("price"), [*TX, "event_kind"], best, keep="first")
    once = once.withColumnRenamed("source", "event_source").drop("state", "notification")
    return priced(stage(once), rates, fees, stage).drop("platform", "price_gross")


# Columns of the context that no source fills yet.
UNKNOWN_CONTEXT = ("media_source", "creative", "promo_campaign")


def subscription_context(paid: DataFrame, trials: DataFrame, sessions: DataFrame) -> DataFrame:
    """Activation context per transaction: the earliest activation, and number and device of its session.

    ``UNKNOWN_CONTEXT`` is NULL by contract.
    """
    both = padded_union([paid, trials])
    first = one_per_key(both, TX, ["event_time", "trigger_name"], keep="first")
    found = session_match(first, sessions, USER, "event_time", ["session_number", "device_name", "device_version"])
    return found.withColumns({c: F.lit(None).cast("string") for c in UNKNOWN_CONTEXT})


def chain_clients(rows: DataFrame) -> DataFrame:
    """Client of each transaction chain: the one on its earliest identified row."""
    known = rows.filter(
        dims.usable_client(F.col("client_id")) & dims.usable_client(F.col("original_transaction_id"))
    )
    order = F.struct("event_time", "transaction_id", "client_id")
    return known.groupBy(*CHAIN).agg(F.min_by("client_id", order).alias("_chain_client"))


def subscription_fact(
    stream: DataFrame,
    context: DataFrame,
    lifetimes: DataFrame,
    rates: DataFrame,
    fees: DataFrame,
    stage: Callable[[DataFrame], DataFrame] = as_is,
) -> DataFrame:
    """Subscription event rows with client, price, refund, cancel and new-user flags.

    Three results are staged because the next step reads each of them twice: the rows
    with context, the priced rows, and the rows with their lifetime.
    """
    known = context.select(
        *TX,
        F.col("client_id").alias("_context_client"),
        F.col("country").alias("_context_country"),
        *[c for c in CONTEXT_FIELDS if c in context.columns],
    )
    unpriced = stream.drop(*PRICED, "cancel_ind", "refund_transaction_id")
    rows = attach(unpriced, known, TX).withColumns(
        {
            "client_id": F.coalesce(F.nullif("client_id", F.lit("")), F.nullif("_context_client", F.lit(""))),
            "country": F.coalesce("country", "_context_country"),
        }
    )
    rows = stage(rows.drop("_context_client", "_context_country"))
    refunds = rows.filter(F.col("event_kind") == "refund").select(
        *TX,
        F.lit(1).alias("refund_ind"),
        F.col("event_time").alias("refund_time"),
        F.col("event_transaction_id").alias("refund_transaction_id"),
    )
    rows = attach(rows, chain_clients(rows), CHAIN).withColumn(
        "client_id", F.coalesce("client_id", "_chain_client")
    )
    rows = attach(priced(rows, rates, fees, stage), refunds, TX, {"refund_ind": 0})
    cancelled = (F.coalesce("type", F.lit("")) == "CANCELLATION") | F.col("cancel_reason").isNotNull()
    rows = rows.withColumns(
        {"cancel_ind": cancelled.cast("int"), "cancel_time": F.when(cancelled, F.col("event_time"))}
    )
    owned = stage(asof_join(stage(rows), lifetimes, USER, "event_time", "install_time", ["user_lifetime_id"]))
    counts_as_new = (
        (F.col("event_name") == "purchase") & (F.col("cancel_ind") == 0) & F.col("user_lifetime_id").isNotNull()
    )
    firsts = (
        owned.filter(counts_as_new)
        .groupBy("user_lifetime_id")
        .agg(F.min(F.struct("event_time", "transaction_id")).alias("_first"))
    )
    is_first = counts_as_new & (F.struct("event_time", "transaction_id") == F.col("_first"))
    flagged = attach(owned, firsts, "user_lifetime_id").withColumn(
        "new_user", F.coalesce(is_first, F.lit(False)).cast("int")
    )
    return in_shape(flagged, FACT_COLUMNS, PLACEHOLDERS)
