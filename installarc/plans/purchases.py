"""In-app purchases: staging, refunds, the purchase and refund fact, payment stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from installarc.functions import dims, events
from installarc.functions.money import money, price_gross_usd, price_usd
from installarc.operators.lookup import attach, flag_matches, rate_lookup, session_match
from installarc.operators.shape import in_shape, one_per_key
from installarc.operators.timeline import sequence_rows
from installarc.sources.tables import as_is

USER = ["app_name", "client_id"]
TX = ["app_name", "transaction_id"]

FACT_COLUMNS = (
    "event_name",
    "trigger_name",
    "client_id",
    "event_time",
    "price",
    "price_gross",
    "local_price",
    "currency",
    "product_id",
    "product_id_type",
    "transaction_id",
    "purchase_number",
    "refund_ind",
    "refund_time",
    "refund_transaction_id",
    "platform",
    "new_user",
    "app_name",
    "app_version",
    "session_number",
    "session_id",
    "country",
    "device_name",
    "device_version",
    "media_source",
    "creative",
    "promo_campaign",
    "currency_rates_denominator",
    "vat_income_multiplier",
)


CAMPAIGN_FIELDS = ("campaign_name", "parent_campaign_name", "campaign_type")
# Attribution columns that the contract keeps NULL.
PLACEHOLDERS = {"media_source": "string", "creative": "string", "promo_campaign": "string"}


def _placeholders() -> dict[str, Column]:
    return {name: F.lit(None).cast(kind) for name, kind in PLACEHOLDERS.items()}


def inapp_staged(
    purchases: DataFrame,
    products: DataFrame,
    validations: DataFrame,
    fees: DataFrame,
    rates: DataFrame,
    sessions: DataFrame,
    campaigns: DataFrame,
    stage: Callable[[DataFrame], DataFrame] = as_is,
) -> DataFrame:
    """Purchase rows, one per transaction, with price, product, campaign, session and check flag.

    ``fees`` holds the net multiplier per platform and country (store fee and VAT). The
    session number is the purchase event's own, else that of the matched session.
    Rows are staged once without copies and once enriched, because numbering and
    session matching each read their input twice.
    """
    once = stage(one_per_key(purchases, TX, ["event_time", "version"], keep="first"))
    numbered = sequence_rows(
        once.withColumn("client_id", F.nullif("client_id", F.lit(""))),
        USER,
        "event_time",
        number="purchase_number",
        tie_break=["transaction_id"],
    )
    priced = numbered.withColumns(
        {
            "platform": dims.store_label_of(F.col("platform")),
            "local_price": events.source_price(F.col("source"), F.col("price"), F.col("takehome_percentage")),
        }
    ).drop("price", "takehome_percentage", "version")
    enriched = attach(priced, products.select("product_id", "product_id_type"), "product_id")
    enriched = attach(enriched, fees.select("platform", "country", "vat_income_multiplier"), ["platform", "country"])
    enriched = attach(enriched, campaigns.select("campaign_id", *CAMPAIGN_FIELDS), "campaign_id").drop("campaign_id")
    enriched = rate_lookup(enriched, rates, "currency", F.to_date("event_time"), stage=stage)
    enriched = flag_matches(enriched, validations, TX, "validator_matched")
    own = enriched.withColumnRenamed("session_number", "_own_number")
    matched = session_match(stage(own), sessions, USER, "event_time", ["session_number"])
    number = F.coalesce("_own_number", "session_number")
    return matched.withColumns({"session_number": number, **_placeholders()}).drop("_own_number")


def inapp_refunds(staged: DataFrame, candidates: DataFrame) -> DataFrame:
    """Refund signals of all feeds matched to purchases: the earliest possible one per purchase.

    A signal from before the purchase can't be its refund and does not hide a later one.
    """
    signal = events.is_refund_signal(
        F.col("source"), F.col("state"), F.col("notification"), F.col("cancel_reason")
    )
    found = candidates.filter(signal).select(
        "app_name",
        "transaction_id",
        "refund_time",
        "refund_transaction_id",
        F.col("source").alias("refund_source"),
    )
    bought = staged.select(*TX, "platform", "event_time")
    possible = found.join(bought, TX).filter(F.col("refund_time") >= F.col("event_time"))
    first = one_per_key(possible, TX, ["refund_time", "refund_transaction_id"], keep="first")
    return first.select(
        "app_name",
        "platform",
        "transaction_id",
        F.lit(1).alias("refund_ind"),
        "refund_time",
        "refund_transaction_id",
        "refund_source",
    )


def inapp_fact(staged: DataFrame, refunds: DataFrame) -> DataFrame:
    """Validated purchases and their refunds as event rows of one schema."""
    price = price_usd(
        F.col("local_price"), F.col("currency_rates_denominator"), F.col("vat_income_multiplier")
    )
    gross = price_gross_usd(F.col("local_price"), F.col("currency_rates_denominator"))
    valid = staged.filter(F.col("validator_matched") == 1).withColumns(
        {"price": money(price), "price_gross": money(gross)}
    )
    marked = attach(
        valid, refunds.select(*TX, "refund_ind", "refund_time", "refund_transaction_id"), TX, {"refund_ind": 0}
    )
    sold = F.struct(F.lit("purchase").alias("event_name"), F.col("event_time").alias("_at"))
    taken_back = F.struct(F.lit("refund").alias("event_name"), F.col("refund_time").alias("_at"))
    moments = F.array_compact(F.array(sold, F.when(F.col("refund_ind") == 1, taken_back)))
    rows = marked.select("*", F.inline(moments)).drop("event_time").withColumnRenamed("_at", "event_time")
    first_days = valid.groupBy(*USER).agg(F.min(F.to_date("event_time")).alias("_first_day"))
    dated = attach(rows, first_days, USER)
    new_user = F.coalesce((F.to_date("event_time") == F.col("_first_day")).cast("int"), F.lit(0))
    return in_shape(dated.withColumn("new_user", new_user), FACT_COLUMNS, PLACEHOLDERS)


def payment_stream(payments: DataFrame) -> DataFrame:
    """Payment events, one per event id, classified as subscription or in-app."""
    once = one_per_key(payments, ["payment_id"], ["received_at"])
    return once.withColumns(
        {
            "app_name": dims.app_of(F.col("application")),
            "platform": dims.store_platform_of(F.col("store_name")),
            "revenue_type": events.revenue_type_of(F.col("product_id_type"), F.col("type")),
        }
    ).drop("received_at")
