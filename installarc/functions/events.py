"""Event predicates and classifiers: purchases, refunds, subscriptions, revenue types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from installarc.functions.money import money


def is_purchase(event_name: Column) -> Column:
    return event_name == "purchase"


def is_refund_event(event_name: Column) -> Column:
    return event_name == "refund"


def _folded(col: Column) -> Column:
    return F.lower(F.coalesce(col, F.lit("")))


def is_paid_period(event_name: Column, period_type: Column) -> Column:
    return is_purchase(event_name) & (_folded(period_type) == "normal")


def subscription_counters() -> dict[str, Column]:
    """Row predicates of a subscription event, one per counted metric."""
    name, period = F.col("event_name"), F.col("period_type")
    paid = is_paid_period(name, period)
    return {
        "purchases": paid,
        "subscription_purchases": paid,
        "refunds": is_refund_event(name),
        "subscription_refunds_num": is_refund_event(name),
        "trial_purchases": is_purchase(name) & _folded(period).contains("trial"),
        "trial_converted_purchases": is_purchase(name)
        & (F.coalesce(F.col("is_trial_conversion"), F.lit(0)) == 1),
        "renewal_purchases": is_purchase(name) & (_folded(F.col("type")) == "renewal"),
        "cancelations": F.coalesce(F.col("cancel_ind"), F.lit(0)) == 1,
    }


def revenue_type_of(product_type: Column, event_type: Column) -> Column:
    """Subscription or in-app. Anything naming a consumable counts as in-app."""
    kind = _folded(product_type)
    inapp = (
        kind.contains("consumable")
        | kind.contains("inapp")
        | (F.coalesce(event_type, F.lit("")) == "NON_RENEWING_PURCHASE")
    )
    return F.when(kind.contains("sub"), "subscription").when(inapp, "inapp").otherwise("subscription")


# How each raw feed writes prices.
PRICE_DIVISORS = {"play": 1_000_000, "app_store": 1_000}


def source_price(source: Column, price: Column, takehome: Column) -> Column:
    """Source price in currency units: micros, thousandths, or price times the kept share."""
    amount = price.cast("decimal(28,8)")
    expr = F.when(
        source == "aggregator", money(amount * F.coalesce(takehome, F.lit(1)).cast("decimal(9,6)"))
    )
    for name, divisor in PRICE_DIVISORS.items():
        expr = expr.when(source == name, money(amount / F.lit(divisor)))
    return expr.otherwise(money(amount))


def is_refund_signal(source: Column, state: Column, notification: Column, reason: Column) -> Column:
    """Refund rule of each raw feed. ``state`` is the feed's numeric status code.

    The Play feed says 101 either as state (purchases) or as cancel reason (subscriptions).
    """
    code = F.coalesce(state == 101, F.lit(False)) | F.coalesce(reason == "101", F.lit(False))
    play = (source == "play") & code
    store = (source == "app_store") & ((notification == "REFUND") | (state == 5))
    aggregator = (source == "aggregator") & (reason == "CUSTOMER_SUPPORT")
    return F.coalesce(play, F.lit(False)) | F.coalesce(store, F.lit(False)) | F.coalesce(aggregator, F.lit(False))
