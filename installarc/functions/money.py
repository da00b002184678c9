"""Money as exact decimals: sums do not depend on row order or partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,8)"
WIDE_MONEY = "decimal(38,8)"


def money(col: Column) -> Column:
    return col.cast(MONEY)


def money_or_zero(col: Column) -> Column:
    return F.coalesce(col.cast(MONEY), F.lit(0).cast(MONEY))


def zero() -> Column:
    return F.lit(0).cast(MONEY)


def _factor(col: Column) -> Column:
    """A rate or multiplier; missing and non-positive values mean 'do not scale'."""
    value = col.cast("double")
    return F.when(value > 0, value).otherwise(F.lit(1.0))


def price_gross_usd(price: Column, rate: Column) -> Column:
    local = F.coalesce(price.cast("double"), F.lit(0.0))
    return (local / _factor(rate)).cast(WIDE_MONEY)


def price_usd(price: Column, rate: Column, multiplier: Column) -> Column:
    local = F.coalesce(price.cast("double"), F.lit(0.0))
    return (local / _factor(rate) * _factor(multiplier)).cast(WIDE_MONEY)


def signed(amount: Column, is_negative: Column) -> Column:
    """Magnitude with the sign taken from the event, whatever sign the source wrote."""
    return F.when(is_negative, -F.abs(amount)).otherwise(F.abs(amount))


def sum_money(amount: Column, when: Column | None = None) -> Column:
    """Exact conditional sum, zero when no row qualifies."""
    picked = amount if when is None else F.when(when, amount)
    return money_or_zero(F.sum(picked))


def sum_long(count: Column) -> Column:
    return F.coalesce(F.sum(count), F.lit(0)).cast("long")


def total_gross(prefix: str = "") -> Column:
    parts = [F.col(f"{prefix}{m}") for m in ("inapp_revenue_gross", "subs_revenue_gross", "ad_revenue_gross")]
    return money(parts[0] + parts[1] + parts[2])


def total_net(prefix: str = "") -> Column:
    """Ad revenue has no net form; its gross amount enters the net total."""
    parts = [F.col(f"{prefix}{m}") for m in ("inapp_revenue_net", "subs_revenue_net", "ad_revenue_gross")]
    return money(parts[0] + parts[1] + parts[2])
