"""Dimension clean-up shared by the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_CLIENT = "00000000-0000-0000-0000-000000000000"

TEXT_DIMS = ("media_source", "promo_campaign", "promo_campaign_id", "ad", "adset")
COHORT_DIMS = ("platform", "application", "country", *TEXT_DIMS)
COHORT_KEY = ("cohort_date", *COHORT_DIMS)


def _text(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def empty_if_null(col: Column) -> Column:
    """NULL and '' become one value, so a join or group key treats them alike."""
    return _text(col)


def platform_of(col: Column) -> Column:
    name = F.lower(_text(col))
    return (
        F.when(name.contains("ios"), "ios").when(name.contains("and"), "android").otherwise("unknown")
    )


def store_platform_of(col: Column) -> Column:
    """Platform of a store name. ``_`` stays a one-character wildcard on purpose."""
    name = F.lower(_text(col))
    is_ios = name.like("%app_store%") | name.contains("ios")
    is_android = name.like("%play_store%") | name.contains("google") | name.contains("android")
    return F.when(is_ios, "ios").when(is_android, "android").otherwise("unknown")


def store_label_of(col: Column) -> Column:
    """Upper-case platform label of the event facts."""
    return F.upper(platform_of(col))


def app_of(*cols: Column) -> Column:
    """First non-empty application name, else ``unknown``."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit("unknown"))


def usable_client(col: Column) -> Column:
    return col.isNotNull() & (col != "")


def attributable(app: Column, client: Column) -> Column:
    """Rows that can belong to an install lifetime at all."""
    return usable_client(client) & (client != ZERO_CLIENT) & app.isNotNull() & (app != "")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def week_start(day: Column) -> Column:
    """Monday of the week."""
    return F.trunc(day, "week")


def cohort_parts(day: Column) -> list[Column]:
    return [
        day.alias("cohort_date"),
        month_start(day).alias("cohort_month"),
        week_start(day).alias("cohort_week"),
    ]
