"""The library's expressions as functions of SQL text, for users who write queries instead of plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_FACTOR = "CASE WHEN CAST({0} AS DOUBLE) > 0 THEN CAST({0} AS DOUBLE) ELSE 1.0D END"
_LOCAL = "coalesce(CAST(price AS DOUBLE), 0.0D)"

#: Name, arguments, type and body. Bodies are inlined when a query is planned, so they cost what the expressions cost.
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "price_gross_usd": (
        "price DECIMAL(38,8), rate DECIMAL(38,8)",
        "DECIMAL(38,8)",
        f"CAST({_LOCAL} / {_FACTOR.format('rate')} AS DECIMAL(38,8))",
    ),
    "price_usd": (
        "price DECIMAL(38,8), rate DECIMAL(38,8), multiplier DECIMAL(38,8)",
        "DECIMAL(38,8)",
        f"CAST({_LOCAL} / {_FACTOR.format('rate')} * {_FACTOR.format('multiplier')} AS DECIMAL(38,8))",
    ),
    "platform_of": (
        "name STRING",
        "STRING",
        "CASE WHEN lower(coalesce(name, '')) LIKE '%ios%' THEN 'ios' WHEN lower(coalesce(name, '')) LIKE '%and%' THEN 'android' ELSE 'unknown' END",
    ),
    "store_platform_of": (
        "name STRING",
        "STRING",
        "CASE WHEN lower(coalesce(name, '')) LIKE '%app_store%' OR lower(coalesce(name, '')) LIKE '%ios%' THEN 'ios' "
        "WHEN lower(coalesce(name, '')) LIKE ANY ('%play_store%', '%google%', '%android%') THEN 'android' ELSE 'unknown' END",
    ),
    "app_of": ("name STRING, project STRING", "STRING", "coalesce(nullif(name, ''), nullif(project, ''), 'unknown')"),
    "revenue_type_of": (
        "product_type STRING, event_type STRING",
        "STRING",
        "CASE WHEN lower(coalesce(product_type, '')) LIKE '%sub%' THEN 'subscription' "
        "WHEN lower(coalesce(product_type, '')) LIKE '%consumable%' OR lower(coalesce(product_type, '')) LIKE '%inapp%' "
        "OR coalesce(event_type, '') = 'NON_RENEWING_PURCHASE' THEN 'inapp' ELSE 'subscription' END",
    ),
}


def register_functions(spark: SparkSession) -> None:
    """Make ``FUNCTIONS`` known to the session's SQL; registering them again replaces them."""
    for name, (arguments, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")


def register_lifetimes(spark: SparkSession, lifetimes: DataFrame, view: str = "install_lifetimes") -> None:
    """A view of the lifetimes, and ``lifetimes_in(first_day, last_day)``: those that can own an event of these days.

    As in a run window, a lifetime that ends during the first day counts, and one that starts after the last day doesn't.
    """
    lifetimes.createOrReplaceTempView(view)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lifetimes.schema)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION lifetimes_in(first_day DATE, last_day DATE) RETURNS TABLE ({columns}) RETURN "
        f"SELECT * FROM `{view}` WHERE install_time < CAST(date_add(last_day, 1) AS TIMESTAMP) "
        "AND (lifetime_end_time IS NULL OR lifetime_end_time >= CAST(first_day AS TIMESTAMP))"
    )
