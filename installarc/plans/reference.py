"""Exchange rates, campaign snapshots, table profiles and feature correlation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from installarc.operators.shape import one_per_key


def rates_scd2(snapshots: DataFrame) -> DataFrame:
    """Closed validity windows of exchange rates from dated snapshots.

    One snapshot per currency and day stays (the latest); a day that repeats the
    previous value opens no window. The windows of a currency are its distinct days,
    so the per-currency window functions see at most one row per calendar day.
    """
    keys = ["base_currency", "currency"]
    daily = one_per_key(
        snapshots.select(*keys, F.to_date("rate_time").alias("valid_from_date"), "rate_time", "value"),
        [*keys, "valid_from_date"],
        ["rate_time", "value"],
    )
    by_day = Window.partitionBy(*keys).orderBy("valid_from_date")
    changed = daily.withColumn("_old", F.lag("value").over(by_day)).filter(
        F.col("_old").isNull() | (F.col("_old") != F.col("value"))
    )
    return changed.select(
        *keys,
        "valid_from_date",
        F.date_sub(F.lead("valid_from_date").over(by_day), 1).alias("valid_to_date"),
        "value",
    )


# --- campaign snapshots -----------------------------------------------------------


PAYLOAD = """struct<
  goal: struct<goal_type: string, country_code_to_goal_value: map<string, double>>,
  budget: struct<country_code_to_daily_budget: map<string, double>>,
  targeting: struct<countries: array<string>>>"""


def campaign_snapshots(raw: DataFrame) -> DataFrame:
    """Snapshots without repeated deliveries, with the goal type and the country blocks of their payload, parsed and as text."""
    once = one_per_key(raw, ["account_id", "campaign_id", "snapshot_ts"], ["payload"])
    return once.withColumn("_payload", F.from_json("payload", PAYLOAD)).select(
        "account_id",
        F.to_date("snapshot_ts").alias("snapshot_date"),
        "snapshot_ts",
        "campaign_id",
        "campaign_name",
        F.col("_payload.goal.goal_type").alias("goal_type"),
        F.col("_payload.targeting.countries").alias("targeting_countries"),
        F.col("_payload.goal.country_code_to_goal_value").alias("goal_country_values"),
        F.col("_payload.budget.country_code_to_daily_budget").alias("budget_country_values"),
        F.get_json_object("payload", "$.goal.country_code_to_goal_value").alias("goal_country_values_raw"),
        F.get_json_object("payload", "$.budget.country_code_to_daily_budget").alias("budget_country_values_raw"),
    )


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """Newest snapshot of every campaign, without its country blocks."""
    plain = snapshots.drop("targeting_countries", *[f"{b}_country_values{r}" for b in ("goal", "budget") for r in ("", "_raw")])
    return one_per_key(plain, ["account_id", "campaign_id"], ["snapshot_ts"])


CAMPAIGN = ("account_id", "snapshot_ts", "campaign_id")


def campaign_targeting(snapshots: DataFrame) -> DataFrame:
    """One row per targeted country."""
    return snapshots.select(*CAMPAIGN, F.explode("targeting_countries").alias("country_code"))


def campaign_goals(snapshots: DataFrame) -> DataFrame:
    """One row per country with a goal value of its own."""
    return snapshots.select(*CAMPAIGN, "goal_type", F.explode("goal_country_values").alias("country_code", "goal_value"))


def campaign_budgets(snapshots: DataFrame) -> DataFrame:
    """One row per country with a daily budget of its own."""
    return snapshots.select(*CAMPAIGN, F.explode("budget_country_values").alias("country_code", "daily_budget"))


# --- profiles and correlation -----------------------------------------------------


def table_profile(tables: Mapping[str, DataFrame], layers: Mapping[str, str] | None = None) -> DataFrame:
    """Row count, columns, NULL cells and distinct first-column values of each table.

    Each table is read once. ``layers`` names the layer a table belongs to.
    """

    def profile(name: str, df: DataFrame) -> DataFrame:
        nulls = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in df.columns])
        return df.agg(
            F.lit((layers or {}).get(name, "raw")).alias("layer"),
            F.lit(name).alias("table_name"),
            F.lit(len(df.columns)).alias("column_count"),
            F.count(F.lit(1)).alias("row_count"),
            nulls.alias("null_cells"),
            F.count_distinct(df.columns[0]).alias("key_count"),
        )

    return reduce(lambda a, b: a.unionByName(b), [profile(name, df) for name, df in tables.items()])


def layer_totals(profile: DataFrame) -> DataFrame:
    """Tables, rows and columns per layer."""
    return profile.groupBy("layer").agg(
        F.count(F.lit(1)).alias("table_count"),
        F.sum("row_count").alias("total_rows"),
        F.sum("column_count").alias("column_count"),
    )


def largest_tables(profile: DataFrame, top: int = 15, without: Sequence[str] = ()) -> DataFrame:
    """The tables with most rows, leaving out the named ones."""
    kept = profile.filter(~F.col("table_name").isin(*without)) if without else profile
    return kept.orderBy(F.desc("row_count"), "table_name").limit(top).select("table_name", "row_count")


def feature_correlation(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of every feature with the target, in one pass."""
    stats = df.agg(*[F.corr(F.col(f).cast("double"), F.col(target).cast("double")).alias(f) for f in features])
    return stats.unpivot([], list(features), "feature", "correlation")
