"""Active users of any period from stored bitmaps, without the facts they came from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from installarc.operators.distinct import bitmaps, counted, counted_in_both, number_new
from installarc.settings import RunWindow
from installarc.sources.tables import Staging, replace_days, stored_partitions

USER_ID = "user_lifetime_id"
GROUP = ("application", "platform")


def store_active(
    daily: DataFrame, ids_path: str, path: str, window: RunWindow, stage: Staging, group: Sequence[str] = GROUP
) -> None:
    """Bring the numbers of lifetimes and the bitmaps of active ones by day and group up to a window of the daily fact.

    New lifetimes are appended to the numbers first; a run that ends in between only leaves numbers nobody uses yet,
    so it can be repeated. Then the window's days are replaced.
    """
    spark = stage.spark
    active = daily.filter((F.col("sessions_count") > 0) & window.has_day(F.col("event_date"))).select("event_date", *group, USER_ID)
    known = spark.read.parquet(ids_path) if stored_partitions(spark, ids_path, "batch") else None
    batch = 0 if known is None else known.agg(F.max("batch")).first()[0] + 1
    fresh = number_new(active.select(USER_ID), known, stage)
    fresh.withColumn("batch", F.lit(batch)).write.mode("append").partitionBy("batch").parquet(ids_path)
    if not stored_partitions(spark, ids_path, "batch"):
        return  # nobody was ever active
    numbers = spark.read.parquet(ids_path).drop("batch")
    replace_days(bitmaps(active.join(numbers, USER_ID), ["event_date", *group]), path, "event_date", window, ["event_date", *group])


def active_users(parts: DataFrame, period: str, group: Sequence[str] = GROUP) -> DataFrame:
    """Distinct active lifetimes by ``period`` (week, month, …) and group, and how many were active in the period before as well."""
    dated = parts.withColumn("period_start", F.date_trunc(period, "event_date").cast("date"))
    keys = ["period_start", *group]
    after = dated.withColumn("period_start", F.expr(f"cast(period_start + INTERVAL 1 {period} AS date)"))
    out = counted(dated, keys, "active_users")
    returning = counted_in_both(dated, after, keys, "returning_users")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    joined = out.alias("a").join(returning.alias("b"), same, "left")
    return joined.select(F.lit(period).alias("period"), "a.*", F.coalesce("returning_users", F.lit(0)).cast("long").alias("returning_users"))
