"""Sessions, daily activity and first-day activity."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from installarc.functions import dims
from installarc.functions.times import seconds_between
from installarc.operators.timeline import asof_join, interval_join
from installarc.settings import RunWindow
from installarc.sources.tables import Staging, as_is, replace_days, replace_partitions, same_keys, stored_partitions

USER = ["app_name", "client_id"]
LAST_SEEN = ("app_version", "country", "device_name", "device_version")


def sessions(events: DataFrame) -> DataFrame:
    """One row per session: bounds, length, event count and last-known app and device."""
    order = F.struct("event_time", "event_name")
    rolled = events.groupBy(*USER, "session_id").agg(
        F.min("session_number").alias("session_number"),
        F.min("event_time").alias("session_start"),
        F.max("event_time").alias("session_end"),
        F.count(F.lit(1)).alias("session_event_count"),
        F.min_by("event_name", order).alias("first_event_name"),
        F.max_by(F.struct(F.col("event_name").alias("last_event_name"), *LAST_SEEN), order).alias("_last"),
    )
    return rolled.select(
        *USER,
        "session_id",
        "session_number",
        "session_start",
        "session_end",
        seconds_between(F.col("session_start"), F.col("session_end")).alias("session_duration_seconds"),
        "session_event_count",
        "first_event_name",
        "_last.*",
    )


# --- sessions from stored parts ---------------------------------------------------

SESSION = [*USER, "session_id"]


def session_parts(events: DataFrame) -> DataFrame:
    """What each UTC day adds to each session: bounds, count, first and last event. Parts of a session merge in any order."""
    return events.groupBy(*SESSION, F.to_date("event_time").alias("event_date")).agg(
        F.min("session_number").alias("session_number"),
        F.min("event_time").alias("session_start"),
        F.max("event_time").alias("session_end"),
        F.count(F.lit(1)).alias("session_event_count"),
        F.min(F.struct("event_time", "event_name")).alias("first_event"),
        F.max(F.struct("event_time", "event_name", *LAST_SEEN)).alias("last_event"),
    )


def merge_parts(parts: DataFrame) -> DataFrame:
    """Sessions, as ``sessions`` makes them, from their parts."""
    merged = parts.groupBy(*SESSION).agg(
        F.min("session_number").alias("session_number"),
        F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"),
        F.sum("session_event_count").alias("session_event_count"),
        F.min("first_event").alias("_first"),
        F.max("last_event").alias("_last"),
    )
    return merged.select(
        *SESSION,
        "session_number",
        "session_start",
        "session_end",
        seconds_between(F.col("session_start"), F.col("session_end")).alias("session_duration_seconds"),
        "session_event_count",
        F.col("_first.event_name").alias("first_event_name"),
        F.col("_last.event_name").alias("last_event_name"),
        *[F.col(f"_last.{c}").alias(c) for c in LAST_SEEN],
    )


def store_parts(events: DataFrame, path: str, window: RunWindow) -> None:
    """Replace the window's days in the table of session parts. A run that is repeated counts nothing twice.

    Events without a time are in no window.
    """
    replace_days(session_parts(events.filter(window.has_time(F.col("event_time")))), path, "event_date", window, SESSION)


def _of(parts: DataFrame, keys: DataFrame) -> DataFrame:
    return parts.alias("_p").join(keys.alias("_k"), same_keys("_p", "_k", SESSION), "left_semi")


def update_sessions(parts_path: str, path: str, window: RunWindow, stage: Staging) -> list[date]:
    """Bring the table of sessions (partitioned by ``start_date``) up to the parts of a window; returns the start days rebuilt.

    A session that goes on over several windows is merged from its stored parts, neither cut nor counted from its events again.
    Rebuilt are the start days of sessions that have a part in the window or had one, so sessions that grew, moved
    or vanished are right; only the days are collected.
    """
    spark = stage.spark
    parts = spark.read.parquet(parts_path)
    now = parts.filter(window.has_day(F.col("event_date"))).select(*SESSION)
    earlier = stored_partitions(spark, path, "start_date")
    starts = []
    if earlier:
        before = spark.read.parquet(path)
        seen = F.col("session_start") < F.lit(window.last_day + timedelta(days=1)).cast("timestamp")
        if window.first_day is not None:
            seen = seen & (F.col("session_end") >= F.lit(window.first_day).cast("timestamp"))
        before = before.filter(seen)
        now = now.unionByName(before.select(*SESSION))
        starts = [r[0] for r in before.select(F.col("start_date").cast("date")).distinct().collect()]
    keys = stage(now.distinct())
    days = {r[0] for r in _of(parts, keys).select("event_date").distinct().collect()} | set(starts)
    whole = _of(parts, parts.filter(F.col("event_date").isin(list(days))).select(*SESSION).distinct())
    merged = merge_parts(whole).withColumn("start_date", F.to_date("session_start"))
    texts = {d.isoformat() for d in days}
    replace_partitions(
        stage(merged.filter(F.col("start_date").isin(list(days)))), path, "start_date", [*USER, "session_start"], lambda v: v in texts
    )
    return sorted(days)


def update_activity(
    sessions_path: str,
    path: str,
    days: Sequence[date],
    lifetimes: DataFrame,
    run_date: date,
    run_ts: datetime,
    stage: Staging,
) -> None:
    """Rebuild the daily activity of the start days that ``update_sessions`` has rebuilt."""
    rows = stage.spark.read.parquet(sessions_path).filter(F.col("start_date").isin(list(days))).drop("start_date")
    texts = {d.isoformat() for d in days}
    daily = activity_daily(rows, lifetimes, run_date, run_ts, stage)
    replace_partitions(daily, path, "activity_date_utc", USER, lambda v: v in texts)


# --- daily activity ---------------------------------------------------------------


def activity_daily(
    session_rows: DataFrame,
    lifetimes: DataFrame,
    run_date: date,
    run_ts: datetime,
    stage: Callable[[DataFrame], DataFrame] = as_is,
) -> DataFrame:
    """Daily activity per user in UTC, without the unfinished current day.

    The install device is that of the lifetime running at the day's last session end;
    a day that crosses a lifetime boundary takes it from the later lifetime. The days
    are staged before the match, so the session rows are folded once.
    """
    finished = session_rows.filter(
        (F.col("session_start") < F.lit(run_date).cast("timestamp")) & dims.usable_client(F.col("client_id"))
    )
    order = F.struct("session_end", "session_start", "session_id")
    days = (
        finished.groupBy(*USER, F.to_date("session_start").alias("activity_date_utc"))
        .agg(
            F.count(F.lit(1)).alias("sessions_count"),
            F.sum("session_duration_seconds").alias("session_duration_seconds_total"),
            F.sum("session_event_count").alias("session_event_count_total"),
            F.min("session_start").alias("first_session_start_utc"),
            F.max("session_end").alias("last_session_end_utc"),
            F.max_by(F.struct(*LAST_SEEN), order).alias("_last"),
        )
        .select(
            "*",
            F.lit(1).alias("is_active"),
            *[F.col(f"_last.{c}").alias(f"{c}_last") for c in LAST_SEEN],
        )
        .drop("_last")
    )
    device = ["lifetime_end_time", "install_device_name", "install_device_type"]
    matched = asof_join(
        stage(days), lifetimes, USER, "last_session_end_utc", "install_time", device, chunk="month"
    )
    running = F.col("lifetime_end_time").isNull() | (
        F.col("last_session_end_utc") < F.col("lifetime_end_time")
    )
    named = {c: F.when(running, F.col(c)) for c in device[1:]}
    return matched.withColumns({**named, "updated_at_utc": F.lit(run_ts).cast("timestamp")}).drop(device[0])


def first_24h(events: DataFrame, lifetimes: DataFrame) -> DataFrame:
    """Event counts and value of each lifetime within 24 hours of its install."""
    span = lifetimes.filter(dims.attributable(F.col("app_name"), F.col("client_id"))).select(
        *USER,
        "install_time",
        "user_lifetime_id",
        F.least(
            F.coalesce("lifetime_end_time", F.expr("install_time + INTERVAL 24 HOURS")),
            F.expr("install_time + INTERVAL 24 HOURS"),
        ).alias("_until"),
    )
    usable = events.filter(dims.attributable(F.col("app_name"), F.col("client_id")))
    owned = interval_join(usable, span, USER, "event_time", "install_time", "_until", ["user_lifetime_id"])
    return owned.groupBy(*USER, "user_lifetime_id").agg(
        F.count(F.lit(1)).alias("events_24h"),
        F.count_if(F.col("event_name") == "click").alias("clicks_24h"),
        F.count_if(F.col("event_name") == "view").alias("views_24h"),
        F.min("event_time").alias("first_event_time"),
        F.max("event_time").alias("last_event_time"),
    )
