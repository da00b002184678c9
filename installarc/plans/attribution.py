"""Install lifetimes, user profiles and first-seen users from attribution streams."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from installarc.functions import dims
from installarc.functions.times import parse_timestamp, stamp_text
from installarc.operators.lookup import add_missing
from installarc.operators.shape import one_per_key, padded_union
from installarc.operators.timeline import sequence_rows
from installarc.settings import from_day

USER = ["app_name", "client_id"]

LIFETIME_FIELDS = (
    "activity_kind",
    "platform",
    "country_code",
    "media_source",
    "promo_campaign",
    "promo_campaign_id",
    "ad",
    "ad_id",
    "adset",
    "adset_id",
    "install_device_name",
    "install_device_type",
)

# Fields of the profile taken from the earliest and from the latest attribution event.
FIRST_FIELDS = (
    "media_source",
    "promo_campaign",
    "promo_campaign_id",
    "adset",
    "adset_id",
    "ad",
    "ad_id",
    "country_code",
    "platform",
)
LAST_ONLY_FIELDS = (
    "app_version",
    "sdk_version",
    "cost_currency",
    "cost_model",
    "cost_value",
    "click_time",
    "donor_id",
    "site_id",
)
RETIRED_FIELDS = ("device_type", "device_name", "device_version", "lang", "is_idfa_available")


def _with_times(installs: DataFrame, reinstalls: DataFrame) -> DataFrame:
    """Both streams as one, with parsed start times."""
    first = installs.withColumns(
        {
            "install_time": parse_timestamp(F.col("installed_at")),
            "source_table": F.lit("installs"),
            "is_install": F.lit(1),
        }
    )
    again = reinstalls.withColumns(
        {
            "install_time": F.coalesce(
                parse_timestamp(F.col("reattributed_at")), parse_timestamp(F.col("installed_at"))
            ),
            "source_table": F.lit("reinstalls"),
            "is_install": F.lit(0),
        }
    )
    return padded_union([first, again])


def attribution_events(installs: DataFrame, reinstalls: DataFrame) -> DataFrame:
    """Both streams as one, with parsed start times, one row per user and start time.

    A reinstall starts when the user was reattributed, or was installed if that is
    missing. Of several deliveries of one event the highest version stays; rows whose
    time cannot be parsed are left out, and ``unreadable_starts`` counts them.
    """
    rows = _with_times(installs, reinstalls).drop("installed_at", "reattributed_at")
    known = rows.filter(F.col("install_time").isNotNull() & dims.usable_client(F.col("client_id")))
    return one_per_key(known, [*USER, "install_time"], ["version", "source_table", "activity_kind"])


def unreadable_starts(installs: DataFrame, reinstalls: DataFrame) -> DataFrame:
    """Rows of each stream by whether their start time can be read, with an example of those that can't."""
    rows = _with_times(installs, reinstalls)
    lost = F.col("install_time").isNull()
    return rows.groupBy("source_table").agg(
        F.count(F.lit(1)).alias("rows_count"),
        F.count_if(lost).alias("unreadable_count"),
        F.min(F.when(lost, F.col("installed_at"))).alias("unreadable_example"),
    )


def install_lifetimes(events: DataFrame) -> DataFrame:
    """SCD2 lifetimes: each attribution event opens one and the next event closes it.

    ``events`` is read twice: for the counts per user and hour, and for the rows.
    """
    numbered = sequence_rows(
        events.filter(F.col("client_id").isNotNull()),
        USER,
        "install_time",
        number="user_lifetime_number",
        next_time="lifetime_end_time",
    )
    fields = [F.col(f) if f in events.columns else F.lit(None).cast("string").alias(f) for f in LIFETIME_FIELDS]
    extra = [c for c in ("source_table", "version") if c in events.columns]
    return numbered.select(
        *USER,
        F.concat_ws("|", *USER, stamp_text(F.col("install_time"))).alias("user_lifetime_id"),
        "user_lifetime_number",
        "install_time",
        F.to_date("install_time").alias("install_date"),
        "lifetime_end_time",
        F.col("lifetime_end_time").isNull().cast("int").alias("is_current_lifetime"),
        *fields,
        *[F.col(c).alias("source_version" if c == "version" else c) for c in extra],
    )


def first_seen(sessions: DataFrame, since: date = date(2020, 1, 1)) -> DataFrame:
    """Earliest session event per user, ignoring dates before ``since``."""
    seen = sessions.filter(
        from_day(F.col("event_time"), since) & dims.usable_client(F.col("client_id"))
    )
    return (
        seen.groupBy(*USER)
        .agg(F.min("event_time").alias("first_event_time"))
        .select(
            *USER,
            "first_event_time",
            F.to_date("first_event_time").alias("first_event_date"),
            F.lit("sessions").alias("source_table"),
        )
    )


def user_profile(events: DataFrame, seen: DataFrame) -> DataFrame:
    """First and last attribution per user, event counts, and session-only users."""
    order = F.struct("install_time", "version")
    first = F.min_by(F.struct(*FIRST_FIELDS), order).alias("_first")
    last_fields = ("activity_kind", "is_install", "source_table", *FIRST_FIELDS, *LAST_ONLY_FIELDS)
    last = F.max_by(F.struct(*last_fields), order).alias("_last")
    kind = F.lower(F.coalesce("activity_kind", F.lit("")))
    users = events.groupBy(*USER).agg(
        first,
        last,
        F.min("install_time").alias("first_install_time"),
        F.max("install_time").alias("last_event_time"),
        F.max("version").alias("source_max_version"),
        F.count(F.lit(1)).alias("attribution_events_count"),
        F.count_if(F.col("is_install") == 1).alias("install_events_count"),
        F.count_if(F.col("is_install") == 0).alias("reinstall_events_count"),
        F.count_if(kind.startswith("reattrib")).alias("reattribution_events_count"),
    )
    last_kind = F.lower(F.coalesce("_last.activity_kind", F.lit("")))
    attributed = users.select(
        *USER,
        "first_install_time",
        "last_event_time",
        F.col("_last.activity_kind").alias("last_activity_kind"),
        F.when(last_kind.startswith("reattrib"), "reattributed").otherwise("installed").alias("last_attribution_status"),
        F.col("_last.is_install").alias("last_is_install"),
        *[F.col(f"_first.{f}").alias(f"first_{f}") for f in FIRST_FIELDS],
        *[F.col(f"_last.{f}").alias(f"last_{f}") for f in (*FIRST_FIELDS, *LAST_ONLY_FIELDS)],
        F.col("_last.source_table").alias("last_source_table"),
        "source_max_version",
        "attribution_events_count",
        "install_events_count",
        "reinstall_events_count",
        "reattribution_events_count",
        F.lit("attribution").alias("user_presence_source"),
    )
    none = F.lit(0).cast("long")
    session_only = seen.select(
        *USER,
        F.col("first_event_time").alias("first_install_time"),
        F.col("first_event_time").alias("last_event_time"),
        F.lit("session").alias("last_activity_kind"),
        F.lit("unknown").alias("last_attribution_status"),
        F.col("source_table").alias("last_source_table"),
        none.alias("attribution_events_count"),
        none.alias("install_events_count"),
        none.alias("reinstall_events_count"),
        none.alias("reattribution_events_count"),
        F.lit("sessions").alias("user_presence_source"),
    )
    everyone = add_missing(attributed, session_only, USER)
    return everyone.withColumns(
        {
            "first_install_date": F.to_date("first_install_time"),
            **{f: F.lit(None).cast("string") for f in RETIRED_FIELDS},
        }
    )
