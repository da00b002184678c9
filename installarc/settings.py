"""Run settings: mart parameters, the processing window and session defaults."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Day horizons of the wide mart.
DAY_BUCKETS = (0, 1, 2, 3, 7, 14, 30, 180, 360)


@dataclass(frozen=True)
class MartConfig:
    """Parameters of the marts. The clock is always an argument, never ``now()``.

    ``apps`` limits the wide and curve marts (exact names), ``revenue_apps`` the revenue
    mart (any letter case); an empty list keeps every application.
    """

    run_date: date
    run_ts: datetime
    apps: tuple[str, ...] = ()
    revenue_apps: tuple[str, ...] = ()
    cohort_start: date = date(2024, 2, 8)
    cohort_end: date | None = None
    day_buckets: tuple[int, ...] = DAY_BUCKETS
    curve_start: date = date(2026, 1, 1)
    curve_end: date = date(2026, 2, 1)
    max_cohort_day: int = 400
    revenue_start: date = date(2026, 1, 1)
    revenue_zone: str = "America/Los_Angeles"

    @property
    def version(self) -> Column:
        return F.lit(self.run_ts).cast("timestamp")

    @property
    def last_full_day(self) -> date:
        """The newest complete UTC day: the run date itself is unfinished."""
        return self.run_date - timedelta(days=1)

    def has_app(self, app: Column) -> Column:
        return app.isin(*self.apps) if self.apps else F.lit(True)

    def has_revenue_app(self, app: Column) -> Column:
        names = [a.lower() for a in self.revenue_apps]
        return F.lower(app).isin(*names) if names else F.lit(True)

    def in_cohort_range(self, day: Column) -> Column:
        keep = day >= F.lit(self.cohort_start)
        if self.cohort_end is not None:
            keep = keep & (day <= F.lit(self.cohort_end))
        return keep


@dataclass(frozen=True)
class RunWindow:
    """Days to (re)build: both bounds, one bound, a lookback, or everything.

    An explicit bound wins over the lookback; ``full_refresh`` drops the lookback.
    The unfinished current day is never part of a window.
    """

    run_date: date
    start: date | None = None
    end: date | None = None
    lookback_days: int = 7
    full_refresh: bool = False
    first_day: date | None = field(init=False)
    last_day: date = field(init=False)

    def __post_init__(self) -> None:
        first = self.start
        if first is None and self.end is None and not self.full_refresh:
            first = self.run_date - timedelta(days=self.lookback_days)
        newest = self.run_date - timedelta(days=1)
        last = newest if self.end is None else min(self.end, newest)
        object.__setattr__(self, "first_day", first)
        object.__setattr__(self, "last_day", last)

    @property
    def is_partial(self) -> bool:
        return self.start is not None or self.end is not None or not self.full_refresh

    def has_day(self, day: Column) -> Column:
        keep = day <= F.lit(self.last_day)
        if self.first_day is not None:
            keep = keep & (day >= F.lit(self.first_day))
        return keep

    def has_time(self, ts: Column) -> Column:
        """The same window on a timestamp, as plain ranges that reach file statistics."""
        keep = ts < _midnight(self.last_day + timedelta(days=1))
        if self.first_day is not None:
            keep = keep & (ts >= _midnight(self.first_day))
        return keep

    def overlaps(self, start: Column, end: Column) -> Column:
        """Lifetimes that can own an event of the window.

        A lifetime that ends during the first day still owns that day's earlier
        events, so it is kept; a rebuilt window then equals a full rebuild.
        """
        keep = start < _midnight(self.last_day + timedelta(days=1))
        if self.first_day is not None:
            keep = keep & (end.isNull() | (end >= _midnight(self.first_day)))
        return keep


def _midnight(day: date) -> Column:
    return F.lit(datetime(day.year, day.month, day.day)).cast("timestamp")


def from_day(ts: Column, day: date) -> Column:
    """``to_date(ts) >= day`` written as a range on the timestamp itself."""
    return ts >= _midnight(day)


# Settings the plans rely on. UTC dates are part of the results; the join setting
# lets adaptive execution split a hot join key even when that costs a later shuffle.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Settings that only take effect while a session is created. Plans are built from
# hundreds of columns; recording a call site for each would cost several calls to the JVM.
LAUNCH_SETTINGS = {
    **SESSION_SETTINGS,
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def stamped(df: DataFrame, config: MartConfig) -> DataFrame:
    return df.withColumn("version", config.version)
