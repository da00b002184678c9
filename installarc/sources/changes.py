"""Late data: days that files written since the last run hold events of, however old these are."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from installarc.settings import RunWindow
from installarc.sources.tables import replace_days

EPOCH = datetime(1970, 1, 1)


def newest_change(spark: SparkSession, *paths: str) -> datetime:
    """When the newest file of the inputs was written; what the next run passes as ``since``. Take it before the inputs are read.

    Only the files are listed, none is opened. Without files it is the beginning of 1970.
    """
    seen = reduce(
        DataFrame.unionByName,
        [
            spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("modificationTime")
            for path in paths
        ],
    )
    return seen.agg(F.max("modificationTime")).first()[0] or EPOCH


def changed_days(spark: SparkSession, path: str, day: Column, since: datetime | None, until: Column | None = None) -> DataFrame:
    """(day): days of the rows in files written at ``since`` or later, or in all files without ``since``.

    Files are told by ``_metadata.file_modification_time``, so older ones are not opened, and of the others only the
    columns of ``day`` are read. With ``until`` a row changes all days from ``day`` to ``until``, as a late install
    does until the next one. A NULL day is no day; a NULL ``until`` is ``day`` itself. A file of the very instant counts again, as
    rebuilding a day twice does no harm and missing it would.
    """
    rows = spark.read.parquet(path)
    if since is not None:
        rows = rows.filter(F.col("_metadata.file_modification_time") >= F.lit(since))
    days = rows.select(day.cast("date").alias("day"), (until if until is not None else day).cast("date").alias("until")).distinct()
    last = F.greatest("day", F.coalesce("until", "day"))
    return days.filter("day is not null").select(F.explode(F.sequence("day", last)).alias("day")).distinct()


def windows_of(days: Iterable[date], run_date: date, within: RunWindow | None = None) -> list[RunWindow]:
    """Windows that rebuild just these days: one for each stretch of consecutive ones, the oldest first.

    With ``within`` its own days are rebuilt as well, as in a run without late data. Days that have not ended are left out. A full
    refresh stays one window.
    """
    if within is not None and within.first_day is None:
        return [within]
    asked = {d for d in days if d < run_date}
    if within is not None:
        asked |= {within.first_day + timedelta(n) for n in range((within.last_day - within.first_day).days + 1)}
    out: list[list[date]] = []
    for day in sorted(asked):
        if out and day - out[-1][-1] == timedelta(1):
            out[-1].append(day)
        else:
            out.append([day])
    return [RunWindow(run_date=run_date, start=run[0], end=run[-1]) for run in out]


def rebuild_changed(
    build: Callable[[RunWindow], DataFrame],
    path: str,
    day: str,
    order: Sequence[str],
    changed: Sequence[DataFrame],
    run_date: date,
    within: RunWindow | None = None,
) -> list[RunWindow]:
    """Rebuild the changed days (and those of ``within``) of a table partitioned by ``day``; returns the windows.

    ``changed`` are results of ``changed_days``; days are what is collected, so the list is as long as the history at most.
    """
    days = {row["day"] for row in reduce(DataFrame.unionByName, changed).distinct().collect()} if changed else set()
    windows = windows_of(days, run_date, within)
    for window in windows:
        replace_days(build(window), path, day, window, order)
    return windows
