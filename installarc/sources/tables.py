"""Reading and writing mart tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import suppress
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from installarc.settings import RunWindow

# The column that holds the trusted event time in each raw feed, for feeds
# that do not call it ``event_time``. Client clocks are never used.
EVENT_TIME_COLUMNS: dict[str, str] = {
    "session_events": "version",
    "transactions": "version",
    "session_bounds": "opening_timestamp",
    "ad_impressions": "version",
    "installs": "version",
    "reinstalls": "version",
    "purchases": "version",
    "play_purchases": "purchaseTimeMillis",
    "aggregator_subscriptions": "purchased_at_ms",
    "store_notifications": "purchase_date_ms",
    "play_subscriptions": "purchaseTimeMillis",
}


def read_table(
    spark: SparkSession, path: str, name: str | None = None, time_columns: Mapping[str, str] = EVENT_TIME_COLUMNS
) -> DataFrame:
    """Read a parquet table; a known raw feed gets its trusted time as ``event_time``."""
    df = spark.read.parquet(path)
    column = time_columns.get(name or "")
    if column and column in df.columns and "event_time" not in df.columns:
        df = df.withColumnRenamed(column, "event_time")
    return df


@cache
def _local_folder() -> str:
    """A temporary folder of this process, removed when it ends."""
    path = tempfile.mkdtemp(prefix="installarc-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def work_dir(spark: SparkSession) -> str:
    """A new folder under the shared folder: ``spark.checkpoint.dir``, or that of ``setCheckpointDir``.

    Without one a temporary folder serves where driver and executors are one process. On a
    cluster executors would write to their own disks, so there it is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


# Spark's own setting: a finished write drops its shuffle files at once instead of when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Staging:
    """Intermediate tables of one run, written to the shared work folder.

    A result that several later steps read is computed once, and a lost executor costs
    the step at hand only. What a step has shuffled goes when it is written. ``drop`` removes the tables after the run.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.root, self.count = spark, work_dir(spark), 0
        _RUNS.append(self)

    def __call__(self, df: DataFrame) -> DataFrame:
        path, conf = self.folder(), self.spark.conf
        before = conf.get(SHUFFLE_CLEANUP, "false")
        conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            conf.set(SHUFFLE_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def folder(self) -> str:
        """A path of its own for one more table of the run."""
        self.count += 1
        return f"{self.root}/{self.count}"

    def drop(self) -> None:
        files, root = _file_system(self.spark, self.root)
        files.delete(root, True)
        if self in _RUNS:
            _RUNS.remove(self)


_RUNS: list[Staging] = []


def drop_staged() -> None:
    """Removes the tables of all runs so far; call it when no result of theirs is needed any more."""
    for run in list(_RUNS):
        run.drop()


@atexit.register
def _drop_at_exit() -> None:
    with suppress(Exception):  # a session that has ended can't reach its files any more
        drop_staged()


def as_is(df: DataFrame) -> DataFrame:
    """No staging: the plan stays one lazy query."""
    return df


def _file_system(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def _ordered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range-place and sort by the table's sort key, so files cover narrow key ranges.

    Ranges are cut by row count: a month or day with very many rows spans several files.
    """
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_full(df: DataFrame, path: str, day: str, order: Sequence[str]) -> None:
    """Replace a table, partitioned by the month of ``day``."""
    monthly = df.withColumn("month", F.date_format(day, "yyyyMM"))
    _ordered(monthly, order).write.mode("overwrite").partitionBy("month").parquet(path)


#: Folder name that Spark gives to the partition of NULL (and of empty text, which reads back as NULL).
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_text(column: Column) -> Column:
    """A partition's value as text, as its folder has it before escaping; NULL and empty text are one partition."""
    text = column.cast("string")
    return F.when(text != "", text)


def stored_partitions(spark: SparkSession, path: str, column: str) -> dict[str | None, str]:
    """Folder of each partition of a table by its value as text, or None for the NULL partition."""
    files, root = _file_system(spark, path)
    unescaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found: dict[str | None, str] = {}
    if not files.exists(root):
        return found
    for status in files.listStatus(root):
        name, _, value = status.getPath().getName().partition("=")
        if value and unescaped(name) == column:
            found[None if value == NULL_PARTITION else unescaped(value)] = status.getPath().toString()
    return found


def replace_partitions(
    df: DataFrame,
    path: str,
    column: str,
    order: Sequence[str],
    owned: Callable[[str | None], bool] = lambda value: False,
) -> set[str | None]:
    """Replace the partitions that occur in ``df``; returns their values as text, None for NULL.

    Partitions without new rows whose value the run has ``owned`` are removed, as they
    would be by a delete and insert. Values are compared unescaped, so any text, time or NULL can be one.
    """
    seen = Observation()
    told = F.struct(partition_text(F.col(column)).alias("value"))  # a set keeps a struct that holds a NULL
    watched = _ordered(df, order).observe(seen, F.collect_set(told).alias("values"))
    (
        watched.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    written = {row["value"] for row in seen.get["values"] or []}
    files, _ = _file_system(df.sparkSession, path)
    for value, folder in stored_partitions(df.sparkSession, path, column).items():
        if value not in written and owned(value):
            files.delete(df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder), True)
    return written


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Condition that two aliased tables agree in all keys; NULL equals NULL."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def upsert_rows(
    df: DataFrame,
    path: str,
    column: str,
    keys: Sequence[str],
    order: Sequence[str],
    stage: Staging,
    gone: DataFrame | None = None,
) -> None:
    """Delete and insert by key: rows of ``df`` replace those of their key, keys in ``gone`` disappear.

    Any key may be NULL and then equals NULL; empty text in the partition column is NULL, as it is when read back. Only
    partitions in which such keys lie are read and written. The new state of these is staged first,
    so a failed run leaves the table as it was until the swap.
    """
    blank_is_null = F.when(F.col(column).cast("string") != "", F.col(column))
    new = stage(df.withColumn(column, blank_is_null))
    changed = new.select(*keys)
    if gone is not None:
        changed = changed.unionByName(gone.withColumn(column, blank_is_null).select(*keys))
    changed = stage(changed.distinct())
    touched = [row[0] for row in changed.select(column).distinct().collect()]
    inside = F.col(column).isin([value for value in touched if value is not None])
    if None in touched:
        inside = inside | F.col(column).isNull()
    kind = new.schema[column].dataType
    old = df.sparkSession.read.schema(new.select(*[c for c in new.columns if c != column], column).schema).parquet(path)
    old = old.withColumn(column, F.col(column).cast(kind)).filter(inside).select(*df.columns)
    kept = old.alias("_old").join(changed.alias("_new"), same_keys("_old", "_new", keys), "left_anti")
    names = {row[0] for row in changed.select(partition_text(F.col(column))).distinct().collect()}
    replace_partitions(stage(kept.unionByName(new)), path, column, order, lambda value: value in names)


def replace_days(df: DataFrame, path: str, day: str, window: RunWindow, order: Sequence[str]) -> None:
    """Rebuild the days of a run window in a table partitioned by ``day``.

    Days with new rows are swapped in by the write itself. Days of the window that no
    longer have any row are removed afterwards.
    """
    first = window.first_day.isoformat() if window.first_day else ""
    last = window.last_day.isoformat()
    replace_partitions(df, path, day, order, lambda value: value is not None and first <= value <= last)
