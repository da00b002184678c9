"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from installarc.sources.tables import Staging

#: Words are runs of characters other than blank, tab, line feed, vertical tab, form feed and return.
WORD = "[^\\x20\\x09-\\x0D]+"


def stage_for(df: DataFrame) -> Staging:
    """Tables of one run, in the folder that the cluster shares."""
    return Staging(df.sparkSession)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    """``crc32(doc_id as text) mod divisor``; -1 for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % divisor, F.lit(-1))


def content_key(doc_id: Column, text: Column) -> Column:
    """Key of a document that also tells documents of one id (or without id) apart by their text.

    Rows that repeat both id and text share the key: they are one document.
    """
    return F.struct(
        doc_id.cast("string").alias("id"), F.xxhash64(text).alias("a"), F.hash(text, F.lit(1)).alias("b")
    )


def fresh(name: str, taken: list[str]) -> str:
    """A column name like ``name`` that a table does not have."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def groups_of(count: int, size: int) -> int:
    """Number of groups that hold about ``size`` of ``count`` rows each."""
    return max(1, -(-count // size))


def with_keys(docs: DataFrame, keys: DataFrame, how: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose ``content_key`` is (``left_semi``) or isn't (``left_anti``) in ``keys`` (column ``key``)."""
    kind = keys.schema["key"].dataType
    keyed = docs.withColumn("_content_key", content_key(F.col(doc_id), F.col(text)).cast(kind))
    return keyed.join(keys.withColumnRenamed("key", "_content_key"), "_content_key", how)


def numbered(df: DataFrame, group: str, order: list[str], stage: Staging, place: str = "place") -> DataFrame:
    """Adds ``place``, a row's number from 0 among those of its ``group`` in the order of ``order``.

    Rows are range-placed and sorted once, so no group is ever one task's: what stands before a group's rows in a
    range is added from the counts of the earlier ranges. Rows equal in all of ``order`` are spread as well, in no
    stated order. ``group`` isn't NULL. The input is read twice, so let it be a stored table.
    """
    keys = [group, *order]
    laid = stage(
        df.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*keys, "_row")
        .sortWithinPartitions(*keys, "_row")
        .select(*df.columns, F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at"))
    )
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        laid.groupBy(group, "_range")
        .agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .select(group, "_range", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    return laid.join(starts, [group, "_range"]).select(
        *df.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias(place)
    )
