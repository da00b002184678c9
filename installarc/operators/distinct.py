"""Exact distinct counts that add up: numbered ids in bitmaps, one for each group and bucket of numbers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NUMBER = "number"


def number_new(
    ids: DataFrame, known: DataFrame | None, stage: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Ids that ``known`` (the ids' columns and ``number``) lacks, with numbers that follow its largest without a gap.

    A number never changes once it is stored, so bitmaps of different runs fit together. Each task numbers its own ids behind
    those of the tasks before it; the order means nothing. The ids are written first (``stage``), so their
    places don't change when a task is repeated. Ids with a NULL column have no number. Repeated ids count once.
    """
    columns = ids.columns
    fresh = ids.dropna().distinct()
    first = 0
    if known is not None:
        fresh = fresh.join(known.select(*columns), columns, "left_anti")
        newest = known.agg(F.max(NUMBER)).first()[0]
        first = 0 if newest is None else newest + 1
    laid = stage(fresh.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    parts = laid.groupBy("_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    parts = parts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return laid.join(parts, "_part").select(*columns, (F.col("_before") + F.col("_at") - F.col("_first") + first).alias(NUMBER))


def bitmaps(df: DataFrame, keys: Sequence[str], number: Column | None = None) -> DataFrame:
    """(keys, bucket, bits): which numbers occur in each group, in bitmaps of 32,768 numbers (4 KB) each.

    Bits are set before the shuffle, so a group with very many rows ships one bitmap for each task and bucket. Rows without
    a number set none.
    """
    told = F.col(NUMBER) if number is None else number
    numbered = df.withColumn("_n", told).filter("_n is not null")
    return numbered.groupBy(*keys, F.bitmap_bucket_number("_n").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("bits")
    )


def merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups: ids that occur in any of the parts."""
    return parts.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(parts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct ids of each group, over any parts of it: of days, weeks, cohorts, in any combination."""
    return merged(parts, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def counted_in_both(one: DataFrame, other: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct ids of each group that occur in both tables of bitmaps; groups without any are left out."""
    both = merged(one, keys).unionByName(merged(other, keys))
    shared = both.groupBy(*keys, "bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("_sides"))
    return shared.filter("_sides = 2").groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name)).filter(F.col(name) > 0)
