"""Shaping operators: one row per key, padded unions, day buckets, dense day grids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNLIMITED = -1


def one_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], keep: str = "last"
) -> DataFrame:
    """Keep the first or last row of each key.

    An aggregate rather than a row number: copies of one key collapse before the
    shuffle, so a key with very many copies costs no more than any other.
    """
    pick = F.max_by if keep == "last" else F.min_by
    rest = [c for c in df.columns if c not in keys]
    best = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def in_shape(df: DataFrame, columns: Sequence[str], placeholders: Mapping[str, str] = {}) -> DataFrame:
    """Columns of a table contract in order. ``placeholders`` are NULL of the given type by contract.

    Any other column that the input lacks is an error.
    """
    missing = [c for c in columns if c not in df.columns and c not in placeholders]
    if missing:
        raise ValueError(f"columns of the contract are missing: {', '.join(missing)}")
    return df.select(*[F.lit(None).cast(placeholders[c]).alias(c) if c in placeholders else F.col(c) for c in columns])


def padded_union(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; a measure a frame lacks is NULL and adds nothing to a sum."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def bucket_labels(day: Column, mature_days: Column, buckets: Sequence[int]) -> Column:
    """Buckets a day counts into: every mature bucket at or after it, and the unlimited one.

    Bucket 0 needs no maturity. A NULL day counts into the unlimited bucket only.
    """
    open_buckets = [
        F.when((day <= b) & ((mature_days >= b) if b else F.lit(True)), F.lit(b)) for b in buckets
    ]
    return F.array_compact(F.array(*open_buckets, F.lit(UNLIMITED)))


def dense_days(
    df: DataFrame, keys: Sequence[str], day: str, last_day: str, values: Sequence[str], carried: Sequence[str]
) -> DataFrame:
    """One row per key and day ``0 … last_day`` with value, running total and total before.

    ``df`` has at most one row per key and day. A key's rows are walked once: each row
    is stretched until the next one, so the grid needs no join. The first row is also
    stretched backwards to day 0, with zeros.
    """
    ordered = Window.partitionBy(*keys).orderBy(day)
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    sums = {f"_sum_{v}": F.sum(v).over(running) for v in values}
    zeros = {f"_zero_{v}": F.sum(F.when(F.col(day) == 0, F.col(v))).over(whole) for v in values}
    walked = df.withColumns(
        {
            **sums,
            **zeros,
            "_from": F.when(F.lag(day).over(ordered).isNull(), F.lit(0)).otherwise(F.col(day)),
            "_to": F.least(F.coalesce(F.lead(day).over(ordered) - 1, F.col(last_day)), F.col(last_day)),
        }
    ).filter(F.col("_from") <= F.col("_to"))
    grid = walked.withColumn("_d", F.explode(F.sequence("_from", "_to")))
    is_own, is_before = F.col("_d") == F.col(day), F.col("_d") < F.col(day)
    out = []
    for v in values:
        kind = df.schema[v].dataType
        nil = F.lit(0).cast(kind)
        own = F.when(is_own, F.col(v)).otherwise(nil)
        total = F.when(is_before, nil).otherwise(F.col(f"_sum_{v}"))
        out += [
            own.cast(kind).alias(v),
            total.cast(kind).alias(f"{v}_cumulative"),
            (total - own).cast(kind).alias(f"{v}_prev_day"),
            F.coalesce(F.col(f"_zero_{v}"), nil).cast(kind).alias(f"{v}_day0"),
        ]
    return grid.select(*keys, *carried, F.col("_d").alias("cohort_day"), *out)
