"""Sharding by jump consistent hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from installarc.llm.common import groups_of

#: Multiplier of the generator that the published jump hash steps through (fixed value).
STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every 64-bit key: jumps ahead until the next jump would leave the shards.

    With one shard more a key either stays or moves to the new shard.
    """
    key = keys.astype(np.uint64)
    shard = np.zeros(len(key), np.int64)
    jump = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        shard[live] = jump[live]
        state = key[live] * STEP + np.uint64(1)
        key[live] = state
        share = 2147483648.0 / ((state >> np.uint64(33)).astype(np.float64) + 1.0)
        jump[live] = ((shard[live] + 1) * share).astype(np.int64)
        live = live[jump[live] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Jump hash of a 64-bit key column."""

    @F.pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64), shards), dtype="int32")

    return jump(key)


def stable_key(doc_id: Column, other: Column) -> Column:
    """Key from the id; a row without id takes ``other`` in its place, so such rows spread too."""
    return F.when(doc_id.isNull(), F.xxhash64(F.lit("no id"), other)).otherwise(F.xxhash64(doc_id.cast("string")))


def shard(docs: DataFrame, shards: int, doc_id: str = "doc_id", spare: str = "text", rows: int = 5_000) -> DataFrame:
    """Adds ``shard``, ``slot`` and ``grown_shard`` (the shard if there were one more).

    The id and the number of shards alone decide, no ring or table is kept, and a row of
    another run or table with this id gets the same shard. Slots count the rows of a shard
    from 0 without a gap: each shard is cut by key into ranges of about ``rows`` rows that
    are numbered in tasks of their own and put behind each other.

    NULL ids take the key of column ``spare``. Repeated rows share a shard and get slots of their own.
    An empty table stays empty. Columns called like the added ones are replaced.
    """
    keyed = docs.drop("shard", "slot", "grown_shard").withColumn(
        "_shard_key", stable_key(F.col(doc_id), F.col(spare).cast("string"))
    )
    parts = groups_of(docs.count(), rows * shards)
    placed = (
        keyed.withColumn("shard", shard_of(F.col("_shard_key"), shards))
        .withColumn("grown_shard", shard_of(F.col("_shard_key"), shards + 1))
        .withColumn("_shard_part", F.pmod(F.hash("_shard_key"), F.lit(parts)))
    )
    cell = ["shard", "_shard_part"]
    before = Window.partitionBy("shard").orderBy("_shard_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("_shard_rows"))
        .select(*cell, F.coalesce(F.sum("_shard_rows").over(before), F.lit(0)).alias("_shard_start"))
    )
    within = Window.partitionBy(*cell).orderBy("_shard_key", F.xxhash64(F.col(spare).cast("string")))
    return (
        placed.withColumn("_shard_row", F.row_number().over(within))
        .join(starts, cell)
        .withColumn("slot", F.col("_shard_start") + F.col("_shard_row") - 1)
        .drop("_shard_key", "_shard_part", "_shard_row", "_shard_start")
    )
