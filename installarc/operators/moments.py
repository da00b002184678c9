"""Correlations of all pairs of numeric columns: moments in one pass per block pair, and ranks of whole columns.

Missing values are NULL, NaN and infinities. A pair is judged over the rows in which both columns are there; a pair without two
such rows, or with a column that doesn't vary in them, has the correlation NULL. Nothing but one mean and at most ``FREQUENT``
values for each column reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Columns of one block. A task holds five square matrices of two blocks: 10 MB.
BLOCK = 256
#: A value that at least one row in ``FREQUENT`` of its column holds is frequent; a column has at most that many.
FREQUENT = 1000
#: A variance below this part of the second moment about the column's mean is rounding, so the values are equal.
EQUAL = 1e-12

_SUMS = ("n", "sa", "sb", "saa", "sbb", "sab")
_PARTIAL = "a int, b int, " + ", ".join(f"{s} double" for s in _SUMS)


def _finite(column: str) -> Column:
    """The column as double; NULL if it isn't finite."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(F.abs(value) < float("inf"), value)  # NaN is above infinity


def _partial_sums(left: Sequence[int], right: Sequence[int], centres: Sequence[float]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function: the sums of each pair of the block pair over the task's rows, about the given centres."""
    columns = sorted({*left, *right})
    place = {c: i for i, c in enumerate(columns)}
    pairs = [(a, b) for a in left for b in right if a <= b]
    ia, ib = (np.array([place[p[side]] for p in pairs], dtype=np.int64) for side in (0, 1))
    centre = np.array([centres[c] for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = len(columns), 0
        n, s, q, p = (np.zeros((size, size)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) - centre
            there = ~np.isnan(x)
            x, mask = np.where(there, x, 0.0), there.astype(float)
            n += mask.T @ mask
            s += x.T @ mask  # s[a, b]: sum of a where b is there
            q += (x * x).T @ mask
            p += x.T @ x
            rows += len(x)
        if rows:
            sums = (n[ia, ib], s[ia, ib], s[ib, ia], q[ia, ib], q[ib, ia], p[ia, ib])
            ids = (np.array(side, dtype=np.int32) for side in zip(*pairs))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*ids, *sums)], names=["a", "b", *_SUMS])

    return run


def pair_moments(df: DataFrame, features: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(a, b, n, sa, sb, saa, sbb, sab) for all pairs of positions in ``features`` with a <= b.

    Sums are about each column's mean, so large values don't drown small variations. Columns are cut into blocks and each pair of
    blocks reads its own columns only: a task's memory depends on ``block``, not on rows or columns.
    """
    blocks = [list(range(at, min(at + block, len(features)))) for at in range(0, len(features), block)]
    means = df.agg(*[F.avg(_finite(f)).alias(f"_{i}") for i, f in enumerate(features)]).first()
    centres = [m or 0.0 for m in means]
    out = None
    for left, right in combinations_with_replacement(blocks, 2):
        narrow = df.select(*[_finite(features[i]).alias(f"_{i}") for i in sorted({*left, *right})])
        part = narrow.mapInArrow(_partial_sums(left, right, centres), _PARTIAL)
        out = part if out is None else out.unionAll(part)
    return out.groupBy("a", "b").agg(*[F.sum(s).alias(s) for s in _SUMS])


def pair_correlations(df: DataFrame, features: Sequence[str], block: int = BLOCK) -> DataFrame:
    """(feature_a, feature_b, rows_count, correlation) for all pairs of different columns, in the order of ``features``."""
    names = F.array(*[F.lit(f) for f in features])
    va, vb = F.col("n") * F.col("saa") - F.col("sa") ** 2, F.col("n") * F.col("sbb") - F.col("sb") ** 2
    varies = (va > EQUAL * F.col("n") * F.col("saa")) & (vb > EQUAL * F.col("n") * F.col("sbb"))
    value = (F.col("n") * F.col("sab") - F.col("sa") * F.col("sb")) / (F.sqrt(va) * F.sqrt(vb))
    found = pair_moments(df, features, block).filter(F.col("a") < F.col("b"))
    return found.select(
        F.element_at(names, F.col("a") + 1).alias("feature_a"),
        F.element_at(names, F.col("b") + 1).alias("feature_b"),
        F.col("n").cast("long").alias("rows_count"),
        F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value))).alias("correlation"),
    )


def average_ranks(values: DataFrame, group: str, value: str, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(group, value, rows_count, average_rank): the mean rank, from 1, that the rows of each value have inside their group.

    Equal values are counted before anything is sorted. Distinct values are placed by range; each range counts on from the totals of
    the ranges before it, so a group with most values is spread over many tasks. NULL values have no rank.
    """
    counts = values.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("rows_count"))
    placed = stage(counts.repartitionByRange(group, value).withColumn("_range", F.spark_partition_id()))
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_range", group).agg(F.sum("rows_count").alias("_rows"))
    offsets = offsets.select("_range", group, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range", group).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = placed.withColumn("_running", F.sum("rows_count").over(inside)).join(offsets, ["_range", group])
    last = F.col("_before") + F.col("_running")
    return running.select(group, value, "rows_count", (last - (F.col("rows_count") - 1) / 2).alias("average_rank"))


def _frequent(weighed: DataFrame, columns: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The frequent values of each column, ascending, and their ranks: at most ``FREQUENT`` of a column."""
    often = weighed.filter("_often").select("_f", "_v", "average_rank").toArrow()
    f, v, rank = (c.to_numpy() for c in often.columns)
    order = np.lexsort((v, f))
    ends = np.searchsorted(f[order], np.arange(1, columns))
    return list(zip(np.split(v[order], ends), np.split(rank[order], ends)))


def _known_ranks(values: pa.Array, known: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Values of one column, NaN where missing, and their ranks, NaN where the frequent values don't hold them."""
    x, (kept, ranks) = values.to_numpy(zero_copy_only=False).astype(float), known
    if not len(kept):
        return x, np.full(len(x), np.nan)
    at = np.minimum(np.searchsorted(kept, x), len(kept) - 1)
    return x, np.where(kept[at] == x, ranks[at], np.nan)


def _rare_cells(often: Sequence[tuple[np.ndarray, np.ndarray]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function: (_row, _f, _v) of the cells that are there and aren't frequent, from the row's number and its columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = batch.column(0).to_numpy(), []
            for i, known in enumerate(often):
                x, ranks = _known_ranks(batch.column(i + 1), known)
                at = np.flatnonzero(~np.isnan(x) & np.isnan(ranks))
                found.append((rows[at], np.full(len(at), i, dtype=np.int32), x[at]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["_row", "_f", "_v"])

    return run


def _put_ranks(often: Sequence[tuple[np.ndarray, np.ndarray]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function: the ranks of rows, from their columns and, last, the list of their rare cells' (_f, _rank)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(len(often))
            table = np.array([_known_ranks(batch.column(i), known)[1] for i, known in enumerate(often)])
            f, rank = pc.list_flatten(cells).flatten()
            table[f.to_numpy(), pc.list_parent_indices(cells).to_numpy()] = rank.to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(c, from_pandas=True) for c in table], names=[f"_{i}" for i in range(len(often))])

    return run


def ranked(df: DataFrame, features: Sequence[str], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of ``features`` as average ranks, one row for each row of ``df`` that has any value; missing values stay NULL.

    Values are stacked to be counted and ranked; what is shuffled for that is counts. Frequent values, at most ``FREQUENT`` of each
    column, take their ranks inside the row's own task. Only the other cells meet their ranks by a shuffle, in which no key has more
    than one row in ``FREQUENT``, and come back to their row as one short list.
    """
    names = [f"_{i}" for i in range(len(features))]
    finite = [_finite(f).alias(n) for f, n in zip(features, names)]
    rows = df.select(F.monotonically_increasing_id().alias("_row"), *finite)
    rows = stage(rows.filter(F.coalesce(*names).isNotNull()))
    cells = F.array(*[F.struct(F.lit(i).alias("_f"), F.col(n).alias("_v")) for i, n in enumerate(names)])
    long = rows.select(F.inline(cells)).filter(F.col("_v").isNotNull())
    ranks = stage(average_ranks(long, "_f", "_v", stage))
    totals = ranks.groupBy("_f").agg(F.sum("rows_count").alias("_all"))
    weighed = ranks.join(F.broadcast(totals), "_f").withColumn("_often", F.col("rows_count") * FREQUENT >= F.col("_all"))
    often = _frequent(weighed, len(names))
    rare = weighed.filter("NOT _often").select("_f", "_v", F.col("average_rank").alias("_rank"))
    met = rows.mapInArrow(_rare_cells(often), "_row long, _f int, _v double").join(rare, ["_f", "_v"])
    # Placed by row first: a sum on the sending side finds hardly two cells of a row together.
    found = met.select("_row", "_f", "_rank").repartition("_row").groupBy("_row").agg(F.collect_list(F.struct("_f", "_rank")).alias("_cells"))
    wide = rows.join(found, "_row", "left").select(*names, "_cells")
    return wide.mapInArrow(_put_ranks(often), ", ".join(f"{n} double" for n in names)).toDF(*features)


def rank_correlations(df: DataFrame, features: Sequence[str], stage: Callable[[DataFrame], DataFrame], block: int = BLOCK) -> DataFrame:
    """As :func:`pair_correlations`, of the columns' average ranks; a column is ranked over all rows in which it is there."""
    return pair_correlations(stage(ranked(df, features, stage)), features, block)
