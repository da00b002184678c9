"""Per-key timelines: as-of matching, interval matching and sequence numbers.

All three work on (key, time chunk) groups instead of whole keys. A key that holds a
large share of all rows is therefore spread over as many tasks as it has chunks, and
what one chunk must know about earlier ones travels as one small row per (key, chunk).
Every row is sorted once inside its chunk; no pairs of rows are formed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HIT, SIDE, CHUNK, AT, SPREAD = "_hit", "_side", "_chunk", "_at", "_spread"


def _chunk_of(time: Column, unit: str) -> Column:
    return F.date_trunc(unit, time)


def _all_known(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _spread(complete: Column, columns: Sequence[str]) -> Column:
    """Group part that scatters rows without a key, which would otherwise share one group."""
    return F.when(complete, F.lit(0).cast("long")).otherwise(F.xxhash64(*columns))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    payload: Sequence[str],
    *,
    tie_break: Sequence[str] = (),
    chunk: str = "hour",
    how: str = "left",
) -> DataFrame:
    """Attach the latest ``right`` row with ``right_time <= left_time`` per key.

    Returns the columns of ``left`` plus ``payload``. ``tie_break`` orders right rows
    of one key and time; the last one wins. Rows of ``left`` with a NULL key or time
    match nothing and never enter a group.
    """
    keys, payload, tie_break = list(keys), list(payload), list(tie_break)
    ties = [f"_tie{i}" for i in range(len(tie_break))]
    complete = _all_known([*keys, left_time])

    starts = right.filter(_all_known([*keys, right_time])).select(
        *keys,
        F.col(right_time).alias(AT),
        _chunk_of(F.col(right_time), chunk).alias(CHUNK),
        *[F.col(c).alias(t) for c, t in zip(tie_break, ties)],
        F.struct(*payload).alias(HIT),
    )
    events = left.filter(complete) if how == "inner" else left
    events = events.withColumns({AT: F.col(left_time), CHUNK: _chunk_of(F.col(left_time), chunk)})

    # What is in force when a chunk opens: the last start of any earlier chunk.
    # One row per (key, chunk) on both sides, so the window over a key stays short.
    asked = events.filter(complete).select(*keys, CHUNK).distinct().withColumn(SIDE, F.lit(0))
    heads = starts.groupBy(*keys, CHUNK).agg(
        F.max_by(F.struct(HIT, AT, *ties), F.struct(AT, *ties)).alias("_head")
    ).withColumn(SIDE, F.lit(1))
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(CHUNK, SIDE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    opening = (
        asked.unionByName(heads, allowMissingColumns=True)
        .withColumn("_head", F.last("_head", ignorenulls=True).over(earlier))
        .filter((F.col(SIDE) == 0) & F.col("_head").isNotNull())
        .select(*keys, CHUNK, "_head.*")
    )

    # Starts sort before events of the same instant: the match includes equality.
    rows = (
        starts.unionByName(opening)
        .withColumns({SIDE: F.lit(0), SPREAD: F.lit(0).cast("long")})
        .unionByName(
            events.withColumns({SIDE: F.lit(1), SPREAD: _spread(complete, left.columns)}),
            allowMissingColumns=True,
        )
    )
    so_far = (
        Window.partitionBy(*keys, CHUNK, SPREAD)
        .orderBy(AT, SIDE, *ties)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = rows.withColumn(HIT, F.last(HIT, ignorenulls=True).over(so_far)).filter(F.col(SIDE) == 1)
    if how == "inner":
        matched = matched.filter(F.col(HIT).isNotNull())
    return matched.select(*left.columns, *[F.col(f"{HIT}.{c}").alias(c) for c in payload])


def interval_join(
    events: DataFrame,
    spans: DataFrame,
    keys: Sequence[str],
    time: str,
    start: str,
    end: str,
    payload: Sequence[str] = (),
    *,
    tie_break: Sequence[str] = (),
    chunk: str = "hour",
) -> DataFrame:
    """Inner match of an event to the half-open span ``[start, end)`` that holds it.

    Spans of a key do not overlap (an open span has a NULL end), so the only candidate
    is the latest span started by then. Spans that start and end together are empty;
    with ``tie_break`` set to their real order the last one of an instant is used.
    """
    carried = list(dict.fromkeys([*payload, end]))
    matched = asof_join(
        events, spans, keys, time, start, carried, tie_break=tie_break, chunk=chunk, how="inner"
    )
    inside = matched.filter(F.col(end).isNull() | (F.col(time) < F.col(end)))
    return inside if end in payload else inside.drop(end)


def sequence_rows(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    *,
    number: str | None = None,
    next_time: str | None = None,
    tie_break: Sequence[str] = (),
    chunk: str = "hour",
) -> DataFrame:
    """Number the rows of a key in time order and look up the next row's time.

    Chunks are numbered locally; the count of all earlier chunks is added. The last
    row of a chunk takes the first time of the next chunk. Rows with a NULL key or time
    get NULLs.
    """
    keys = list(keys)
    complete = _all_known([*keys, time])
    tagged = df.withColumn(CHUNK, _chunk_of(F.col(time), chunk))
    over_chunks = Window.partitionBy(*keys).orderBy(CHUNK)
    totals = (
        tagged.filter(complete)
        .groupBy(*keys, CHUNK)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(time).alias("_first"))
        .select(
            *keys,
            CHUNK,
            F.coalesce(
                F.sum("_n").over(over_chunks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_before"),
            F.lead("_first").over(over_chunks).alias("_next"),
        )
    )
    scattered = tagged.withColumn(SPREAD, _spread(complete, df.columns))
    inside = Window.partitionBy(*keys, CHUNK, SPREAD).orderBy(time, *tie_break)
    added = {}
    if number:
        # NULL for rows without a key: nothing precedes them, not even zero rows.
        added[number] = (F.col("_before") + F.row_number().over(inside)).cast("int")
    if next_time:
        later = F.coalesce(F.lead(time).over(inside), F.col("_next"))
        added[next_time] = F.when(F.col("_before").isNotNull(), later)
    return (
        scattered.join(totals, [*keys, CHUNK], "left")
        .withColumns(added)
        .drop(CHUNK, SPREAD, "_before", "_next")
    )
