"""Events in spans that may overlap: a binned range join with a bounded number of bins for a span of any length."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVEL, BIN, PART = "_level", "_bin", "_part"
#: Each level's bins are so many times as long as those of the level below. The highest level is one bin without end.
STEP = 4
FOREVER = 1 << 62


def _micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def _widths(seconds: int) -> list[int]:
    """Bin lengths of all levels but the highest, in microseconds."""
    out = [seconds * 1_000_000]
    while out[-1] * STEP < FOREVER:
        out.append(out[-1] * STEP)
    return out


def _bin(at: str, level: int, widths: list[int]) -> Column:
    """Number of the bin of a level that holds column ``at``, in whole numbers."""
    return F.lit(0).cast("long") if level == len(widths) else F.expr(f"({at} - pmod({at}, {widths[level]})) div {widths[level]}")


def overlap_join(
    events: DataFrame,
    spans: DataFrame,
    keys: Sequence[str],
    time: str,
    start: str,
    end: str,
    payload: Sequence[str] = (),
    *,
    keep: str = "all",
    closed: bool = False,
    how: str = "inner",
    tie_break: Sequence[str] = (),
    bin_seconds: int = 3600,
    parts: int = 1,
) -> DataFrame:
    """Match events to the spans ``[start, end)`` that hold them, or ``[start, end]`` if ``closed``. Spans may overlap.

    ``keep="all"`` returns a row for each event and span that holds it, ``keep="latest"`` one for each event, with the
    span that started last, then the largest in ``tie_break`` and ``payload``. With ``how="left"`` events in no span stay, with NULLs.
    Returns the columns of ``events`` and ``payload`` (columns of ``events`` called like one are replaced).

    A span lies in the level of bins just as long as itself, so in two bins at most, whether it lasts a second or
    years; an event looks into one bin of each level that occurs. A bin holds spans of at least a quarter of its
    length, so at most a fixed share of the pairs that meet in it don't match. The levels that occur (at most about 20) are read
    from the spans beforehand, so let these be a stored table if they are costly.
    ``parts`` deals the events of a bin to so many groups that each get its spans, for keys with very many
    events under long spans; adaptive execution splits hot bins besides.

    A NULL end is open; such spans share the highest level, in which a key's events meet all its open spans. Empty spans (the end is not after the start; if ``closed``, before it) and spans or events with a
    NULL key, start or time match nothing. Times are compared to the microsecond. Repeated rows each match.
    """
    if keep not in ("all", "latest") or how not in ("inner", "left"):
        raise ValueError("keep is all or latest, how is inner or left")
    keys, payload = list(keys), list(payload)
    known = lambda names: reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names])
    plain = events.drop(*[c for c in payload if c not in keys])
    rows = plain.select(*keys, _micros(F.col(time)).alias("_at"), F.struct(*plain.columns).alias("_row"))
    asked = rows.filter(known([*keys, "_at"]))
    if keep == "latest":  # what holds an instant doesn't depend on the event
        asked = asked.select(*keys, "_at").distinct()

    carried = [F.struct(*[F.col(c) for c in dict.fromkeys([*tie_break, *payload])]).alias("_hit")] if tie_break or payload else []
    last = F.coalesce(_micros(F.col(end)) + (1 if closed else 0), F.lit(FOREVER))
    held = spans.filter(known([*keys, start])).select(*keys, _micros(F.col(start)).alias("_from"), last.alias("_to"), *carried)
    held = held.filter("_from < _to")
    widths = _widths(bin_seconds)
    fits = [F.when(F.col("_to") - F.col("_from") <= w, F.lit(k)) for k, w in enumerate(widths)]
    held = held.withColumn(LEVEL, F.coalesce(*fits, F.lit(len(widths)))).withColumn("_end", F.col("_to") - 1)
    levels = sorted(r[0] for r in held.select(LEVEL).distinct().collect())  # one number for each level
    first_bin, last_bin = (
        F.coalesce(*[F.when(F.col(LEVEL) == k, _bin(at, k, widths)) for k in levels], F.lit(0).cast("long")) for at in ("_from", "_end")
    )
    held = held.withColumn(BIN, F.explode(F.array_distinct(F.array(first_bin, last_bin)))).drop("_end")

    spots = [F.struct(F.lit(k).alias(LEVEL), _bin("_at", k, widths).alias(BIN)) for k in levels]
    kind = f"array<struct<{LEVEL}:int,{BIN}:bigint>>"
    found = asked.withColumn("_spot", F.explode(F.array(*spots).cast(kind))).select("*", f"_spot.{LEVEL}", f"_spot.{BIN}").drop("_spot")
    if parts > 1:
        found = found.withColumn(PART, F.pmod(F.xxhash64("_at"), F.lit(parts)).cast("int"))
        held = held.withColumn(PART, F.explode(F.array(*[F.lit(k) for k in range(parts)])))
    by = [*keys, LEVEL, BIN, *([PART] if parts > 1 else [])]
    pairs = found.join(held, by).filter((F.col("_from") <= F.col("_at")) & (F.col("_at") < F.col("_to")))

    given = [F.col(f"_hit.{c}").alias(c) for c in payload]
    if keep == "all":
        out = pairs.select("_row.*", *given)
        if how == "left":
            met = pairs.select(*keys, "_at").distinct()
            out = out.unionByName(rows.join(met, [*keys, "_at"], "left_anti").select("_row.*"), allowMissingColumns=True)
        return out
    best = pairs.groupBy(*keys, "_at").agg(F.max(F.struct("_from", *(["_hit"] if carried else []))).alias("_best"))
    best = best.select(*keys, "_at", *[F.col(f"_best._hit.{c}").alias(c) for c in payload])
    return rows.join(best, [*keys, "_at"], how).select("_row.*", *payload)
