"""Mixing sources to target weights by dependent (pivotal) rounding."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from installarc.llm.common import groups_of, stage_for
from installarc.sources.tables import Staging

UNIT = "_mix_id string, _mix_source string, _mix_size long"


def cyclic_weights(sources: DataFrame, source: str, weights: tuple[float, ...]) -> DataFrame:
    """``weights`` in turn to the sources in code-point order, NULL last. One row for each source goes in."""
    rank = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    return sources.select(source, F.element_at(F.array(*map(F.lit, weights)), rank % len(weights) + 1).alias("weight"))


def source_targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Adds ``target`` to rows of (``source_size``, ``weight``): weight shares of ``share`` times all sizes.

    A target stops at ``most`` times its source; what it leaves is dealt to the others by weight
    until none is above. That is one common level: target = least of weight x level and the stop.
    Each round finds the level from three sums; only those leave the cluster.
    """
    cap = F.col("source_size") * F.lit(float(most))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("weight") * F.lit(level) > cap
        row = sources.agg(
            F.sum(F.when(full, cap)).alias("given"),
            F.sum(F.when(~full, F.col("weight").cast("decimal(28,6)"))).cast("double").alias("open"),
        ).first()
        if not row["open"]:
            break
        raised = (share * total - (row["given"] or 0.0)) / row["open"]
        if raised <= level:
            break
        level = raised
    want = F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.least(want, cap).cast("double"))


def settle(size: np.ndarray, p: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """One pass of pairing: returns ``p`` with at most one entry left between 0 and 1.

    The open unit meets the next one and words move between the two, either way at random,
    until one of them is whole or gone. The chances are such that no expectation changes,
    and the expected words of the two together never change at all.
    """
    p = p.copy()
    held = -1
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        room_a, has_a = (1.0 - p[a]) * size[a], p[a] * size[a]
        room_b, has_b = (1.0 - p[b]) * size[b], p[b] * size[b]
        up, down = min(room_a, has_b), min(has_a, room_b)
        if draws[i] * (up + down) < down:  # words go from b to a
            p[a], p[b] = (1.0 if room_a <= has_b else p[a] + up / size[a]), (0.0 if has_b <= room_a else p[b] - up / size[b])
        else:
            p[a], p[b] = (0.0 if has_a <= room_b else p[a] - down / size[a]), (1.0 if room_b <= has_a else p[b] + down / size[b])
        held = next((k for k in (a, b) if 0.0 < p[k] < 1.0), -1)
    return p


def _settled(units: DataFrame, level: int, seed: int) -> DataFrame:
    """Settles each group of (source, ``_mix_group``)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_mix_size", "_mix_hash"], ascending=[False, True], kind="stable").reset_index(drop=True)
        start = np.bitwise_xor.reduce(pdf["_mix_hash"].to_numpy(np.int64).view(np.uint64))
        rng = np.random.default_rng([seed, level, int(start)])
        size = pdf["_mix_size"].to_numpy(np.float64)
        pdf["_mix_p"] = settle(size, pdf["_mix_p"].to_numpy(np.float64), rng.random(len(pdf)))
        return pdf.drop(columns="_mix_group")

    schema = f"{UNIT}, _mix_rows long, _mix_hash long, _mix_whole long, _mix_p double"
    columns = [c.split()[0] for c in schema.split(", ")]
    return units.groupBy("_mix_source", "_mix_group").applyInPandas(run, schema).select(*columns)


def _counts(units: DataFrame, stage: Staging, seed: int, rows: int, fan_in: int) -> DataFrame:
    """Whole copies of every unit: groups of ``rows`` units, then a tree of their leftovers."""
    whole = (F.col("_mix_p") <= 0) | (F.col("_mix_p") >= 1)
    done, level = [], 0
    units = units.withColumn("_mix_group", F.pmod(F.col("_mix_hash"), F.ceil(F.col("_mix_units") / rows)))
    units = units.drop("_mix_units")
    while True:
        settled = stage(_settled(units, level, seed))
        done.append(settled.filter(whole))
        left = settled.filter(~whole)
        most = left.groupBy("_mix_source").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            break
        level += 1
        units = left.withColumn("_mix_group", F.pmod(F.hash("_mix_hash", F.lit(level)), F.lit(groups_of(most, fan_in))))
    draw = F.pmod(F.xxhash64("_mix_hash", F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    done.append(left.withColumn("_mix_p", F.when(draw < F.col("_mix_p"), 1.0).otherwise(0.0)))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def mix(
    docs: DataFrame,
    size: Column,
    weights: tuple[float, ...],
    share: float,
    most: float,
    doc_id: str = "doc_id",
    source: str = "source",
    seed: int = 7,
    rows: int = 2_000,
    fan_in: int = 64,
) -> DataFrame:
    """Adds ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (copies times size) to every row.

    Each row of a source shall be taken target / source_size times. The whole part is
    certain; the fraction is rounded by pivotal dependent rounding: open fractions of a source
    are paired and move words between them at random until one is 0 or 1. Groups of ``rows`` rows
    each leave at most one open fraction; these meet in a tree with ``fan_in`` leftovers a
    group, and one per source is drawn at the end. Expected copies hold for every row,
    and a source's taken words miss the target by one row at most. Draws depend on
    the rows alone, so reruns agree whatever the partitioning.

    NULL is a source of its own, last in the order. Rows of size 0 (NULL or empty text) take
    no words. Rows that agree in id, source and size are interchangeable: they are rounded as one
    unit and share its copies as evenly as can be. Empty tables give an empty result.
    Columns called like the added ones are replaced.
    """
    stage = stage_for(docs)
    added = ["size", "source_size", "target", "copies", "taken"]
    kept = [c for c in docs.columns if c.lower() not in added]
    sized = docs.withColumn("_mix_size", F.coalesce(size, F.lit(0)).cast("long")).select(
        *kept,
        "_mix_size",
        F.col(doc_id).cast("string").alias("_mix_id"),
        F.col(source).cast("string").alias("_mix_source"),
    )
    unit = ["_mix_id", "_mix_source", "_mix_size"]
    units = stage(sized.groupBy(*unit).agg(F.count(F.lit(1)).alias("_mix_rows")))
    sums = stage(
        units.groupBy("_mix_source").agg(
            F.sum(F.col("_mix_size") * F.col("_mix_rows")).alias("source_size"), F.count(F.lit(1)).alias("_mix_units")
        )
    )
    weighted = sums.alias("a").join(
        cyclic_weights(sums, "_mix_source", weights).alias("b"), F.expr("a._mix_source <=> b._mix_source")
    )
    targets = stage(
        source_targets(weighted.select("a.*", "weight"), share, most).select(
            F.col("_mix_source").alias("_mix_of"), "source_size", "_mix_units", "target"
        )
    )
    of_source = F.col("_mix_source").eqNullSafe(F.col("_mix_of"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    expected = F.col("_mix_rows") * rate
    counts = _counts(
        units.filter(F.col("_mix_size") > 0)
        .join(targets, of_source)
        .select(
            *unit,
            "_mix_rows",
            "_mix_units",
            F.xxhash64(*unit).alias("_mix_hash"),
            F.floor(expected).cast("long").alias("_mix_whole"),
            (expected - F.floor(expected)).alias("_mix_p"),
        ),
        stage,
        seed,
        rows,
        fan_in,
    ).select(
        *[F.col(c).alias(f"{c}_unit") for c in unit],
        F.col("_mix_rows").alias("_mix_rows_unit"),
        (F.col("_mix_whole") + F.col("_mix_p").cast("long")).alias("_mix_all"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"{c}_unit")) for c in unit]
    turn = F.row_number().over(Window.partitionBy(*unit).orderBy(F.xxhash64(*map(F.col, kept))))
    each = F.expr("_mix_all div _mix_rows_unit") + F.when(F.col("_mix_turn") <= F.col("_mix_all") % F.col("_mix_rows_unit"), 1).otherwise(0)
    return (
        sized.withColumn("_mix_turn", turn)
        .join(counts, same[0] & same[1] & same[2], "left")
        .join(targets, of_source, "left")
        .select(
            *kept,
            F.col("_mix_size").alias("size"),
            "source_size",
            "target",
            F.coalesce(each, F.lit(0)).cast("long").alias("copies"),
        )
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: every row as often as it is taken."""
    return (
        mixed.filter(F.col("copies") > 0)
        .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select(*columns)
    )
