"""Profiles of all columns of a table from sketches that are stored for each day and united later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: Distinct counts are right within 5 % (three standard errors of a sketch of 2**12 registers), ranks of quantiles within 2 %.
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.02
LOG_REGISTERS = 12


def column_sketches(df: DataFrame, table: str, day: Column | None = None) -> DataFrame:
    """(table_name, column_name, day, rows_count, null_count, distinct_sketch, value_sketch) for every column, in one pass.

    Values are told apart by their text. ``value_sketch`` is there for numbers, without NaN. Without ``day`` it is NULL; so
    it is for rows without one. An empty table has no rows. Sketches are a few KB whatever the table holds, and merge before the shuffle.
    """
    dated = df.withColumn("_sketch_day", (day if day is not None else F.lit(None)).cast("date"))
    parts, columns = [F.count(F.lit(1)).alias("_rows")], []
    for i, field in enumerate(df.schema):
        value = F.col(f"`{field.name}`")
        number = isinstance(field.dataType, NumericType)
        text = F.to_json(F.struct(value)) if field.dataType.typeName() in ("array", "map", "struct") else value.cast("string")
        parts += [F.count(value).alias(f"_n{i}"), F.hll_sketch_agg(text, LOG_REGISTERS).alias(f"_d{i}")]
        if number:
            real = value.cast("double")
            parts.append(F.kll_sketch_agg_double(F.when(~F.isnan(real), real)).alias(f"_q{i}"))
        columns.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                (F.col("_rows") - F.col(f"_n{i}")).alias("null_count"),
                F.col(f"_d{i}").alias("distinct_sketch"),
                (F.col(f"_q{i}") if number else F.lit(None).cast("binary")).alias("value_sketch"),
            )
        )
    rolled = dated.groupBy(F.col("_sketch_day").alias("day")).agg(*parts)
    one = rolled.select("day", F.col("_rows").alias("rows_count"), F.explode(F.array(*columns)).alias("_one"))
    return one.select(F.lit(table).alias("table_name"), "_one.column_name", "day", "rows_count", "_one.null_count", "_one.distinct_sketch", "_one.value_sketch")


def united(sketches: DataFrame, by: Sequence[str] = ("table_name", "column_name"), quantiles: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """Rows, NULLs, distinct values and quantiles of each column over any days of stored sketches; the data isn't read again."""
    found = sketches.groupBy(*by).agg(
        F.sum("rows_count").alias("rows_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_estimate"),
        F.kll_merge_agg_double("value_sketch").alias("_values"),
        F.count("value_sketch").alias("_sketches"),
    )
    held = F.when((F.col("_sketches") > 0) & (F.kll_sketch_get_n_double("_values") > 0), F.col("_values"))
    names = {q: f"q{round(q * 100):02d}" for q in quantiles}
    return found.select(
        *by, "rows_count", "null_count", "distinct_estimate", *[F.kll_sketch_get_quantile_double(held, F.lit(q)).alias(n) for q, n in names.items()]
    )


def within_error(profile: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """The profile's counts, and whether its estimates are within the stated errors of exact ones, column by column.

    For checking: it counts every table again, exactly.
    """
    quantiles = [c for c in profile.columns if c.startswith("q") and c[1:].isdigit()]
    known = {(r["table_name"], r["column_name"]): r for r in profile.collect()}  # a row for each column
    out = None
    for name, df in tables.items():
        parts, columns = [], []
        for i, c in enumerate(df.columns):
            row, value = known[(name, c)], F.col(f"`{c}`")
            parts.append(F.count_distinct(value.cast("string")).alias(f"_d{i}"))
            close = [F.abs(F.col(f"_d{i}") - row["distinct_estimate"]) <= F.greatest(F.lit(1), F.col(f"_d{i}") * DISTINCT_ERROR)]
            for q in quantiles if row[quantiles[0]] is not None else []:
                parts += [F.avg((value <= row[q]).cast("int")).alias(f"_{q}_{i}"), F.avg((value < row[q]).cast("int")).alias(f"_l{q}_{i}")]
                share = int(q[1:]) / 100
                close.append((F.col(f"_{q}_{i}") >= share - RANK_ERROR) & (F.col(f"_l{q}_{i}") <= share + RANK_ERROR))
            counts = [F.lit(row[k]).cast("long").alias(k) for k in ("rows_count", "null_count")]
            columns.append(F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), *counts, F.forall(F.array(*close), lambda x: x).alias("within_error")))
        one = df.agg(*parts).select(F.inline(F.array(*columns)))
        out = one if out is None else out.unionByName(one)
    return out
