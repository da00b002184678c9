"""Country blocks of payloads whose shape isn't known: found by their name wherever they lie."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The names of the blocks in campaign payloads, and what one of their values is called.
BLOCKS = {"country_code_to_goal_value": "goal", "country_code_to_daily_budget": "budget"}


def parsed(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds ``value``, the payload as a variant, and ``broken`` (1 where there is text that is no JSON). Columns called like these are replaced."""
    value = F.try_parse_json(F.col(payload))
    return df.withColumns({"value": value, "broken": (F.col(payload).isNotNull() & value.isNull()).cast("int")})


def broken_payloads(df: DataFrame, keys: Sequence[str], payload: str = "payload") -> DataFrame:
    """Rows and broken payloads of each group of ``keys``."""
    return parsed(df, payload).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_count"), F.sum("broken").alias("broken_count"))


def named_blocks(
    df: DataFrame, keys: Sequence[str], payload: str = "payload", blocks: Mapping[str, str] = BLOCKS, depth: int = 6
) -> DataFrame:
    """(keys, kind, country_code, amount): every entry of the objects called like a block, down to ``depth`` levels.

    Objects and lists are opened a level at a time, each by one generator inside the same stage, so nothing is shuffled. An
    amount may be a number or a number as text; anything else is NULL. Blocks inside a block's entries are not looked
    for. Broken and NULL payloads give no rows; ``broken_payloads`` counts them.
    """
    spark = df.sparkSession
    now = parsed(df, payload).filter("value is not null").select(*keys, F.lit(None).cast("string").alias("name"), "value")
    listed = ", ".join(f"`{k}`" for k in keys)
    found = []
    for _ in range(depth):
        # what isn't an object or a list opens to nothing
        now = spark.sql(f"SELECT {listed}, t.key AS name, t.value AS value FROM {{now}}, LATERAL variant_explode(value) AS t", now=now)
        found.append(now.filter(F.col("name").isin(*blocks)))
        now = now.filter(~F.coalesce(F.col("name").isin(*blocks), F.lit(False)))
    hits = reduce(DataFrame.unionByName, found)
    entries = spark.sql(f"SELECT {listed}, name, t.key AS country_code, t.value AS value FROM {{hits}}, LATERAL variant_explode(value) AS t", hits=hits)
    kind = F.coalesce(*[F.when(F.col("name") == name, kind) for name, kind in blocks.items()])
    return entries.select(*keys, kind.alias("kind"), "country_code", F.try_variant_get("value", "$", "double").alias("amount"))
