"""Lookups against dimensions.

No join here is forced to broadcast. A dimension is planned as a broadcast only when
Spark's own size check (``autoBroadcastJoinThreshold``, measured again at run time by
adaptive execution) finds it small; otherwise the join is shuffled and hot keys are
split by the skew rule.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from installarc.operators.overlap import overlap_join
from installarc.operators.shape import one_per_key
from installarc.operators.timeline import asof_join
from installarc.sources.tables import as_is


def rate_lookup(
    facts: DataFrame,
    rates: DataFrame,
    currency: str,
    day: Column,
    name: str = "currency_rates_denominator",
    base: str = "USD",
    stage: Callable[[DataFrame], DataFrame] = as_is,
) -> DataFrame:
    """Left lookup of the rate against ``base`` valid on a fact's day; NULL when there is none.

    Windows are closed; one without end is valid from its start on. Only the currencies and
    days that occur are matched with the windows, one row each. That table is staged, so its
    size is known when the facts are joined to it.
    """
    dated = facts.withColumns({"_rate_of": F.col(currency), "_rate_day": day})
    asked = dated.select("_rate_of", "_rate_day").filter("_rate_of is not null and _rate_day is not null").distinct()
    windows = rates.filter(F.col("base_currency") == base).select(
        F.col("currency").alias("_rate_of"), "valid_from_date", "valid_to_date", F.col("value").alias(name)
    )
    found = asof_join(
        asked, windows, ["_rate_of"], "_rate_day", "valid_from_date", ["valid_to_date", name], chunk="month", how="inner"
    )
    valid = F.col("valid_to_date").isNull() | (F.col("_rate_day") <= F.col("valid_to_date"))
    known = stage(found.filter(valid).drop("valid_to_date"))
    return dated.join(known, ["_rate_of", "_rate_day"], "left").drop("_rate_of", "_rate_day")


def session_match(
    events: DataFrame, sessions: DataFrame, keys: Sequence[str], time: str, carry: Sequence[str] = ()
) -> DataFrame:
    """Adds the session that holds an event, and its columns ``carry``; of several the one that started last.

    The first and the last instant of a session belong to it. Columns of ``events`` called like an added one are
    replaced. A session is placed in two bins at most however long it lasts, so a broken end costs no more than any other.
    """
    return overlap_join(
        events,
        sessions.filter(F.col("session_end").isNotNull()),
        keys,
        time,
        "session_start",
        "session_end",
        ["session_id", *carry],
        keep="latest",
        closed=True,
        how="left",
        tie_break=["session_id", "session_end"],
    )


def attach(facts: DataFrame, dim: DataFrame, on: str | Sequence[str], default: dict | None = None) -> DataFrame:
    """Left lookup in a dimension; ``default`` fills what was not found.

    Of several rows of a key one is used, the largest, so a lookup never multiplies facts.
    """
    keys = [on] if isinstance(on, str) else list(on)
    rest = [c for c in dim.columns if c not in keys]
    out = facts.join(one_per_key(dim, keys, rest), keys, "left")
    return out.fillna(default) if default else out


def flag_matches(facts: DataFrame, keys: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """1 where the key occurs in ``keys`` (copies there do not multiply rows), else 0."""
    known = keys.select(*on).distinct().withColumn(name, F.lit(1))
    return facts.join(known, list(on), "left").withColumn(name, F.coalesce(name, F.lit(0)))


def add_missing(primary: DataFrame, fallback: DataFrame, on: Sequence[str]) -> DataFrame:
    """``primary`` plus the rows of ``fallback`` whose key it lacks."""
    extra = fallback.join(primary.select(*on).distinct(), list(on), "left_anti")
    return primary.unionByName(extra, allowMissingColumns=True)
