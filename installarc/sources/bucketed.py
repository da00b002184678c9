"""Events and spans stored in the same buckets, so matching them shuffles nothing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from installarc.operators.timeline import interval_join
from installarc.sources.tables import Staging

_S = "_span_"


@dataclass(frozen=True)
class BucketedPair:
    """The catalog tables of one pair: bucketed ones, and beside them the rows of keys that are too large for one bucket."""

    name: str
    keys: tuple[str, ...]
    time: str
    start: str
    end: str

    def table(self, part: str) -> str:
        """The table of ``events``, ``spans``, ``heavy_events`` or ``heavy_spans``."""
        return f"{self.name}_{part}"

    def drop(self, spark: SparkSession) -> None:
        """Forgets the tables; their files are those of the run's folder."""
        for part in ("events", "spans", "heavy_events", "heavy_spans"):
            spark.sql(f"DROP TABLE IF EXISTS {self.table(part)}")


def _known(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def write_pair(
    events: DataFrame,
    spans: DataFrame,
    name: str,
    keys: Sequence[str],
    time: str,
    start: str,
    end: str,
    buckets: int,
    stage: Staging,
    max_events: int = 1_000_000,
    max_spans: int = 100,
) -> BucketedPair:
    """Stores both tables bucketed by ``keys`` and sorted by key and time, one file for each bucket.

    ``buckets`` belongs to the table: about one for each 256 MB of events. A key with more than ``max_events`` events or
    ``max_spans`` spans, which would be one task's, goes to a plain table beside each. Rows with a NULL key or time match
    nothing and are left out. The tables are as durable as the session's catalog; their files lie in the folder of ``stage``.
    """
    pair = BucketedPair(name, tuple(keys), time, start, end)
    sides = {"events": (events.filter(_known([*keys, time])), time), "spans": (spans.filter(_known([*keys, start])), start)}
    sizes = [
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
        for (df, _), most in zip(sides.values(), (max_events, max_spans), strict=True)
    ]
    heavy = stage(sizes[0].select(*keys).union(sizes[1].select(*keys)).distinct())
    for part, (df, at) in sides.items():
        light = df.join(heavy, list(keys), "left_anti").select(*df.columns).repartition(buckets, *keys).sortWithinPartitions(*keys, at)
        light.write.bucketBy(buckets, *keys).sortBy(*keys, at).option("path", stage.folder()).saveAsTable(pair.table(part))
        rest = df.join(heavy, list(keys), "left_semi").select(*df.columns)
        rest.write.option("path", stage.folder()).saveAsTable(pair.table(f"heavy_{part}"))
    return pair


def match_pair(spark: SparkSession, pair: BucketedPair, payload: Sequence[str]) -> DataFrame:
    """Inner match of each event to the half-open span that holds it: the events' columns and ``payload``.

    As in :func:`interval_join`, spans of a key do not overlap and a NULL end is open. Bucket meets bucket in one merge join without
    an exchange; within a key it compares at most the pair's ``max_spans`` spans with each event. Keys beside the buckets
    are matched by (key, hour) groups.
    """
    events, spans = spark.table(pair.table("events")), spark.table(pair.table("spans"))
    wanted = dict.fromkeys([*pair.keys, pair.start, pair.end, *payload])
    held = spans.select(*[F.col(c).alias(_S + c) for c in wanted])
    at, start, end = F.col(pair.time), F.col(_S + pair.start), F.col(_S + pair.end)
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(_S + k) for k in pair.keys])
    near = events.join(held.hint("merge"), same & (start <= at) & (end.isNull() | (at < end)))
    near = near.select(*events.columns, *[F.col(_S + c).alias(c) for c in payload])
    heavy = (spark.table(pair.table(f"heavy_{part}")) for part in ("events", "spans"))
    far = interval_join(*heavy, list(pair.keys), pair.time, pair.start, pair.end, payload)
    return near.unionByName(far.select(*near.columns))
