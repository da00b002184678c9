"""Connected components of a graph of long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from installarc.sources.tables import Staging


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them; ``b`` < ``a`` in all edges."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def components(edges: DataFrame, stage: Staging) -> DataFrame:
    """(node, label) of every node of the edges (a, b); the label is the smallest node it is connected with.

    Alternates large-star and small-star steps until each component is a star. A step is written to
    the shared folder, so lineage stays short; the number of rounds grows with the logarithm of a
    component's width. Self loops say nothing and don't count.
    """
    pair = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    now = stage(edges.filter(F.col("a") != F.col("b")).select(*pair).distinct())
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = stage(_small_star(_large_star(now).distinct()))
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())
