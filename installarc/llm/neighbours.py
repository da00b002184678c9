"""Approximate nearest neighbours with randomly rotated one-bit codes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from installarc.llm.common import groups_of, stage_for

NEAR = "query_id long, class long, score double"


def rotation(width: int, seed: int = 3) -> np.ndarray:
    """A random rotation, the same for every index and query."""
    q, r = np.linalg.qr(np.random.default_rng([seed, width]).normal(size=(width, width)))
    return q * np.sign(np.diag(r))


class Codes:
    """One-bit codes of unit vectors: the signs of the rotated vector, packed, and its length along them.

    With o rotated and s its signs / sqrt(width), ``fit`` is <o, s>. For a unit query q,
    <q, s> / fit estimates <q, o>, and the error is at most ``spread`` = sqrt(1 / fit^2 - 1) / sqrt(width - 1) times a
    standard deviation count, save with a chance that falls off as that of a normal variable.
    """

    def __init__(self, units: np.ndarray, turn: np.ndarray) -> None:
        turned = units @ turn
        width = turned.shape[1]
        self.width = width
        self.bits = np.packbits(turned > 0, axis=1)
        self.fit = np.abs(turned).sum(axis=1) / np.sqrt(width)
        self.spread = np.sqrt(np.maximum(1.0 / self.fit**2 - 1.0, 0.0)) / np.sqrt(max(width - 1, 1))

    def estimate(self, queries: np.ndarray, turn: np.ndarray) -> np.ndarray:
        """Estimated inner products, queries x codes: a table of sums for each byte of the code."""
        turned = queries @ turn
        padded = np.zeros((len(turned), self.bits.shape[1] * 8))
        padded[:, : self.width] = turned
        signs = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) * 2.0 - 1.0
        out = np.zeros((len(turned), len(self.bits)))
        for byte in range(self.bits.shape[1]):
            table = padded[:, 8 * byte : 8 * byte + 8] @ signs.T
            out += table[:, self.bits[:, byte]]
        return out / np.sqrt(self.width) / self.fit


def scaled(rows: np.ndarray) -> np.ndarray:
    """Each row times the power of two that brings its largest component near 1.

    That is exact and changes no cosine, but squares of very large or very small components would be infinite or 0 without it.
    """
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.add.accumulate(rows * rows, axis=1)[:, -1])


def cosines(query: np.ndarray, rows: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Cosine in double precision on the vectors as they are, summed from the first component to the last."""
    return np.add.accumulate(rows * query, axis=1)[:, -1] / (length * lengths(query[None])[0])


def nearest_in_block(queries: np.ndarray, rows: np.ndarray, k: int, deviations: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the rows that can be among its ``k`` nearest, with exact cosines.

    Every row whose upper bound reaches the k-th largest lower bound is compared exactly. Of
    those the k best stay, with all that tie with the k-th.
    """
    turn = rotation(rows.shape[1])
    codes = Codes(rows / np.linalg.norm(rows, axis=1, keepdims=True), turn)
    slack, length = deviations * codes.spread, lengths(rows)
    out = []
    for at in range(0, len(queries), 64):
        some = queries[at : at + 64]
        guess = codes.estimate(some / np.linalg.norm(some, axis=1, keepdims=True), turn)
        for query, near in zip(some, guess, strict=True):
            low = near - slack
            floor = np.partition(low, -k)[-k] if len(low) > k else -np.inf
            chosen = np.flatnonzero(near + slack >= floor)
            exact = cosines(query, rows[chosen], length[chosen])
            last = np.partition(exact, -k)[-k] if len(exact) > k else -np.inf
            keep = exact >= last
            out.append((chosen[keep], exact[keep]))
    return out


def usable(vector: Column) -> Column:
    """Whether a vector can be compared: not NULL, no NULL, NaN or infinite component, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    deviations: float = 3.0,
    block_rows: int = 8_192,
    block_queries: int = 8_192,
) -> DataFrame:
    """The ``k`` nearest rows (largest cosine) of every query row: query_id, rank, vec_id, score.

    Equal vectors form a class that is indexed once, with its k + 1 smallest ids: ties go to smaller
    ids, so no other member can be in a result. Classes and queries are dealt to blocks; a task
    compares one block of one-bit codes with one block of queries, compares what the error bounds leave
    exactly and keeps each query's best. The blocks' results are merged by query.

    Each row but the query's own is a candidate; a query with fewer candidates gets all. Vectors that are NULL,
    zero or hold a NULL or non-finite component take no part, nor do rows without id; only vectors of one width
    are compared, however large or small their finite components are. Rows that repeat an id and its vector count once. An empty table gives an empty result.
    Other columns are ignored.
    """
    stage = stage_for(vectors)
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("asks")
    ).filter(F.col("id").isNotNull() & usable(F.col("v")))
    by_vector = Window.partitionBy("v").orderBy("id")
    # -0.0 and 0.0 are one number
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    numbered = stage(rows.groupBy("id", "v").agg(F.max("asks").alias("asks")))
    members = stage(
        numbered.select("id", "v")
        .withColumn("nth", F.row_number().over(by_vector))
        .filter(F.col("nth") <= k + 1)
        .groupBy("v")
        .agg(F.min("id").alias("class"), F.array_sort(F.collect_list("id")).alias("ids"))
    )
    queries = numbered.filter("asks")
    row_blocks, query_blocks = groups_of(members.count(), block_rows), groups_of(queries.count(), block_queries)

    def block(key: str, blocks: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    left = members.select("class", "v", F.size("v").alias("width"), block("class", row_blocks).alias("r"), every(query_blocks).alias("q"))
    right = queries.select("id", "v", F.size("v").alias("width"), block("id", query_blocks).alias("q"), every(row_blocks).alias("r"))
    cell = ["width", "r", "q"]

    def compare(indexed: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if indexed.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "class": [], "score": []})
        found = nearest_in_block(scaled(np.stack(asked["v"])), scaled(np.stack(indexed["v"])), k + 1, deviations)
        classes = indexed["class"].to_numpy()
        return pd.DataFrame(
            {
                "query_id": np.repeat(asked["id"].to_numpy(), [len(at) for at, _ in found]),
                "class": np.concatenate([classes[at] for at, _ in found]),
                "score": np.concatenate([score for _, score in found]),
            }
        )

    near = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(compare, NEAR)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        near.join(members.select("class", "ids"), "class")
        .select("query_id", "score", F.explode("ids").alias("vec_id"))
        .filter(F.col("vec_id") != F.col("query_id"))
        .distinct()
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
