"""Near duplicates: HyperMinHash registers, banding, and exact confirmation on whole shingle sets."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from installarc.llm.common import content_key, stage_for
from installarc.llm.components import components
from installarc.sources.tables import Staging

WORD_BYTES = b"[^\\x20\\x09-\\x0d]+"
KEY = "struct<id:string,a:bigint,b:int>"

REGISTERS, BAND = 256, 6
MANTISSA = 10
ONE, TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * ONE
    x = (x ^ (x >> np.uint64(29))) * TWO
    return x ^ (x >> np.uint64(32))


def shingle_sets(bodies: list[bytes | None], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles of ``words`` words.

    A-Z count as lower case. A text of fewer words is one shingle; NULL and texts without words give none.
    """
    find, number = re.compile(WORD_BYTES).findall, {}
    tokens = []
    for body in bodies:
        found = find(body.lower()) if body else []
        tokens.append(np.fromiter((number.setdefault(w, len(number)) for w in found), np.int64, len(found)))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
    out = []
    for ids in tokens:
        if not len(ids):
            out.append(np.zeros(0, np.uint64))
            continue
        h = hashes[ids]
        width = min(words, len(h))
        state = np.full(len(h) - width + 1, width, np.uint64)
        for k in range(width):
            state = mixed(state + h[k : len(h) - width + 1 + k])
        out.append(np.unique(state))
    return out


def _probes() -> np.ndarray:
    """For each register the order in which it looks for a filled one; itself first."""
    rng = np.random.default_rng(17)
    rank = np.argsort(rng.random((REGISTERS, REGISTERS)), axis=1).astype(np.int16)
    rank[np.arange(REGISTERS), np.arange(REGISTERS)] = -1
    return rank


def registers(shingles: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of one set: 6 bits of leading zeros and ``MANTISSA`` bits behind the first one.

    A shingle falls in one register by its hash, which keeps the smallest of the remaining bits in
    that short form. A register without shingle repeats the first filled one in its own
    fixed order, so small sets can be compared like large ones.
    """
    h = mixed(shingles)
    at = (h >> np.uint64(56)).astype(np.int64)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, at, h << np.uint64(8))
    filled = np.zeros(REGISTERS, bool)
    filled[at] = True
    if not filled.all():
        empty, there = np.flatnonzero(~filled), np.flatnonzero(filled)
        least[empty] = least[there[probes[np.ix_(empty, there)].argmin(axis=1)]]
    top = np.floor(np.log2(np.maximum(least >> np.uint64(11), np.uint64(1)).astype(np.float64))).astype(np.int64)
    zeros = 52 - top
    bits = (least >> np.uint64(11)) << (np.uint64(52) - top.astype(np.uint64))
    mantissa = (bits >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    return (zeros.astype(np.uint64) << np.uint64(MANTISSA) | mantissa).astype(np.uint16)


def chance_match(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Chance that registers of different minima agree, for set sizes a and b.

    The minima are about exponential with rates in proportion to the sizes; the sum over all register values of
    both chances is then ln 2 * ab / (a + b)^2 / 2^MANTISSA.
    """
    return np.log(2.0) * a * b / (a + b) ** 2.0 / (1 << MANTISSA)


def _sketch(docs: DataFrame, words: int, doc_id: str, text: str) -> DataFrame:
    """(doc, key, n, h1, h2, sketch) of every row: size and 128-bit hash of its shingle set, and its registers."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = _probes()
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                sets = shingle_sets(batch["body"].to_pylist(), words)
                one = [int(s.sum(dtype=np.uint64)) for s in sets]
                two = [int(mixed(s + TWO).sum(dtype=np.uint64)) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc"],
                        batch["key"],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.array(one, np.uint64).view(np.int64)),
                        pa.array(np.array(two, np.uint64).view(np.int64)),
                        pa.array([registers(s, probes).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["doc", "key", "n", "h1", "h2", "sketch"],
                )

    kind = docs.schema[doc_id].dataType
    kind = T.LongType() if isinstance(kind, T.IntegralType) else kind
    rows = docs.select(
        F.col(doc_id).cast(kind).alias("doc"),
        content_key(F.col(doc_id), F.col(text)).cast(KEY).alias("key"),
        F.col(text).cast("binary").alias("body"),
    )
    return rows.mapInArrow(sketch, f"doc {kind.simpleString()}, key {KEY}, n long, h1 long, h2 long, sketch binary")


@F.pandas_udf(T.ArrayType(T.LongType()))
def band_keys(sketches: pd.Series) -> pd.Series:
    """A hash for each ``BAND`` registers, with the number of the band in it."""
    bands = REGISTERS // BAND
    regs = np.frombuffer(b"".join(sketches), np.uint16).reshape(-1, REGISTERS)[:, : bands * BAND]
    regs = regs.reshape(len(regs), bands, BAND).astype(np.uint64)
    state = np.broadcast_to(np.arange(bands, dtype=np.uint64), regs.shape[:2])
    for k in range(BAND):
        state = mixed(state * np.uint64(65_599) + regs[:, :, k])
    return pd.Series(list(state.view(np.int64)))


def _candidates(classes: DataFrame) -> DataFrame:
    """Edges of a graph in which all that share a band are connected: each to the first of the band."""
    keys = classes.select("node", F.explode(band_keys("sketch")).alias("band"))
    firsts = keys.groupBy("band").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return keys.join(firsts.drop("n"), "band").filter(F.col("node") != F.col("b")).select(F.col("node").alias("a"), "b").distinct()


def _pieces(members: DataFrame, stage: Staging, similarity: float, nodes: int, shingles: int) -> DataFrame:
    """Cuts each candidate group (``label``) into pieces (``level``, ``part``) of bounded numbers of nodes and shingles.

    A small group is one piece. A larger one is cut by set size into levels, so that only sets of one
    level or of neighbouring levels can be similar enough, and each level by hash into parts.
    """
    load = [F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("shingles")]
    need = F.greatest(F.ceil(F.col("nodes") / nodes), F.ceil(F.col("shingles") / shingles))
    whole = members.groupBy("label").agg(*load).select("label", (need > 1).alias("large"))
    level = F.when(F.col("large"), F.floor(F.log(F.col("n")) / -np.log(similarity - 1e-9))).otherwise(0)
    leveled = stage(members.join(whole, "label").withColumn("level", level.cast("int")).drop("large"))
    parts = leveled.groupBy("label", "level").agg(*load).select("label", "level", need.alias("parts"))
    return leveled.join(parts, ["label", "level"]).withColumn(
        "part", F.pmod(F.hash("node", F.lit(9)), F.col("parts")).cast("int")
    )


class Links:
    """Union-find over the rows of one task."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i


def linked(
    sets: list[np.ndarray], sketches: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int, slack: float
) -> list[tuple[int, int]]:
    """A spanning forest of the true links between rows of ``left`` and ``right``.

    The corrected estimate from the registers drops pairs that are more than ``slack`` short; the others are
    confirmed on their whole sets unless a chain of confirmed links joins them already.
    """
    size = np.array([len(s) for s in sets], np.int64)
    _, shared = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(shared)
    bounds = np.concatenate([[0], np.cumsum(size)])
    # shingles of one set only can't be in an intersection
    ids = [s[often[s] > 1] for s in (shared[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True))]
    mark = np.zeros(len(often), bool)
    links, out = Links(len(sets)), []
    for i in left:
        others = right[right > i] if left is right else right
        small, large = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
        others = others[100 * small >= percent * large]
        if not len(others):
            continue
        agree = (sketches[others] == sketches[i]).mean(axis=1)
        by_chance = chance_match(size[others].astype(float), float(size[i]))
        guess = (agree - by_chance) / (1.0 - by_chance)
        order = np.argsort(-guess, kind="stable")
        mark[ids[i]] = True
        for j in others[order[guess[order] >= percent / 100.0 - slack]]:
            a, b = links.root(i), links.root(j)
            if a == b:
                continue
            both = int(np.count_nonzero(mark[ids[j]]))
            if 100 * both >= percent * (size[i] + size[j] - both):
                links.up[max(a, b)] = min(a, b)
                out.append((i, j))
        mark[ids[i]] = False
    return out


def _confirm(docs: DataFrame, pieces: DataFrame, words: int, percent: int, slack: float, text: str, doc_id: str) -> DataFrame:
    """True links (a, b) that connect all that is connected within each candidate group."""
    piece = ["label", "level", "part"]
    cells = pieces.select(*piece).distinct()
    other = cells.select("label", F.col("level").alias("level2"), F.col("part").alias("part2"))
    cells = cells.join(other, "label").filter(
        ((F.col("level") == F.col("level2")) & (F.col("part") <= F.col("part2"))) | (F.col("level") + 1 == F.col("level2"))
    )
    sides = cells.withColumn("side", F.lit(0)).withColumn("at", F.struct("level", "part")).unionByName(
        cells.filter((F.col("level") != F.col("level2")) | (F.col("part") != F.col("part2")))
        .withColumn("side", F.lit(1))
        .withColumn("at", F.struct(F.col("level2").alias("level"), F.col("part2").alias("part")))
    )
    bodies = docs.select(
        content_key(F.col(doc_id), F.col(text)).cast(KEY).alias("key"), F.col(text).cast("binary").alias("body")
    )
    rows = (
        bodies.join(pieces.select("key", "node", "sketch", "label", F.struct("level", "part").alias("at")), "key")
        .join(sides, ["label", "at"])
        .select("label", "level", "part", "level2", "part2", "side", "node", "sketch", "body")
    )

    def confirm(table: pa.Table) -> pa.Table:
        node, first = np.unique(table["node"].to_numpy(), return_index=True)  # repeated rows bring a text again
        table = table.take(first)
        sketches = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
        side = table["side"].to_numpy()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        sets = shingle_sets(table["body"].to_pylist(), words)
        found = linked(sets, sketches, left, right if len(right) else left, percent, slack)
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": node[pairs[:, 0]], "b": node[pairs[:, 1]]})

    return rows.groupBy("label", "level", "part", "level2", "part2").applyInArrow(confirm, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    doc_id: str = "doc_id",
    text: str = "text",
    slack: float = 0.2,
    piece_nodes: int = 1_000,
    piece_shingles: int = 500_000,
) -> DataFrame:
    """One row per document: ``doc``, ``key``, ``n_shingles``, ``component``, ``component_id`` and ``kept``.

    Two documents are linked if their sets of ``words``-word shingles have at least ``percent`` % in common
    (intersection of union). ``component_id`` is the smallest id that links lead to; the document with it is kept.
    ``component`` numbers the components by themselves (NULL without shingles).

    Equal sets are one class from the start. Classes that agree in a band of HyperMinHash registers form candidate groups; no
    pairs are made, each class is only tied to the first of its band. Within a candidate group every
    pair whose sizes and corrected register estimate allow it is compared on whole sets, in cells
    of bounded pieces, until all that is linked is connected. A link is lost only if no band agrees: with
    42 bands of 6 registers that has a chance of 2e-9 at 85 % and 3e-6 at 80 %.

    NULL or empty texts, and those of blanks only, have no shingles and no links. A NULL id is no component's
    name unless there is no other; such rows are kept only then. Repeated rows share a component and are kept or not
    alike. An empty table gives an empty result. Other columns are ignored. Ids keep their type, whole numbers as long; text
    ids are ordered as text. A very long text is one row of a task, read whole.
    """
    stage = stage_for(docs)
    sketched = stage(_sketch(docs, words, doc_id, text))
    same = ["h1", "h2", "n"]
    classes = stage(
        sketched.filter(F.col("n") > 0)
        .groupBy(*same)
        .agg(F.min("key").alias("key"), F.min("doc").alias("least"), F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    grouped = components(_candidates(classes), stage)
    members = classes.select("node", "key", "n", "sketch").join(grouped, "node")
    pieces = stage(_pieces(members, stage, percent / 100.0, piece_nodes, piece_shingles))
    links = stage(_confirm(docs, pieces, words, percent, slack, text, doc_id))
    joined = components(links, stage)
    named = classes.select(*same, "node", "least").join(joined, "node", "left").withColumn("label", F.coalesce("label", "node"))
    names = named.groupBy("label").agg(F.min("least").alias("least_id"))
    found = named.join(names, "label").select(*same, F.col("label").alias("component"), "least_id")
    return (
        sketched.select("doc", "key", *same)
        .join(found, same, "left")
        .select(
            "doc",
            "key",
            F.col("n").alias("n_shingles"),
            "component",
            F.when(F.col("n") > 0, F.col("least_id")).otherwise(F.col("doc")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc").eqNullSafe(F.col("component_id")))
    )


def representatives(found: DataFrame) -> DataFrame:
    """Keys of the documents that stay: the one with the smallest id of each component, all without shingles."""
    order = F.struct(F.col("doc").isNull(), "doc", "key")
    grouped = found.filter(F.col("component").isNotNull()).groupBy("component").agg(F.min_by("key", order).alias("key"))
    return grouped.select("key").unionByName(found.filter(F.col("component").isNull()).select("key"))
