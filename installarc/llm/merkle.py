"""Merkle manifest of a dataset: a tree for each group of rows, a tree over the groups, and a proof for every row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from installarc.llm.common import numbered, stage_for
from installarc.sources.tables import Staging

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: Column) -> Column:
    """Lower-case hex SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(parts.cast("binary"), 256)


def leaf_of(values: Sequence[Column]) -> Column:
    """Hash of a row: of each value its byte count, a colon and the value, or ``-`` for NULL, so no two rows read alike."""
    texts = [v.cast("string") for v in values]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def _group_key(group: Column) -> Column:
    """Never NULL, and in the order of the group's bytes with NULL first."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


class Forest(NamedTuple):
    """Trees over nodes: ``levels[k]`` has the parents of level k with their children in ``fanout`` slots; ``tops`` the top of each tree."""

    levels: list[DataFrame]
    tops: DataFrame


def grow(nodes: DataFrame, fanout: int, stage: Staging) -> Forest:
    """Trees over ``nodes`` (tree, idx, n, node: a struct with ``hash``), where ``n`` nodes of a tree are numbered by ``idx``.

    A parent's children are spread into slots by conditional aggregates, and the slots one behind another are hashed.
    Each level is written, and is a ``fanout``-th of the one below. The number of levels follows from the largest tree.
    """
    slots = [f"c{s}" for s in range(fanout)]
    levels: list[DataFrame] = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    tops = [nodes.filter("n = 1").select("tree", F.lit(0).alias("height"), F.col("node.hash").alias("hash"))]
    while most > 1:
        spread = [F.max(F.when(F.col("idx") % fanout == s, F.col("node"))).alias(c) for s, c in enumerate(slots)]
        parents = (
            nodes.filter("n > 1")
            .groupBy("tree", F.floor(F.col("idx") / fanout).alias("idx"))
            .agg(F.ceil(F.first("n") / fanout).alias("n"), *spread)
        )
        parents = stage(parents.withColumn("hash", digest(F.concat_ws("", *[F.col(f"{c}.hash") for c in slots]))))
        levels.append(parents)
        tops.append(parents.filter("n = 1").select("tree", F.lit(len(levels)).alias("height"), "hash"))
        nodes = parents.select("tree", "idx", "n", F.struct("hash").alias("node"))
        most = -(-most // fanout)
    return Forest(levels, stage(reduce(DataFrame.unionByName, tops)))


def descend(forest: Forest, above: DataFrame, fanout: int, carried: Sequence[str]) -> DataFrame:
    """Paths from the tops down to the nodes: (tree, node, path, ``carried``) of every node that has a parent.

    ``above`` has (tree, height, path) and the carried columns of each tree. A node's path lists from itself to the
    end of ``above``'s path what stands left and right of it in its parent: the slots without its own.
    """
    slots = [f"c{s}" for s in range(fanout)]

    def starts(height: int) -> DataFrame:
        return above.filter(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("idx"), "path", *carried)

    paths = starts(len(forest.levels))
    for k in reversed(range(len(forest.levels))):
        children = [
            F.when(
                F.col(own).isNotNull(),
                F.struct(
                    (F.col("idx") * fanout + s).alias("idx"),
                    F.col(own).alias("node"),
                    F.struct(
                        F.concat_ws("", *[F.col(f"{c}.hash") for c in slots[:s]]).alias("left"),
                        F.concat_ws("", *[F.col(f"{c}.hash") for c in slots[s + 1 :]]).alias("right"),
                    ).alias("step"),
                ),
            )
            for s, own in enumerate(slots)
        ]
        below = (
            forest.levels[k]
            .drop("hash", "n")
            .join(paths, ["tree", "idx"])
            .select("tree", "path", *carried, F.explode(F.array_compact(F.array(*children))).alias("child"))
            .select("tree", "child.idx", "child.node", F.concat(F.array("child.step"), "path").alias("path"), *carried)
        )
        paths = starts(k).unionByName(below.drop("node")) if k else below
    return paths


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf's hash and the siblings of its path lead to."""
    return F.aggregate(path, leaf, lambda h, step: digest(F.concat(step["left"], h, step["right"])))


def proof(path: Column) -> Column:
    """All siblings of a path, from the leaf's to the root's."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "source",
    order: str = "doc_id",
    fanout: int = 3,
    found: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Every row as a leaf with its place in the manifest: (order, leaf, found_leaf, subroot, root, path).

    A leaf is the hash of ``fields``. Leaves of a group stand by ``order`` and are hashed in runs of ``fanout`` until
    one node, the group's subroot, remains; a lone leaf is the subroot itself. Subroots in order of the group lead to
    ``root`` likewise. ``path`` lists the siblings ({left, right}) from the leaf to the root; ``folded`` walks it.
    ``found`` has columns as they are read back later; ``found_leaf`` is the leaf they give, to be held against the root.

    Slot pivot: conditional aggregates put the children of a parent side by side, all of them make its hash, and those
    without a node's own slot are its siblings. Places come from one range sort, so a group with most of the rows is
    spread over all tasks. Only hashes are kept of a text, however long it is. Rows of one group with the same value
    in ``order`` stand by their leaf's hash, NULL first; a repeated row is a leaf of its own, with a path of its own.
    NULL is a group of its own, before all others; an empty text isn't NULL. An empty table gives no rows. Other
    columns are ignored.
    """
    stage = stage_for(docs)
    seen = [(found or {}).get(c, F.col(c)) for c in fields]
    leaves = stage(
        docs.select(
            _group_key(F.col(group)).alias("tree"),
            F.col(order).alias("id"),
            leaf_of([F.col(c) for c in fields]).alias("hash"),
            leaf_of(seen).alias("found"),
        )
    )
    sizes = leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    placed = numbered(leaves, "tree", ["id", "hash"], stage, "idx").join(sizes, "tree")
    nodes = placed.select("tree", "idx", "n", F.struct("hash", "found", "id").alias("node"))
    forest = grow(stage(nodes), fanout, stage)

    tops = forest.tops.select(F.lit("").alias("all"), F.col("tree").alias("of"), "height", "hash")
    n_trees = tops.count()
    over = numbered(tops, "all", ["of"], stage, "idx").select(
        F.col("all").alias("tree"), "idx", F.lit(n_trees).alias("n"), F.struct("hash", "of", "height").alias("node")
    )
    crown = grow(stage(over), fanout, stage)
    no_steps = F.array().cast("array<struct<left:string,right:string>>").alias("path")
    peak = crown.tops.select("tree", "height", F.col("hash").alias("root"), no_steps)
    if n_trees > 1:
        to_root = descend(crown, peak, fanout, ["root"])
    else:  # the only subroot is the root
        to_root = over.join(peak.drop("height"), "tree")
    carried = ["subroot", "root"]
    above = stage(
        to_root.select(
            F.col("node.of").alias("tree"), F.col("node.height").alias("height"), F.col("node.hash").alias("subroot"), "root", "path"
        )
    )
    alone = nodes.filter("n = 1").join(above.drop("height"), "tree").select("tree", "node", "path", *carried)
    rows = descend(forest, above, fanout, carried).select("tree", "node", "path", *carried) if forest.levels else None
    both = alone if rows is None else rows.unionByName(alone)
    return both.select(
        F.col("node.id").alias(order), F.col("node.hash").alias("leaf"), F.col("node.found").alias("found_leaf"), *carried, "path"
    )
