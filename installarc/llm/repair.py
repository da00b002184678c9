"""Conversation repair: the cheapest edits that give a dialogue its form, the least of them by prefix-doubled ranks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from installarc.llm.common import numbered, stage_for
from installarc.sources.tables import Staging

BLANKS = " \t\n\x0b\x0c\r"
RUN = 64  # rows of a segment, and children of a node in the tree over segments
FAR = 1 << 50  # the cost of what can't be

# A dialogue's form is (s?(ua)+)?, with states: nothing yet, after s, after u, after a. A row's class is s, u, a, other.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES, S, U, A, OTHER = 4, 0, 1, 2, 3
NEXT = np.full((STATES, 4), -1)
NEXT[START, S] = AFTER_S
NEXT[[START, AFTER_S, AFTER_A], U] = AFTER_U
NEXT[AFTER_U, A] = AFTER_A
DONE = (START, AFTER_A)
#: The one turn that may follow a state, other than s: what an inserted or rerolled turn becomes.
TURN = np.where(NEXT[:, A] >= 0, A, U)
AHEAD = NEXT[np.arange(STATES), TURN]

LETTERS = "DIKR"  # delete, insert, keep, rerole, in ASCII order
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 3, 4, 3, 3
MUST_GO, IS_CUT = 4, 8  # a row's code is its class, and these flags


def row_costs() -> tuple[np.ndarray, np.ndarray]:
    """By code, state and letter: the cost of a row's edit, and the state it leads to. Inserts aren't a row's edit."""
    cost, to = np.full((16, STATES, 4), FAR), np.full((16, STATES, 4), 0)
    for code in range(16):
        kind, gone, extra = code % 4, code & MUST_GO, CUT_SHORT if code & IS_CUT else 0
        for state in range(STATES):
            cost[code, state, 0], to[code, state, 0] = DELETE, state
            if gone:
                continue
            if NEXT[state, kind] >= 0:
                cost[code, state, 2], to[code, state, 2] = KEEP + extra, NEXT[state, kind]
            cost[code, state, 3], to[code, state, 3] = REROLE + extra, AHEAD[state]
    return cost, to


COST, TO = row_costs()


def relaxed(after: np.ndarray) -> np.ndarray:
    """Costs to the end by state (last axis) when turns may be inserted first: at most two help."""
    once = np.minimum(after, INSERT + after[..., AHEAD])
    return np.minimum(once, INSERT + once[..., AHEAD])


def before_row(code: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs to the end before a row of each code, from those after it; inserts stand before the row."""
    steps = np.stack([np.take_along_axis(after, TO[code][..., x], -1) + COST[code][..., x] for x in (0, 2, 3)])
    return relaxed(np.minimum(steps.min(0), FAR))


def end_costs() -> np.ndarray:
    after = np.full(STATES, FAR)
    after[list(DONE)] = 0
    return after


def segment_matrix(codes: np.ndarray) -> np.ndarray:
    """Cost of a segment from each state before to each state after it (min-plus)."""
    back = np.where(np.eye(STATES, dtype=bool), 0, FAR)  # one row of costs for each state that it may end in
    for code in codes[::-1]:
        back = before_row(np.full(STATES, code), back)
    return back.T


class Paths(NamedTuple):
    """Of each segment and entry state: the least cheapest path's letters, its rows, states on the way, and where it ends."""

    cost: np.ndarray
    nodes: np.ndarray
    letters: np.ndarray


def least_paths(codes: np.ndarray, sizes: np.ndarray, after: np.ndarray, last: np.ndarray) -> Paths:
    """Least cheapest paths through segments (rows of ``codes``, ``sizes`` long each) from all four states.

    ``after`` has the costs to the end by the state after a segment; behind the ``last`` one turns may be inserted.
    Node (row, state) has at most one optimal arc for each letter. Prefix doubling: nodes are ranked by the first
    1, 2, 4, … letters of their least audit, a rank of twice the length being the pair of a node's own rank and that of
    the node its pointer leads to; of a node's optimal arcs the one of the least letter, then of the least rank
    behind it, is on the path. The pointers of all lengths then lay the path out, doubling it in each step.
    """
    n, width = codes.shape
    best = np.empty((n, width + 1, STATES), np.int64)
    best[:, width] = np.where(last[:, None], relaxed(after), after)
    for i in reversed(range(width)):
        inside = (i < sizes)[:, None]
        best[:, i] = np.where(inside, before_row(codes[:, i], best[:, i + 1]), best[:, i + 1])

    node = np.arange(best.size).reshape(best.shape)
    arcs = np.full((*best.shape, 4), -1)
    here, row = best[:, :width], np.arange(width)[None, :, None] < sizes[:, None, None]
    for x in (0, 2, 3):
        to = TO[codes][..., x]
        fits = row & (COST[codes][..., x] + np.take_along_axis(best[:, 1:], to, -1) == here) & (here < FAR)
        arcs[:, :width, :, x] = np.where(fits, np.take_along_axis(node[:, 1:], to, -1), -1)
    may_insert = np.arange(width + 1)[None, :, None] < (sizes + last)[:, None, None]
    fits = may_insert & (INSERT + best[..., AHEAD] == best) & (best < FAR)
    arcs[..., 1] = np.where(fits, node[..., AHEAD], -1)
    arcs, own = arcs.reshape(-1, 4), np.arange(best.size)

    def chosen(rank: np.ndarray) -> np.ndarray:
        order = np.where(arcs >= 0, np.arange(1, 5) * (rank.max() + 1) + rank[arcs], np.iinfo(np.int64).max)
        return order.argmin(1)

    pick = chosen(np.zeros(best.size, np.int64))
    ends = arcs.max(1) < 0
    letter = np.where(ends, 0, pick + 1)
    jump = np.where(ends, own, arcs[own, pick])
    rank, jumps, length = letter.astype(np.int64), [], 1
    while True:
        jumps.append(jump)
        if length > 3 * (width + 1):
            break
        rank = np.unique(rank * (rank.max() + 1) + rank[jump], return_inverse=True)[1]
        pick = chosen(rank)
        assert (ends | (letter == pick + 1)).all()  # letters of a node's arcs differ: longer ranks confirm the choice
        jump, length = jump[jump], 2 * length
    path = node[:, 0, :, None]
    for jump in jumps:
        path = np.concatenate([path, jump[path]], -1)
    return Paths(best[:, 0], path, letter[path])


def _padded(lists: list, fill: int = 0) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in lists], np.int64)
    out = np.full((len(lists), max(1, int(sizes.max(initial=0)))), fill, np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out, sizes


PLAN = "key string, segment long, entry int, exit int, cost long, audit string, spots array<int>, turns string"


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of each segment (key, segment, codes, after, last, lone) from each state that it may begin in."""
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            batch = whole.slice(at, 500)
            keys, segments, lone, last = (batch[c].to_pylist() for c in ("key", "segment", "lone", "last"))
            codes, sizes = _padded(batch["codes"].to_pylist())
            found = least_paths(codes, sizes, np.array(batch["after"].to_pylist(), np.int64), np.array(last, bool))
            width, rows = codes.shape[1] + 1, []
            state, spot = found.nodes % STATES, found.nodes // STATES % width
            for i, (key, segment) in enumerate(zip(keys, segments, strict=True)):
                for entry in range(1 if lone[i] else STATES):
                    on = np.flatnonzero(found.letters[i, entry])
                    letters = "".join(LETTERS[x - 1] for x in found.letters[i, entry, on])
                    turns = "".join("-ua"[TURN[q]] if x in "IR" else "-" for x, q in zip(letters, state[i, entry, on], strict=True))
                    end = int(state[i, entry, -1])
                    rows.append((key, segment, entry, end, int(found.cost[i, entry]), letters, spot[i, entry, on].tolist(), turns))
            yield _batch(rows, [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.string()], PLAN)


def _batch(rows: list[tuple], kinds: list[pa.DataType], schema: str) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


# --- a tree over the segments of a long conversation ------------------------------------

VALUE = "key string, idx long, value array<long>"
KINDS = [pa.string(), pa.int64(), pa.list_(pa.int64())]


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch[c].to_pylist() for c in ("key", "segment", "codes")), strict=True)
        yield _batch([(k, s, segment_matrix(np.array(c, np.int64)).ravel().tolist()) for k, s, c in rows], KINDS, VALUE)


def multiplied(values: list[list[int]]) -> list[int]:
    """Min-plus product of matrices in order."""
    out = np.array(values[0], np.int64).reshape(STATES, STATES)
    for value in values[1:]:
        out = np.minimum((out[:, :, None] + np.array(value, np.int64).reshape(1, STATES, STATES)).min(1), FAR)
    return out.ravel().tolist()


def costs_after(values: list[list[int]], after: list[int]) -> list[list[int]]:
    """Costs to the end behind each of a node's segments, from those behind the node."""
    out, now = [], np.array(after, np.int64)
    for value in reversed(values):
        out.append(now.tolist())
        now = np.minimum((np.array(value, np.int64).reshape(STATES, STATES) + now).min(1), FAR)
    return out[::-1]


def composed(values: list[list[int]]) -> list[int]:
    """Where each state leads through maps in order."""
    out = list(range(STATES))
    for value in values:
        out = [value[q] for q in out]
    return out


def entries(values: list[list[int]], entry: list[int]) -> list[list[int]]:
    """The state in which each of a node's segments begins."""
    out, now = [], entry[0]
    for value in values:
        out.append([now])
        now = value[now]
    return out


def tree_scan(
    leaves: DataFrame,
    most: int,
    up: Callable[[list], list],
    down: Callable[[list, list], list],
    first: list[int],
    stage: Staging,
) -> DataFrame:
    """(key, idx, value): what each leaf (key, idx, value) gets from ``first`` at its key's top.

    ``RUN`` neighbours at a time are folded with ``up`` until one is left for each key (``most`` leaves at most), then
    ``down`` hands each node's value to its children. No group is larger than ``RUN``.
    """

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("key", "idx", "children")), strict=True)
            yield _batch([(k, i, up([c["value"] for c in children])) for k, i, children in rows], KINDS, VALUE)

    def hand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, children, given in zip(*(batch[c].to_pylist() for c in ("key", "children", "given")), strict=True):
                values = down([c["value"] for c in children], given)
                rows += [(k, c["idx"], v) for c, v in zip(children, values, strict=True)]
            yield _batch(rows, KINDS, VALUE)

    now, levels = leaves, []
    while True:
        grouped = now.groupBy("key", F.floor(F.col("idx") / RUN).alias("idx")).agg(
            F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("children")
        )
        levels.append(stage(grouped))
        most = -(-most // RUN)
        if most <= 1:
            break
        now = levels[-1].mapInArrow(climb, VALUE)
    given = levels[-1].select("key", "idx", F.array(*[F.lit(x).cast("long") for x in first]).alias("given"))
    for k, level in enumerate(reversed(levels)):
        handed = level.join(given, ["key", "idx"]).mapInArrow(hand, VALUE)
        given = handed.withColumnRenamed("value", "given")
        if k % 3 == 2:
            given = stage(given)
    return given.withColumnRenamed("given", "value")


# --- the operator ------------------------------------------------------------------------


class Repair(NamedTuple):
    """``report``: a row for each conversation. ``edits``: its steps in order of (place, nth), see ``repair``."""

    report: DataFrame
    edits: DataFrame


def conversation_key(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("1"), conv_id.cast("string")), F.lit("0"))


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """The cheapest edits after which the initials of a conversation's roles read ``(s?(ua)+)?``, and its faults.

    Rows of a conversation stand by turn, NULL first, those of one turn by role and the text's hash. A row's first
    fault counts: ``blank`` (nothing but blanks), ``duplicate`` (role and text seen earlier), ``truncated`` (its last
    character other than a blank is none of ``.!?``). Edits: keep (0), rerole to user or assistant (3), delete (4, and
    blanks and duplicates must go), insert an empty user or assistant turn anywhere (3); a truncated row that stays
    costs 3 more. ``audit`` has the initials of the edits; of equally cheap ones it is the least in ASCII order.

    ``report`` (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit): ``gaps`` are turn numbers missing
    between the first and the last, ``illegal`` the neighbours that don't read su, ua or au. ``edits`` (key, conv_id,
    place, nth, edit, role, text): for each step its letter, and role and text as they are afterwards (a deleted
    row's as they were); ``place`` counts the conversation's rows from 0, inserted turns stand before the row of
    their place. Rows without D are the repaired conversation.

    Conversations are cut into segments of 64 rows. A segment's costs from state to state are multiplied (min-plus) up a
    tree of 64 children and handed down again, so each segment knows the cost behind it; inside, nodes on optimal arcs
    are ranked by audits of doubling length and the pointers lay out the least path from each state; the states in
    which segments begin come down the same kind of tree. So a conversation with most of the rows is spread over all tasks;
    only its audit, one value by definition, is put together in one row.

    NULL role and text are one space, NULL conv_id is one conversation, NULL turns say nothing of gaps. Repeated rows
    are duplicates. An empty table gives no rows. Other columns are ignored; texts are never cut.
    """
    stage = stage_for(turns)
    said = turns.select(
        conversation_key(F.col(conv_id)).alias("key"),
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    hashed = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    placed = numbered(stage(said.withColumn("same", hashed)), "key", ["turn", "role", "same"], stage)

    repeated = placed.groupBy("key", "same").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    kept = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER)
    blank = F.col("kept") == ""
    duplicate = ~blank & F.coalesce(F.col("place") > F.col("first"), F.lit(False))
    cut_short = ~blank & ~duplicate & ~F.substring("kept", -1, 1).isin(".", "!", "?")
    coded = stage(
        placed.select("key", "conv_id", "turn", "place", "same", F.substring(kept, -1, 1).alias("kept"), kind.alias("kind"))
        .join(repeated.drop("n"), ["key", "same"], "left")
        .select(
            "key", "conv_id", "turn", "place", "kind", blank.alias("blank"), duplicate.alias("duplicate"), cut_short.alias("truncated")
        )
    )
    code = F.col("kind") + F.when(F.col("blank") | F.col("duplicate"), MUST_GO).otherwise(0) + F.when(F.col("truncated"), IS_CUT).otherwise(0)
    # a segment's last row also stands before the next one, for the neighbours across
    segment = F.floor(F.col("place") / RUN)
    also = F.when(F.col("place") % RUN == RUN - 1, segment + 1)
    cells = coded.select("key", F.explode(F.array_compact(F.array(segment, also))).alias("segment"), (F.col("place") * 16 + code).alias("one"))
    gathered = cells.groupBy("key", "segment").agg(F.array_sort(F.collect_list("one")).alias("ones"))
    inner = F.filter("ones", lambda x: x >= F.col("segment") * RUN * 16)
    kinds = F.transform("ones", lambda x: x % 4)
    pair = F.zip_with(F.slice(kinds, 1, F.size("ones") - 1), F.slice(kinds, 2, RUN), lambda a, b: a * 4 + b)
    segments = gathered.select(
        "key",
        "segment",
        F.transform(inner, lambda x: (x % 16).cast("int")).alias("codes"),
        F.size(F.filter(pair, lambda x: ~x.isin(S * 4 + U, U * 4 + A, A * 4 + U))).cast("long").alias("illegal"),
    )
    sizes = coded.groupBy("key").agg(
        F.first("conv_id").alias("conv_id"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.floor(F.max("place") / RUN).alias("final"),
    )
    sizes = stage(sizes)
    segments = stage(segments.join(sizes.select("key", "final"), "key").filter(F.size("codes") > 0))
    most = (sizes.agg(F.max("final")).first()[0] or 0) + 1

    ended = F.array(*[F.lit(int(x)).cast("long") for x in end_costs()])
    alone = segments.filter("final = 0").withColumns({"after": ended, "last": F.lit(True), "lone": F.lit(True)})
    plans = alone.select("key", "segment", "codes", "after", "last", "lone")
    if most > 1:
        several = segments.filter("final > 0")
        behind = tree_scan(several.select("key", "segment", "codes").mapInArrow(_matrices, VALUE), most, multiplied, costs_after, relaxed(end_costs()).tolist(), stage)
        last = F.col("segment") == F.col("final")
        asked = several.join(behind.withColumnsRenamed({"idx": "segment", "value": "after"}), ["key", "segment"])
        asked = asked.withColumns({"last": last, "after": F.when(last, ended).otherwise(F.col("after")), "lone": F.lit(False)})
        plans = plans.unionByName(asked.select(*plans.columns))
    plans = stage(plans.mapInArrow(_plans, PLAN))
    if most > 1:
        leads = F.transform(F.array_sort(F.collect_list(F.struct("entry", "exit"))), lambda x: x["exit"].cast("long"))
        maps = plans.join(sizes.filter("final > 0").select("key"), "key", "left_semi").groupBy("key", F.col("segment").alias("idx")).agg(leads.alias("value"))
        begins = tree_scan(maps, most, composed, entries, [START], stage)
        begins = begins.select("key", F.col("idx").alias("segment"), F.col("value")[0].alias("begin"))
        plans = plans.join(begins, ["key", "segment"], "left").filter(F.col("entry") == F.coalesce("begin", F.lit(START))).drop("begin")

    audits = plans.groupBy("key").agg(
        F.max_by("cost", -F.col("segment")).alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    crossed = segments.groupBy("key").agg(F.sum("illegal").alias("illegal"))
    report = sizes.join(audits, "key").join(crossed, "key")

    step = F.posexplode("spots").alias("nth", "spot")
    steps = plans.select("key", "segment", "audit", "turns", step).select(
        "key",
        (F.col("segment") * RUN + F.col("spot")).alias("place"),
        F.col("nth").alias("nth"),
        F.substring("audit", F.col("nth") + 1, F.lit(1)).alias("edit"),
        F.substring("turns", F.col("nth") + 1, F.lit(1)).alias("becomes"),
    )
    named = F.when(F.col("becomes") == "u", "user").when(F.col("becomes") == "a", "assistant").otherwise(F.col("role"))
    # an inserted turn may stand behind the last row, so it meets no row of its place
    own = steps.filter("edit <> 'I'").join(placed.select("key", "conv_id", "place", "role", "text"), ["key", "place"])
    added = steps.filter("edit = 'I'").join(sizes.select("key", "conv_id"), "key").withColumns({"role": F.lit(None).cast("string"), "text": F.lit("")})
    edits = own.unionByName(added, allowMissingColumns=True).select("key", "conv_id", "place", "nth", "edit", named.alias("role"), "text")
    return Repair(report.select("key", "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"), edits)


def joined_hashes(edits: DataFrame) -> DataFrame:
    """(key, repaired_sha256): the hash of a repaired conversation's ``role:text`` lines.

    Lines stream through the hash in order, so a conversation's text is never held as a whole; but SHA-256 is one
    chain, so the lines of one conversation pass one task. Conversations without lines have no row.
    """
    lines = edits.filter("edit <> 'D'").select("key", "place", "nth", F.concat("role", F.lit(":"), "text").cast("binary").alias("line"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            rows = []
            for key, line in zip(batch["key"].to_pylist(), batch["line"].to_pylist(), strict=True):
                if key == now:
                    state.update(b"\n" + line)
                    continue
                if state:
                    rows.append((now, state.hexdigest()))
                now, state = key, hashlib.sha256(line)
            yield _batch(rows, [pa.string(), pa.string()], "key string, repaired_sha256 string")
        if state:
            yield _batch([(now, state.hexdigest())], [pa.string(), pa.string()], "key string, repaired_sha256 string")

    return lines.repartition("key").sortWithinPartitions("key", "place", "nth").mapInArrow(hashed, "key string, repaired_sha256 string")
