"""Language-model scores: a bigram model with Katz backoff over all learning texts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from installarc.llm.common import groups_of, stage_for

WORD_BYTES = b"[^\\x20\\x09-\\x0d]+"
#: Hash that stands for the end of a text, and number that stands for its start as a history.
END, START = 1, 0
#: Counts up to this one are discounted.
LOW = 5

BLOCK = "uid long, docs array<{id}>, learns array<boolean>, lengths array<int>, ids binary, bucket int, words binary, counts binary"
WORDS = "uid long, bucket int, numbers binary, counts binary, types long, tokens long, ones array<long>"
ASKED = "uid long, bucket int, histories binary, words binary, counts binary, known binary"
PAIRS = (
    "uid long, bucket int, counts binary, stats binary, ones array<long>, history long, partial array<double>, needs array<long>"
)
SCORES = "doc {id}, learns boolean, n_tokens long, n_known long, base_score double, score double"


def pack(a: np.ndarray) -> bytes:
    """Compressed numbers, like bytes side by side."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T
    return zstandard.ZstdCompressor(level=5).compress(planes.tobytes())


def unpack(b: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_sorted(b: bytes, kind: type) -> np.ndarray:
    return np.cumsum(unpack(b, kind), dtype=kind)


def spread(x: np.ndarray, buckets: int) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)


def discounts(ones: np.ndarray) -> np.ndarray:
    """Katz's Good-Turing discounts d[r] for r up to ``LOW`` from the numbers of counts 1 to ``LOW`` + 1; d[0] is unused.

    Where too few counts make the formula leave (0, 1), half a count is taken instead.
    """
    d = np.ones(LOW + 1)
    limit = (LOW + 1) * ones[LOW] / ones[0] if ones[0] else 1.0
    for r in range(1, LOW + 1):
        turing = (r + 1) * ones[r] / ones[r - 1] if ones[r - 1] else 0.0
        d[r] = (turing / r - limit) / (1.0 - limit) if limit < 1.0 else 0.0
        if not 0.0 < d[r] < 1.0:
            d[r] = (r - 0.5) / r
    return d


def counts_of_counts(counts: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(counts, LOW + 2), minlength=LOW + 3)[1 : LOW + 2]


class Unigrams:
    """Probabilities of words from their counts; one type stands for all words not learnt."""

    def __init__(self, tokens: int, ones: np.ndarray) -> None:
        self.tokens, self.d = tokens, discounts(ones)
        lost = sum((1.0 - self.d[r]) * r * ones[r - 1] for r in range(1, LOW + 1))
        left = max(lost, tokens / (tokens + 1.0))
        self.unknown = left / tokens if tokens else 1.0
        self.scale = (1.0 - self.unknown) / (tokens - lost) if tokens else 0.0

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        d = np.where(counts <= LOW, self.d[np.minimum(counts, LOW)], 1.0)
        return np.where(counts > 0, d * counts * self.scale, self.unknown)


def backoff(totals: np.ndarray, stats: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scale, alpha) of histories seen ``totals`` times.

    ``stats`` has, for each, the numbers of followers seen 1 to ``LOW`` times, the counts of the others, and
    the unigram probabilities of all followers. A follower's probability is scale x d x count; any other's
    is alpha x its unigram probability. Both add up to exactly 1. A history none of whose counts is discounted gives
    one count in (total + 1) to words it was not seen with.
    """
    low = stats[:, :LOW] * np.arange(1, LOW + 1)
    seen = (low * d[1:]).sum(axis=1) + stats[:, LOW]
    left = totals - seen
    none = left < 1e-9 * np.maximum(totals, 1)
    scale = np.where(none, 1.0 / (totals + 1.0), 1.0 / np.maximum(totals, 1))
    mass = 1.0 - scale * seen
    rest = np.maximum(1.0 - stats[:, LOW + 1], 1e-300)
    return scale, np.where(totals > 0, mass / rest, 1.0)


def _read(docs: DataFrame, buckets: int, block_bytes: int) -> DataFrame:
    """Blocks of texts: a row with the words of all tokens, and a row for each bucket with the block's distinct words."""
    id_type = docs.schema["doc"].dataType.simpleString()
    schema = T._parse_datatype_string(BLOCK.format(id=id_type))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = np.cumsum(pa.compute.binary_length(batch["body"]).fill_null(0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                done = int(sizes[at - 1]) if at else 0
                end = max(at + 1, int(np.searchsorted(sizes, done + block_bytes, "right")))
                yield block(batch.slice(at, end - at), uid)
                at, uid = end, uid + 1

    def block(rows: pa.RecordBatch, uid: int) -> pa.RecordBatch:
        find, number, ids, lengths = re.compile(WORD_BYTES).findall, {}, [], []
        for body in rows["body"]:
            found = find(body.as_py().lower()) if body.is_valid else []
            ids.append(np.fromiter((number.setdefault(w, len(number)) for w in found), np.int64, len(found)))
            ids.append(np.array([-1]))
            lengths.append(len(found) + 1)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
        hashes = np.append(hashes, np.uint64(END))  # which -1 points to
        home = spread(hashes, buckets)
        order = np.lexsort((hashes, home))
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order))
        tokens = rank[np.concatenate(ids)]
        learns = rows["learns"].to_numpy(zero_copy_only=False).astype(bool)
        counts = np.bincount(tokens[np.repeat(learns, lengths)], minlength=len(order))
        hashes, home = hashes[order], home[order]
        edge = np.flatnonzero(np.diff(home, prepend=-1))
        parts = list(zip(edge, np.append(edge[1:], len(home)), strict=True))
        n = len(parts)
        first = [{"uid": uid, "lengths": lengths, "ids": pack(tokens), "learns": learns.tolist()}]
        rest = [
            {"uid": uid, "bucket": int(home[a]), "words": pack_sorted(hashes[a:b]), "counts": pack(counts[a:b])} for a, b in parts
        ]
        table = pa.RecordBatch.from_pylist(first + rest, schema=arrow)
        own = pa.ListArray.from_arrays(pa.array([0] + [len(lengths)] * (n + 1), pa.int32()), rows["doc"])
        columns = [own if f.name == "docs" else table.column(f.name) for f in arrow]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return docs.mapInArrow(read, schema)


def _word_table(read: DataFrame, buckets: int) -> DataFrame:
    """Counts of all words by bucket, handed back to every block in the order it asked; unknown words get number -1."""

    def count(rows: pa.Table) -> pa.Table:
        words = [unpack_sorted(b, np.uint64) for b in rows["words"].to_pylist()]
        types, at = np.unique(np.concatenate(words), return_inverse=True)
        own = np.concatenate([unpack(b, np.int64) for b in rows["counts"].to_pylist()])
        total = np.bincount(at, own, len(types)).astype(np.int64)
        by_count = np.argsort(-total, kind="stable")
        bucket = rows["bucket"][0].as_py()
        number = np.empty(len(types), np.int64)
        number[by_count] = np.arange(len(types)) * buckets + bucket + 1
        number[total == 0] = -1
        out, start = [], 0
        for uid, w in zip(rows["uid"].to_pylist(), words, strict=True):
            mine = at[start : start + len(w)]
            start += len(w)
            out.append({"uid": uid, "bucket": bucket, "numbers": pack(number[mine]), "counts": pack(total[mine])})
        out.append(
            {"bucket": bucket, "types": int((total > 0).sum()), "tokens": int(total.sum()), "ones": counts_of_counts(total).tolist()}
        )
        return _table(out, WORDS)

    return read.filter(F.col("bucket").isNotNull()).select("uid", "bucket", "words", "counts").groupBy("bucket").applyInArrow(count, WORDS)


def _table(rows: list[dict], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}
    fields = [c.split(" ", 1) for c in schema.split(", ")]
    return pa.Table.from_pylist(rows, schema=pa.schema([(name, kinds[kind]) for name, kind in fields]))


class Block:
    """The tokens of a block with what the word table says, and its distinct pairs in the order they are asked for."""

    def __init__(self, rows: pa.Table, unigrams: Unigrams, starts: int, buckets: int, hot: float) -> None:
        rows = rows.to_pylist()
        self.head = next(r for r in rows if r.get("ids") is not None)
        answers = sorted((r for r in rows if r.get("numbers") is not None), key=lambda r: r["bucket"])
        number = np.concatenate([unpack(r["numbers"], np.int64) for r in answers])
        count = np.concatenate([unpack(r["known"], np.int64) for r in answers])
        self.tokens = unpack(self.head["ids"], np.int32)
        self.lengths = np.array(self.head["lengths"], np.int64)
        self.learns = np.array(self.head["learns"], bool)
        self.counts = count[self.tokens]
        self.p = unigrams(count)
        # histories as local numbers: words, then the start; unknown words are all one
        local = np.append(np.where(count > 0, np.arange(len(count)), -1), len(count))
        firsts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        history = np.empty(len(self.tokens), np.int64)
        history[1:] = local[self.tokens[:-1]]
        history[firsts] = len(count)
        word = local[self.tokens]
        asked = np.flatnonzero(history >= 0)
        width = len(count) + 2
        keys, at = np.unique(history[asked] * width + word[asked] + 1, return_inverse=True)
        h, w = keys // width, keys % width - 1
        learnt = np.bincount(at, np.repeat(self.learns, self.lengths)[asked], len(keys)).astype(np.int64)
        numbers, totals = np.append(number, START), np.append(count, starts)
        self.hid, self.wid = numbers[h], np.where(w >= 0, number[np.maximum(w, 0)], -1)
        self.total = totals[h]
        by_pair = buckets + spread(self.hid * 1_000_003 + self.wid, buckets)
        home = np.where(self.total >= hot, by_pair, spread(self.hid, buckets))
        order = np.lexsort((self.wid, self.hid, home))
        self.place = np.full(len(self.tokens), -1, np.int64)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.place[asked] = back[at]
        self.hid, self.wid, self.total, self.home = (x[order] for x in (self.hid, self.wid, self.total, home))
        self.learnt = learnt[order]
        self.pair_known = np.where(self.wid >= 0, count[np.maximum(w[order], 0)], 0)
        self.pair_p = unigrams(self.pair_known)
        edge = np.flatnonzero(np.diff(self.home, prepend=-1))
        self.parts = list(zip(edge, np.append(edge[1:], len(self.home)), strict=True)) if len(edge) else []

    def requests(self) -> list[dict]:
        return [
            {
                "uid": self.head["uid"],
                "bucket": int(self.home[a]),
                "histories": pack_sorted(self.hid[a:b]),
                "words": pack_sorted(self.wid[a:b]),
                "counts": pack(self.learnt[a:b]),
                "known": pack(self.pair_known[a:b]),
            }
            for a, b in self.parts
        ]


    def log_probabilities(self, answers: list[dict], sums: list[dict], d: np.ndarray, buckets: int) -> np.ndarray:
        """log10 of each token's probability, given the answers to the requests and the sums of hot histories."""
        p = self.p[self.tokens]
        if not self.parts:
            return np.log10(p)
        answers = sorted(answers, key=lambda r: r["bucket"])
        seen = np.concatenate([unpack(r["counts"], np.int64) for r in answers])
        stats = np.zeros((len(self.hid), LOW + 2))
        hot = {r["history"]: r["partial"] for r in sums}
        for (a, b), answer in zip(self.parts, answers, strict=True):
            own, at = np.unique(self.hid[a:b], return_inverse=True)
            if answer["bucket"] < buckets:
                table = unpack(answer["stats"], np.float64).reshape(LOW + 2, -1).T
            else:
                table = np.array([hot[h] for h in own.tolist()])
            stats[a:b] = table[at]
        scale, alpha = backoff(self.total, stats, d)
        low = np.where(seen <= LOW, d[np.minimum(seen, LOW)], 1.0)
        pair = np.where(seen > 0, scale * low * seen, alpha * self.pair_p)
        known = self.place >= 0
        p = np.where(known, pair[np.maximum(self.place, 0)], p)
        return np.log10(p)


def _pair_table(asked: DataFrame, unigrams: Unigrams, buckets: int) -> DataFrame:
    """Counts of all pairs by bucket, handed back to every block, with the sums over each history's followers.

    Buckets from ``buckets`` on hold pairs of hot histories, whose followers are in several of them: rows with
    ``history`` are one bucket's share of the sums, and ``needs`` lists the histories that a block uses.
    """

    def count(rows: pa.Table) -> pa.Table:
        asked = rows.to_pylist()
        bucket = asked[0]["bucket"]
        parts = [unpack_sorted(r["histories"], np.int64) for r in asked]
        sizes = [len(h) for h in parts]
        h, w = np.concatenate(parts), np.concatenate([unpack_sorted(r["words"], np.int64) for r in asked])
        own = np.concatenate([unpack(r["counts"], np.int64) for r in asked])
        p = unigrams(np.concatenate([unpack(r["known"], np.int64) for r in asked]))
        order = np.lexsort((w, h))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(h[order]) != 0) | (np.diff(w[order]) != 0)
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        first = order[new]
        total = np.bincount(group, own, len(first)).astype(np.int64)
        histories, of = np.unique(h[first], return_inverse=True)
        stats = np.zeros((len(histories), LOW + 2))
        for r in range(1, LOW + 1):
            stats[:, r - 1] = np.bincount(of[total == r], minlength=len(histories))
        stats[:, LOW] = np.bincount(of, np.where(total > LOW, total, 0), len(histories))
        stats[:, LOW + 1] = np.bincount(of, np.where(total > 0, p[first], 0.0), len(histories))
        out = [{"ones": counts_of_counts(total).tolist()}]
        if bucket >= buckets:
            out += [{"history": x, "partial": row} for x, row in zip(histories.tolist(), stats.tolist(), strict=True)]
        start = 0
        for r, n in zip(asked, sizes, strict=True):
            mine, start = group[start : start + n], start + n
            used = np.unique(of[mine])
            answer = {"uid": r["uid"], "bucket": bucket, "counts": pack(total[mine])}
            hot = {"needs": histories[used].tolist()} if bucket >= buckets else {"stats": pack(stats[used].T.ravel())}
            out.append(answer | hot)
        return _table(out, PAIRS)

    return asked.groupBy("bucket").applyInArrow(count, PAIRS)


def _ones(table: DataFrame) -> np.ndarray:
    row = table.agg(*[F.coalesce(F.sum(F.col("ones")[r]), F.lit(0)) for r in range(LOW + 1)]).first()
    return np.array(row, np.float64)


def katz_scores(
    docs: DataFrame,
    learns: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = 8 << 20,
    bucket_words: int = 16 << 20,
    bucket_pairs: int = 1_000_000,
) -> DataFrame:
    """Scores every text; rows for which ``learns`` holds teach the model.

    Returns (doc, learns, n_tokens, n_known, train_tokens, base_score, score). Tokens are words (A-Z count as
    lower case) and one end. ``base_score`` adds up log10((c + 1) / (N + V + 1)); ``score`` is the text's log10
    probability by bigrams with Katz backoff: counts up to 5 are Good-Turing discounted, and what that frees goes to the
    words not seen after the history, in proportion to their unigram probabilities, so each
    history's probabilities add up to 1. An unseen history backs off to the unigrams, which keep a
    share for one unknown word.

    Texts are read once, in blocks of about ``block_bytes``. A block asks the word table, and then the pair table, for each distinct entry
    once and gets its counts over all learning texts back; both tables are parted by hash in buckets of bounded
    size, so nothing grows with the corpus in one task. Pairs whose history is so frequent that it would swell a
    bucket are parted by the whole pair; their sums are joined from all buckets.

    NULL and empty texts are the end alone. Repeated rows are scored and learnt from one by one. If nothing is learnt, every
    token is unknown. An empty table gives an empty result. Other columns are ignored.
    """
    stage = stage_for(docs)
    body = docs.select(
        F.col(doc_id).alias("doc"), F.coalesce(learns, F.lit(False)).alias("learns"), F.col(text).cast("binary").alias("body")
    )
    total, starts = body.agg(F.sum(F.octet_length("body")), F.sum(F.col("learns").cast("long"))).first()
    word_buckets = groups_of(total or 0, bucket_words)
    read = stage(_read(body, word_buckets, block_bytes))
    words = stage(_word_table(read, word_buckets))
    row = words.agg(F.sum("types"), F.sum("tokens")).first()
    types, tokens = row[0] or 0, row[1] or 0
    unigrams = Unigrams(tokens, _ones(words))
    buckets = groups_of(tokens, bucket_pairs)
    hot = max(tokens / (8.0 * buckets), 1.0)
    heads = read.filter(F.col("ids").isNotNull()).select("uid", "docs", "learns", "lengths", "ids")
    numbers = words.filter(F.col("uid").isNotNull()).select("uid", "bucket", "numbers", F.col("counts").alias("known"))

    def ask(rows: pa.Table) -> pa.Table:
        return _table(Block(rows, unigrams, starts or 0, buckets, hot).requests(), ASKED)

    both = heads.drop("docs").unionByName(numbers, allowMissingColumns=True)
    pairs = stage(_pair_table(both.groupBy("uid").applyInArrow(ask, ASKED), unigrams, buckets))
    d = discounts(_ones(pairs))
    hot_sums = (
        pairs.filter(F.col("history").isNotNull())
        .groupBy("history")
        .agg(F.array(*[F.sum(F.col("partial")[k]) for k in range(LOW + 2)]).alias("partial"))
    )
    needs = pairs.select("uid", F.explode("needs").alias("history")).distinct().join(hot_sums, "history")
    answers = pairs.filter(F.col("uid").isNotNull()).select("uid", "bucket", F.col("counts").alias("pairs"), "stats")
    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = SCORES.format(id=id_type)

    def score(rows: pa.Table) -> pa.Table:
        block = Block(rows.drop(["docs", "pairs", "stats", "history", "partial"]), unigrams, starts or 0, buckets, hot)
        rest = rows.select(["bucket", "pairs", "stats", "history", "partial"]).to_pylist()
        answers = [r | {"counts": r["pairs"]} for r in rest if r["pairs"] is not None]
        logs = block.log_probabilities(answers, [r for r in rest if r["history"] is not None], d, buckets)
        firsts = np.concatenate([[0], np.cumsum(block.lengths)[:-1]]).astype(np.int64)
        base = np.log10((block.counts + 1.0) / (tokens + types + 1.0))
        at = int(np.flatnonzero(rows["ids"].is_valid().to_numpy())[0])
        return pa.table(
            {
                "doc": rows["docs"].slice(at, 1).combine_chunks().flatten(),
                "learns": block.learns,
                "n_tokens": block.lengths,
                "n_known": np.add.reduceat((block.counts > 0).astype(np.int64), firsts),
                "base_score": np.add.reduceat(base, firsts),
                "score": np.add.reduceat(logs, firsts),
            }
        )

    whole = heads.unionByName(numbers, allowMissingColumns=True).unionByName(answers, allowMissingColumns=True)
    whole = whole.unionByName(needs, allowMissingColumns=True)
    return whole.groupBy("uid").applyInArrow(score, schema).withColumn("train_tokens", F.lit(tokens).cast("long"))
