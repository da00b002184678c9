"""Line dedup by winnowing: repeated runs of lines stay at their first place only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from installarc.llm.common import content_key, fresh, stage_for

KEY = "struct<id:string,a:bigint,b:int>"
WINDOW = f"key {KEY}, doc string, first int, last int, spot int, print long, run long, run2 long"


def windows(lines: list[bytes], least_words: int) -> list[tuple[int, int]]:
    """(first, last) of the shortest run of at least ``least_words`` words from each line on, where there is one."""
    words = [len(line.split()) for line in lines]
    out, last, total = [], -1, 0
    for first in range(len(lines)):
        while total < least_words and last + 1 < len(lines):
            last += 1
            total += words[last]
        if total < least_words:
            break
        out.append((first, last))
        total -= words[first]
    return out


def windows_both_ways(lines: list[bytes], least_words: int) -> list[tuple[int, int]]:
    """The shortest windows from each line on, and those up to each line. Those in a run cover all of it."""
    end = len(lines) - 1
    up_to = [(end - last, end - first) for first, last in windows(lines[::-1], least_words)]
    return sorted({*windows(lines, least_words), *up_to})


def fingerprints(hashes: np.ndarray, spans: list[tuple[int, int]]) -> list[int]:
    """Winnowing: of each window the line of the smallest hash, the last of equal ones."""
    return [last - int(hashes[first : last + 1][::-1].argmin()) for first, last in spans]


def _windows(docs: DataFrame, least_words: int) -> DataFrame:
    """A row for each window of a document: its fingerprint, where that lies, and a 128-bit hash of all its lines."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, doc, body in zip(*[batch[c].to_pylist() for c in ("key", "doc", "body")], strict=True):
                lines = (body or b"").split(b"\n")
                spans = windows_both_ways(lines, least_words)
                hashes = np.fromiter((xxhash.xxh64_intdigest(x) >> 1 for x in lines), np.int64, len(lines))
                for (first, last), at in zip(spans, fingerprints(hashes, spans), strict=True):
                    run = xxhash.xxh3_128_intdigest(hashes[first : last + 1].tobytes())
                    rows.append((key, doc, first, last, at, int(hashes[at]), run >> 65, run & (1 << 63) - 1))
            names = ["key", "doc", "first", "last", "spot", "print", "run", "run2"]
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            kinds = [batch.schema.field("key").type, pa.string(), *[pa.int32()] * 3, *[pa.int64()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return docs.mapInArrow(cut, WINDOW)


def dedup_lines(docs: DataFrame, least_words: int = 25, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds ``clean_text``, ``n_lines``, ``n_removed`` and ``removed`` (line numbers from 0) to every row.

    A run of consecutive whole lines with at least ``least_words`` words in all that occurs earlier, by id and
    then by line, is deleted to its last line, however long it is; its first occurrence stays. Lines are told apart byte by byte.

    The shortest windows of so many words, from each line on and up to each line, are winnowed: the
    line of the smallest hash is the window's fingerprint, so any repeated run shares one in each of its windows. Places
    of fingerprints are counted over all documents; only windows of repeated ones are compared, as a whole, with the
    first window of the same lines. Each line of a repeated run lies in a window from it on, or up to the run's last line, so
    overlapping repeated windows join to the maximal run on both sides. Each window meets its first only, so copies are never paired.

    Ids are in order of number and then of text, NULL last; documents of one id are in order of their texts' hashes.
    Rows that repeat id and text are one document and lose the same lines. NULL texts have no lines and stay NULL, empty texts stay
    empty. Columns called like the added ones are replaced.
    """
    added = ["clean_text", "n_lines", "n_removed", "removed"]
    own_key, gone = fresh("_line_key", docs.columns), fresh("_gone", docs.columns)
    kept = [c for c in docs.columns if c.lower() not in added]
    keyed = docs.select(*kept, content_key(F.col(doc_id), F.col(text)).cast(KEY).alias(own_key))
    cut = stage_for(docs)(
        _windows(
            keyed.select(
                F.col(own_key).alias("key"),
                F.col(doc_id).cast("string").alias("doc"),
                F.col(text).cast("binary").alias("body"),
            ),
            least_words,
        )
    )
    number = F.expr("try_cast(doc as decimal(38,0))").alias("number")
    cut = cut.withColumn("at", F.struct(F.col("doc").isNull().alias("none"), number, "key", "first"))
    spot = F.struct("key", "spot")
    often = cut.groupBy("print").agg(F.min(spot).alias("a"), F.max(spot).alias("z")).filter(~F.col("a").eqNullSafe(F.col("z")))
    likely = cut.join(often.select("print"), "print", "left_semi")
    same = ["run", "run2"]
    firsts = likely.groupBy(*same).agg(F.min("at").alias("origin"), F.max("at").alias("z")).filter(F.col("origin") != F.col("z"))
    again = likely.join(firsts.drop("z"), same).filter(F.col("at") != F.col("origin"))
    removed = (
        again.select("key", F.explode(F.sequence("first", "last")).alias("line"))
        .groupBy("key")
        .agg(F.array_sort(F.collect_set("line")).alias(gone))
        .withColumnRenamed("key", own_key)
    )
    lines = F.split(F.col(text), "\n")
    left = F.filter(
        F.transform(lines, lambda x, i: F.when(~F.array_contains("removed", i), x)), lambda x: x.isNotNull()
    )
    return (
        keyed.join(removed, own_key, "left")
        .withColumn("removed", F.coalesce(gone, F.array().cast("array<int>")))
        .select(
            *kept,
            F.when(F.size("removed") == 0, F.col(text)).otherwise(F.array_join(left, "\n")).alias("clean_text"),
            F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
            F.size("removed").alias("n_removed"),
            "removed",
        )
    )
