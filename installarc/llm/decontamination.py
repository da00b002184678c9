"""Benchmark decontamination with a distributed positional inverted index."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from installarc.llm.common import content_key, lower_ascii, stage_for

#: Words are runs of a-z, 0-9 and characters beyond ASCII; the second form is the same on lower-cased UTF-8.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WORD_BYTES = b"[0-9a-z\\x80-\\xff]+"

KEY = "struct<id:string,a:bigint,b:int>"
HIT = "block long, start int, n_hit long, phrases array<long>"
SPAN = "block long, start int, phrase long, first int, last int"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), 0)


def build_index(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: DataFrame | None = None,
    vocabulary_limit: int = 200_000,
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """The index, written to the shared folder: rows of documents and rows of postings.

    Documents are indexed in blocks of about ``block_bytes`` of text; words of a block are numbered
    through, with a free number between documents, so that no phrase can cross from one into the next. A
    posting row has a block's sorted places of one term; no list of a term is ever in one place. A document row has
    its first place and its number of words (0 for a NULL or empty text).

    With a ``vocabulary`` (column ``term``) of at most ``vocabulary_limit`` terms only their postings are
    stored, as no other can be asked for. A larger one isn't sent to the tasks: all postings are stored then.
    """
    known = None
    if vocabulary is not None and vocabulary.count() <= vocabulary_limit:
        known = docs.sparkSession.sparkContext.broadcast(
            {bytes(row["term"]): i for i, row in enumerate(vocabulary.select("term").collect())}
        )
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("doc", id_type),
            T.StructField("key", T._parse_datatype_string(KEY)),
            T.StructField("start", T.IntegerType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("term", T.BinaryType()),
            T.StructField("n", T.LongType()),
            T.StructField("places", T.ArrayType(T.IntegerType())),
        ]
    )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, count = re.compile(WORD_BYTES).findall, 0
        first = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = np.cumsum(pa.compute.binary_length(batch["body"]).fill_null(0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                done = int(sizes[at - 1]) if at else 0
                end = max(at + 1, int(np.searchsorted(sizes, done + block_bytes, "right")))
                yield from _block(batch.slice(at, end - at), first + count, find)
                at, count = end, count + 1

    def _block(rows: pa.RecordBatch, block: int, find) -> Iterator[pa.RecordBatch]:
        number = known.value if known else {}
        starts, lengths, terms, places, at = [], [], [], [], 0
        for body in rows["body"]:
            found = find(body.as_py().lower()) if body.is_valid else []
            ids = map(number.get, found, repeat(-1)) if known else (number.setdefault(w, len(number)) for w in found)
            terms.append(np.fromiter(ids, np.int32, len(found)))
            places.append(np.arange(at, at + len(found), dtype=np.int32))
            starts.append(at)
            lengths.append(len(found))
            at += len(found) + 1
        yield _rows(
            rows.num_rows, block, doc=rows["doc"], key=rows["key"], start=pa.array(starts, pa.int32()), n_words=pa.array(lengths, pa.int64())
        )
        term, place = np.concatenate(terms), np.concatenate(places)
        if known:
            term, place = term[term >= 0], place[term >= 0]
        order = np.argsort(term, kind="stable")
        term, place = term[order], place[order]
        edge = np.flatnonzero(np.diff(term, prepend=-1))
        names = list(number)
        yield _rows(
            len(edge),
            block,
            term=pa.array([names[i] for i in term[edge]], pa.binary()),
            n=pa.array(np.diff(edge, append=len(term)), pa.int64()),
            places=pa.ListArray.from_arrays(pa.array(np.append(edge, len(term)), pa.int32()), pa.array(place)),
        )

    def _rows(rows: int, block: int, **columns: pa.Array) -> pa.RecordBatch:
        full = {"block": pa.array(np.full(rows, block), pa.int64())} | columns
        return pa.RecordBatch.from_arrays([full.get(f.name, pa.nulls(rows, f.type)) for f in arrow], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    body = docs.select(
        F.col(doc_id).alias("doc"),
        content_key(F.col(doc_id), F.col(text)).cast(KEY).alias("key"),
        F.col(text).cast("binary").alias("body"),
    )
    return stage_for(docs)(body.mapInArrow(index, schema))


def phrases_of(items: DataFrame, window: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, words) of all windows of ``window`` words; an item of fewer words is one window, one without words none."""
    words = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words_of(F.col(text)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return (
        words.filter(F.size("w") > 0)
        .select("item", "w", F.explode(starts).alias("s"))
        .select("item", F.slice("w", F.col("s"), F.lit(window)).alias("words"))
        .distinct()
    )


def _plan(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase, anchor, steps): a phrase's terms with their offsets, rarest of the corpus first.

    A phrase with a term that the corpus lacks occurs nowhere and is left out.
    """
    counts = index.filter(F.col("term").isNotNull()).groupBy("term").agg(F.sum("n").alias("total"))
    terms = phrases.select("phrase", F.size("words").alias("length"), F.posexplode("words").alias("offset", "word"))
    ranked = (
        terms.withColumn("term", F.col("word").cast("binary"))
        .join(counts, "term")
        .groupBy("phrase", "length")
        .agg(F.array_sort(F.collect_list(F.struct("total", "offset", "term"))).alias("steps"))
        .filter(F.size("steps") == F.col("length"))
    )
    return ranked.select("phrase", F.col("steps")[0]["term"].alias("term"), "steps")


def _asked(index: DataFrame, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per block: the phrases whose rarest term it holds, and the index rows that these need."""
    postings = index.filter(F.col("term").isNotNull())
    asked = stage_for(index)(
        postings.select("block", "term")
        .join(plan, "term")
        .select("block", "phrase", F.col("steps.offset").alias("offsets"), F.col("steps.term").alias("terms"))
    )
    wanted = asked.select("block", F.explode("terms").alias("term")).distinct()
    blocks = asked.select("block").distinct()
    lists = postings.join(wanted, ["block", "term"], "left_semi").select("block", "start", "n_words", "term", "places")
    owners = index.filter(F.col("term").isNull()).join(blocks, "block", "left_semi")
    return asked, lists.unionByName(owners.select("block", "start", "n_words", "term", "places"))


def intersect(offsets: np.ndarray, lists: list[np.ndarray]) -> np.ndarray:
    """Places where a phrase starts: each list, moved by its term's offset, thins out what the rarer ones left."""
    starts = lists[0] - offsets[0]
    for offset, places in zip(offsets[1:], lists[1:], strict=True):
        if not len(starts):
            break
        at = np.searchsorted(places, starts + offset)
        at[at == len(places)] = 0
        starts = starts[places[at] == starts + offset]
    return starts


def _lists(rows: pd.DataFrame) -> tuple[dict[bytes, np.ndarray], np.ndarray, np.ndarray]:
    owners = rows[rows["term"].isna()].sort_values("start")
    lists = rows[rows["term"].notna()]
    found = {bytes(t): np.asarray(p, np.int64) for t, p in zip(lists["term"], lists["places"], strict=True)}
    return found, owners["start"].to_numpy(np.int64), owners["n_words"].to_numpy(np.int64)


def _hits(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """Documents of one block with hits: words inside any phrase, and the phrases."""
    nothing = pd.DataFrame({"block": [], "start": [], "n_hit": [], "phrases": []})
    if asked.empty:
        return nothing
    lists, firsts, _ = _lists(rows)
    first, last, phrase = [], [], []
    for p, offsets, terms in zip(asked["phrase"], asked["offsets"], asked["terms"], strict=True):
        if any(bytes(t) not in lists for t in terms):
            continue
        starts = intersect(np.asarray(offsets), [lists[bytes(t)] for t in terms])
        first.append(starts)
        last.append(starts + len(terms))
        phrase.append(np.full(len(starts), p, np.int64))
    if not first:
        return nothing
    first, last, phrase = np.concatenate(first), np.concatenate(last), np.concatenate(phrase)
    order = np.argsort(first, kind="stable")
    first, last, phrase = first[order], last[order], phrase[order]
    doc = np.searchsorted(firsts, first, "right") - 1
    out = []
    for at in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(doc)) + 1) if len(doc) else []:
        reach = np.maximum.accumulate(last[at])
        new = np.maximum(first[at], np.concatenate([[0], reach[:-1]]))
        hit = int(np.maximum(reach - new, 0).sum())
        out.append((asked["block"].iat[0], firsts[doc[at[0]]], hit, np.unique(phrase[at])))
    return pd.DataFrame(out, columns=["block", "start", "n_hit", "phrases"])


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document: ``doc``, ``key``, ``n_words``, ``n_hit``, ``items`` (sorted ids as strings) and ``contaminated``.

    A word is hit if it lies in an occurrence of ``window`` consecutive words of an item (of the whole item,
    if shorter). Occurrences are found in the positional index: the list of the phrase's rarest term is
    intersected with the next lists, moved by their offsets, block by block.

    NULL or empty texts have no words and no hits. A NULL item_id is listed as the empty string. Items of
    one id count once; repeated documents each get a row. Without items, or without documents, nothing
    is hit. Other columns are ignored.
    """
    stage = stage_for(docs)
    windows = stage(phrases_of(items, window, item_id, item_text))
    phrases = stage(windows.select("words").distinct().withColumn("phrase", F.monotonically_increasing_id()))
    owners = stage(windows.join(phrases, "words").select("phrase", "item"))
    vocabulary = stage(phrases.select(F.explode(F.col("words").cast("array<binary>")).alias("term")).distinct())
    index = build_index(docs, doc_id, text, vocabulary)
    asked, rows = _asked(index, stage(_plan(index, phrases)))
    hits = stage(asked.groupBy("block").cogroup(rows.groupBy("block")).applyInPandas(_hits, HIT))
    items_hit = (
        hits.select("block", "start", F.explode("phrases").alias("phrase"))
        .join(owners, "phrase")
        .groupBy("block", "start")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    place = ["block", "start"]
    return (
        index.filter(F.col("term").isNull())
        .select(*place, "doc", "key", "n_words")
        .join(hits.select(*place, "n_hit").join(items_hit, place), place, "left")
        .select(
            "doc",
            "key",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def closest_spans(need: Counter, lists: dict[bytes, np.ndarray], reach: int) -> list[tuple[int, int]]:
    """Spans of at most ``reach`` places that hold every term as often as needed and no shorter such span."""
    place = np.concatenate([lists[t] for t in need])
    term = np.repeat(np.arange(len(need)), [len(lists[t]) for t in need])
    order = np.argsort(place, kind="stable")
    place, term = place[order], term[order]
    needs, have, lacking, low, out = list(need.values()), [0] * len(need), len(need), 0, []
    for high in range(len(place)):
        have[term[high]] += 1
        lacking -= have[term[high]] == needs[term[high]]
        while not lacking:
            if have[term[low]] == needs[term[low]]:
                if place[high] - place[low] < reach:
                    out.append((int(place[low]), int(place[high])))
                lacking += 1
            have[term[low]] -= 1
            low += 1
    return out


def near_matches(index: DataFrame, phrases: DataFrame, slop: int) -> DataFrame:
    """Proximity matches of (phrase, words): spans of a document with all words, in any order, and at most ``slop`` others.

    Returns (doc, key, phrase, first, last) with word numbers in the document from 0.
    """

    def near(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        lists, firsts, lengths = _lists(rows)
        for block, p, terms in zip(asked["block"], asked["phrase"], asked["terms"], strict=True):
            need = Counter(bytes(t) for t in terms)
            if not all(t in lists for t in need):
                continue
            for a, b in closest_spans(need, lists, len(terms) + slop):
                doc = np.searchsorted(firsts, a, "right") - 1
                if b < firsts[doc] + lengths[doc]:
                    out.append((block, firsts[doc], p, a - firsts[doc], b - firsts[doc]))
        return pd.DataFrame(out, columns=["block", "start", "phrase", "first", "last"])

    asked, rows = _asked(index, stage_for(index)(_plan(index, phrases)))
    found = asked.groupBy("block").cogroup(rows.groupBy("block")).applyInPandas(near, SPAN)
    docs = index.filter(F.col("term").isNull()).select("block", "start", "doc", "key")
    return found.join(docs, ["block", "start"]).select("doc", "key", "phrase", "first", "last")
