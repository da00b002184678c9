import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from installarc.llm import mixing, queries


def targets(sizes, weights, share, most):
    """Dealt by hand: fix what is above its stop and deal the rest again."""
    out, budget, free = {}, share * sum(sizes.values()), dict(weights)
    while free:
        each = budget / sum(free.values())
        full = [s for s in free if free[s] * each > most * sizes[s]]
        if not full:
            return out | {s: w * each for s, w in free.items()}
        for s in full:
            out[s] = most * sizes[s]
            budget -= out[s]
            del free[s]
    return out


def test_query_on_whole_table(spark, small):
    rows = queries.op1_mix_sources(spark, small).collect()
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    size = {d["doc_id"]: len(re.findall("[^ \t-\r]+", d["text"] or "")) for d in docs}
    by_source = Counter()
    for d in docs:
        by_source[d["source"]] += size[d["doc_id"]]
    names = sorted(by_source)
    want = targets(by_source, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, 1.5, 2.0)
    taken, largest = Counter(), defaultdict(int)
    for r in rows:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == by_source[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in names:
        assert abs(taken[s] - want[s]) <= largest[s]
    assert rows and sorted(rows) == sorted(queries.op1_mix_sources(spark, small).collect())
    assert sorted(rows) == sorted(mix_again(spark, small))


def mix_again(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(7, "n_chars")
    words = F.regexp_count(F.col("text"), F.lit("[^\\x20\\x09-\\x0D]+"))
    counted = docs.select("doc_id", "source", F.coalesce(words, F.lit(0)).alias("words"))
    mixed = mixing.mix(counted, F.col("words"), (5.0, 2.0, 1.0), 1.5, 2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies").collect()


def test_groups_meet_in_a_tree(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), (F.col("id") % 50 + 1).alias("w"))
    got = mixing.mix(docs, F.col("w"), (1.0,), 0.35, 2.0, rows=40, fan_in=3).agg(F.sum("taken"), F.sum("size")).first()
    assert abs(got[0] - 0.35 * got[1]) <= 50


def test_expectation_holds():
    size, p = np.array([5.0, 3.0, 9.0, 1.0]), np.array([0.3, 0.5, 0.2, 0.7])
    rng, total = np.random.default_rng(1), np.zeros(4)
    for _ in range(20_000):
        out = mixing.settle(size, p, rng.random(4))
        assert ((0 < out) & (out < 1)).sum() <= 1
        assert (size * out).sum() == pytest.approx((size * p).sum())
        total += out
    assert np.allclose(total / 20_000, p, atol=0.02)


def test_odd_rows(spark):
    schema = "doc_id long, source string, text string, size string, _x int"
    rows = [(1, "b", "a b c", "x", 1), (1, "b", "a b c", "x", 1), (None, None, None, None, None), (2, None, "", "y", 2)]
    rows += [(3, "", "word", "z", 3), (None, "b", "a b d", "x", 1)]
    docs = spark.createDataFrame(rows, schema)
    words = F.regexp_count(F.col("text"), F.lit("[^ ]+"))
    got = mixing.mix(docs, words, (5.0, 2.0, 1.0), 1.5, 2.0)
    assert got.columns == ["doc_id", "source", "text", "_x", "size", "source_size", "target", "copies", "taken"]
    got = got.collect()
    assert len(got) == 6
    assert all(r["taken"] == 0 for r in got if not r["text"])
    assert {r["source_size"] for r in got if r["source"] == "b"} == {9}
    empty = mixing.mix(docs.limit(0), words, (1.0,), 1.5, 2.0)
    assert empty.count() == 0
    assert mixing.repeated(mixing.mix(docs, words, (1.0,), 1.5, 2.0), docs.columns).columns == docs.columns
