from collections import Counter
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from installarc.llm import queries, sharding


def jump(key, shards):
    """One key at a time, with whole numbers."""
    now, ahead = -1, 0
    while ahead < shards:
        now = ahead
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        ahead = int((now + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return now


def test_matches_one_key_at_a_time():
    keys = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 500)
    for shards in (1, 2, 24, 1000):
        assert sharding.jump_hash(keys, shards).tolist() == [jump(int(k) % (1 << 64), shards) for k in keys]


def test_query(spark, small):
    rows = queries.op9_shard(spark, small).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        body = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(body) + 8 and r["text_crc32"] == crc32(body)
        assert 0 <= r["shard"] < 24 and r["grown_shard"] in (r["shard"], 24)
    for shard, n in Counter(r["shard"] for r in rows).items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))


def test_odd_rows_and_many_parts(spark):
    docs = spark.createDataFrame(
        [(None, "a", 1), (None, "b", 2), (None, None, 3), (1, "a", 4), (1, "a", 4), (2, "", 5)], "doc_id long, text string, Slot int"
    )
    got = sharding.shard(docs, 3, rows=1)
    assert "slot" in got.columns and "Slot" not in got.columns
    got = got.collect()
    assert len(got) == 6 and len({(r["shard"], r["slot"]) for r in got}) == 6
    assert len({r["shard"] for r in got if r["doc_id"] == 1}) == 1
    big = sharding.shard(spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")), 4, rows=100)
    for r in big.groupBy("shard").agg(F.min("slot").alias("a"), F.max("slot").alias("z"), F.countDistinct("slot").alias("n")).collect():
        assert r["a"] == 0 and r["z"] + 1 == r["n"]
    assert sharding.shard(docs.limit(0), 3).count() == 0
