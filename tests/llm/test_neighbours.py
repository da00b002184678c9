import numpy as np
from pyspark.sql import functions as F

from installarc.llm import neighbours, queries


def test_recall_and_scores(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    v = np.array([r["embedding"] for r in rows], float)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    got = {}
    for r in queries.op10_nearest(spark, small).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hits = 0
    for q in ids[ids % 50 == 0]:
        cos = unit @ unit[ids == q][0]
        order = [i for i in np.lexsort((ids, -cos)) if ids[i] != q][:5]
        hits += len({ids[i] for i in order} & {i for i, _ in got[q].values()})
        for vec, score in got[q].values():
            assert abs(score - cos[ids == vec][0]) < 1e-12
    assert hits >= 0.9 * 5 * (ids % 50 == 0).sum()


def test_ties_odd_vectors_and_blocks(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(1, 40)] + [(0, [1.0, 0.0, 0.5]), (50, [0.0, 1.0, -0.0]), (100, [0.0, 1.0, 0.0])]
    rows += [(60, None), (61, [0.0, 0.0, 0.0]), (62, [1.0, None, 0.0]), (63, [nan, 1.0, 0.0]), (64, [inf, 1.0, 0.0]), (None, [1.0, 0.0, 0.0])]
    rows += [(150, [2.0, 1.0]), (151, [1.0, 1.0]), (200, [1.0]), (100, [0.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    for size in (8192, 2):
        got = neighbours.search(df, F.col("vec_id") % 50 == 0, block_rows=size, block_queries=1 if size == 2 else size).collect()
        by = {}
        for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
            by.setdefault(r["query_id"], []).append(r["vec_id"])
        assert by[0] == [1, 2, 3, 4, 5]
        assert by[50] == [100, 0, 1, 2, 3] and by[100] == [50, 0, 1, 2, 3]
        assert by[150] == [151] and 200 not in by
    assert neighbours.search(df.limit(0), F.lit(True)).count() == 0


def test_extreme_components(spark):
    rows = [(0, [1e300, 1e300]), (1, [1e-300, 0.0]), (2, [3e-320, 3e-320]), (3, [-1e308, 1e308]), (4, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.search(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [2, 4, 1, 3]
    assert np.allclose([r["score"] for r in got], [1.0, 3 / 10**0.5, 0.5**0.5, 0.0], atol=1e-12)


def test_scaling_changes_no_score():
    v = np.random.default_rng(6).normal(size=(300, 64)) * 10.0 ** np.arange(-150, 150)[:, None] / 1e3
    v = v[100:200]
    plain = neighbours.cosines(v[0], v, neighbours.lengths(v))
    small = neighbours.scaled(v)
    assert (neighbours.cosines(small[0], small, neighbours.lengths(small)) == plain).all()


def test_bound_holds():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(400, 64))
    unit, turn = v / np.linalg.norm(v, axis=1, keepdims=True), neighbours.rotation(64)
    codes = neighbours.Codes(unit, turn)
    off = np.abs(codes.estimate(unit[:50], turn) - unit[:50] @ unit.T)
    assert (off <= 3.0 * codes.spread).mean() > 0.99
