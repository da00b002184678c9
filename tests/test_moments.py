"""Correlations of all pairs against numpy and pandas, and ranks over many ranges."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from installarc.operators import moments
from installarc.operators.moments import average_ranks, pair_correlations, rank_correlations
from installarc.sources.tables import Staging


def _table(rows=3000):
    rng = np.random.default_rng(5)
    base = rng.normal(size=rows)
    df = pd.DataFrame({
        "x": base,
        "big": 1e9 + base * 0.01 + rng.normal(size=rows) * 0.01,
        "mostly 0": np.where(rng.random(rows) < 0.7, 0.0, np.round(base * 3)),
        "gaps.x": np.where(rng.random(rows) < 0.4, np.nan, base**3),
        "same": 0.1,
        "few": np.where(np.arange(rows) < rows - 1, np.nan, 1.0),
    })
    df.loc[7, "x"] = np.inf
    df.loc[8, "mostly 0"] = -0.0
    return df


@pytest.mark.parametrize("block", [2, 256])
def test_pairs_equal_numpy(spark, block):
    pdf = _table()
    df = spark.createDataFrame(pdf).repartition(5).withColumn("none", F.lit(None).cast("int"))
    names = [*pdf.columns, "none"]
    pdf["none"] = np.nan
    plain = pdf.replace([np.inf], np.nan)
    got = {(r["feature_a"], r["feature_b"]): r for r in pair_correlations(df, names, block).collect()}
    by_rank = {(r["feature_a"], r["feature_b"]): r for r in rank_correlations(df, names, Staging(spark), block).collect()}
    assert len(got) == len(by_rank) == len(names) * (len(names) - 1) // 2
    ranks = plain.rank()
    for (a, b), row in got.items():
        both = plain[a].notna() & plain[b].notna()
        assert row["rows_count"] == by_rank[(a, b)]["rows_count"] == both.sum()
        for found, table in ((row, plain), (by_rank[(a, b)], ranks)):
            x, y = table.loc[both, a], table.loc[both, b]
            if both.sum() < 2 or x.nunique() < 2 or y.nunique() < 2:
                assert found["correlation"] is None, (a, b)
            else:
                assert math.isclose(found["correlation"], np.corrcoef(x, y)[0, 1], abs_tol=1e-6), (a, b)


def test_ranks_count_on_over_ranges(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).select((F.col("id") % 3).cast("int").alias("g"), F.when(F.col("id") % 2 == 0, F.lit(0.0)).otherwise(F.col("id") % 701 - 300.0).alias("v"))
        got = {(r["g"], r["v"]): r["average_rank"] for r in average_ranks(df, "g", "v", Staging(spark)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    pdf = df.toPandas()
    pdf["r"] = pdf.groupby("g")["v"].rank()
    assert got == {(g, v): r for g, v, r in pdf.drop_duplicates().itertuples(index=False)}


def test_frequent_and_rare_values_keep_their_ranks(spark, monkeypatch):
    monkeypatch.setattr(moments, "FREQUENT", 4)
    pdf = pd.DataFrame({"a": [0, 0, 0, 1, 2, 3, None, 0], "b": [5, 5, 1, 2, 3, 4, 4, 9]}, dtype=float)
    got = moments.ranked(spark.createDataFrame(pdf), ["a", "b"], Staging(spark)).toPandas()
    want = pdf.rank()
    key = lambda t: sorted(map(tuple, t.fillna(-1).to_numpy().tolist()))
    assert key(got) == key(want)


def test_empty_table(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert rank_correlations(df, ["a", "b"], Staging(spark)).collect() == []
    assert pair_correlations(df, ["a", "b"]).collect() == []


def _shuffled(plan) -> int:
    """Rows that the shuffles of an executed plan wrote."""
    name, found = plan.nodeName(), 0
    if name.startswith("AdaptiveSparkPlan"):
        return _shuffled(plan.executedPlan())
    if name.endswith("QueryStage"):
        return _shuffled(plan.plan())
    if name == "Exchange":
        found = plan.metrics().apply("shuffleRecordsWritten").value()
    return found + sum(_shuffled(plan.children().apply(i)) for i in range(plan.children().length()))


def test_frequent_cells_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(moments, "FREQUENT", 10)
    rng, rows, columns = np.random.default_rng(3), 500, 30
    x = np.where(rng.random((rows, columns)) < 0.9, 0.0, rng.normal(size=(rows, columns)))
    x[:20, :3] = np.nan
    pdf = pd.DataFrame(x, columns=[f"c.{i}" for i in range(columns)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = moments.ranked(spark.createDataFrame(pdf).repartition(4), list(pdf.columns), Staging(spark))
        found = np.array([list(r) for r in got.collect()], dtype=float)
        shuffled = _shuffled(got._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    key = lambda t: sorted(map(tuple, np.nan_to_num(t, nan=-1.0).tolist()))
    assert key(found) == key(pdf.rank().to_numpy())
    rare = int((np.nan_to_num(x) != 0).sum())
    most = rows + 3 * rare + 10 * columns  # rows; rare cells by value and by row, ranks of rare values; totals of columns
    assert 0 < shuffled <= most < rows * columns
