"""Partition sinks: any partition value, NULL keys, and tables that change in one step."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from installarc.sources.published import forget_versions, publish_partitions
from installarc.sources.tables import Staging, replace_partitions, upsert_rows

KIND = "k string, v int, p string"
ODD = [("a", 1, None), ("b", 2, "x:y"), ("c", 3, "x/y"), ("d", 4, "50%"), ("e", 5, "p=q"), ("f", 6, "plain"), ("g", 7, "é ü"), ("h", 8, "it's \\")]


def rows(df):
    return sorted((tuple(r) for r in df.select("k", "v", "p").collect()), key=repr)


def text_table(spark, path):
    return spark.read.schema(KIND).parquet(path)


def test_any_value_survives_its_own_write(spark, tmp_path):
    path = str(tmp_path / "t")
    written = replace_partitions(spark.createDataFrame(ODD, KIND), path, "p", ["k"], owned=lambda value: True)
    assert written == {r[2] for r in ODD} and rows(text_table(spark, path)) == sorted(ODD, key=repr)
    replace_partitions(spark.createDataFrame([("n", 9, None), ("c", 4, "x/y")], KIND), path, "p", ["k"], owned=lambda v: v in ("x:y", None))
    assert rows(text_table(spark, path)) == sorted([("n", 9, None), ("c", 4, "x/y"), *[r for r in ODD if r[2] not in (None, "x/y", "x:y")]], key=repr)
    replace_partitions(spark.createDataFrame([("c", 5, "x/y")], KIND), path, "p", ["k"], owned=lambda v: v is None)
    assert [r for r in rows(text_table(spark, path)) if r[2] is None] == []


def test_times_and_dates_as_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    kind = "k string, v int, p timestamp"
    times = [("a", 1, datetime(2024, 1, 1)), ("b", 2, datetime(2024, 1, 1, 10, 30, 0, 500000)), ("c", 3, None)]
    replace_partitions(spark.createDataFrame(times, kind), path, "p", ["k"], owned=lambda value: True)
    assert rows(spark.read.schema(kind).parquet(path)) == sorted(times, key=repr)


def test_upsert_with_null_keys(spark, tmp_path):
    stage = Staging(spark)
    path, keys = str(tmp_path / "t"), ["p", "a", "b"]
    kind = "p string, a string, b string, v int"
    start = [("2024-01-01", "a", None, 1), ("2024-01-01", "a", "x", 1), (None, None, None, 1), (None, "n", "y", 1), ("o:1", "q", None, 1)]
    replace_partitions(spark.createDataFrame(start, kind), path, "p", ["a"])
    new = [("2024-01-01", "a", None, 2), (None, None, None, 2), ("o:1", "q", "z", 2)]
    gone = spark.createDataFrame([("o:1", "q", None, 0), (None, "n", "y", 0)], kind)
    upsert_rows(spark.createDataFrame(new, kind), path, "p", keys, ["a"], stage, gone)
    found = sorted((tuple(r) for r in spark.read.schema(kind).parquet(path).select("p", "a", "b", "v").collect()), key=repr)
    assert found == sorted([*new, ("2024-01-01", "a", "x", 1)], key=repr)


class Stop(Exception):
    pass


def test_published_table_changes_in_one_step(spark, tmp_path):
    root, name = str(tmp_path / "t"), "sink_test"
    first = publish_partitions(spark.createDataFrame(ODD, KIND), name, root, "p", ["k"])
    assert rows(spark.table(name)) == sorted(ODD, key=repr)
    new = spark.createDataFrame([("b", 20, "x:y"), ("n", 1, "new"), ("z", 1, None)], KIND)

    def fail():
        raise Stop

    began = spark.table(name)  # planned before the switch
    with pytest.raises(Stop):
        publish_partitions(new, name, root, "p", ["k"], before_switch=fail)
    assert rows(spark.table(name)) == sorted(ODD, key=repr)
    second = publish_partitions(new, name, root, "p", ["k"], owned=lambda v: v in ("50%", "plain"))
    want = [("b", 20, "x:y"), ("n", 1, "new"), ("z", 1, None), *[r for r in ODD if r[2] not in (None, "x:y", "50%", "plain")]]
    assert rows(spark.table(name)) == sorted(want, key=repr) and first != second
    assert rows(began) == sorted(ODD, key=repr)
    pruned = spark.table(name).filter(F.col("p") == "x:y")
    assert "p=x%253Ay" in pruned.inputFiles()[0] and len(pruned.inputFiles()) == 1
    assert forget_versions(spark, name, root, "p") == 1  # the failed run's; the first one still has partitions
    assert rows(spark.table(name)) == sorted(want, key=repr)
    spark.sql(f"DROP VIEW {name}")
