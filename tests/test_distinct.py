"""Bitmap distincts against plain sets."""

import random

from pyspark.sql import functions as F

from installarc.operators.distinct import bitmaps, counted, counted_in_both, number_new
from installarc.sources.tables import Staging


def test_numbers_stay_and_have_no_gaps(spark):
    stage = Staging(spark)
    first = stage(number_new(spark.range(0, 5000).select(F.col("id").cast("string").alias("u")).repartition(7), None, stage))
    ids = spark.range(2500, 9000).select(F.col("id").cast("string").alias("u")).union(spark.createDataFrame([(None,), ("2500",)], "u string"))
    second = stage(number_new(ids, first, stage))
    numbers = [r["number"] for r in first.unionByName(second).collect()]
    assert sorted(numbers) == list(range(9000)) and second.count() == 4000
    assert number_new(ids.limit(0), first, stage).count() == 0 and number_new(ids.limit(0), None, stage).count() == 0


def test_counts_add_up_over_any_parts(spark):
    rnd, rows = random.Random(2), []
    for _ in range(3000):
        rows.append((rnd.randrange(10), rnd.choice(["a", "b", None]), rnd.choice([rnd.randrange(50), rnd.randrange(200_000), None])))
    df = spark.createDataFrame(rows, "day int, app string, number long")
    parts = bitmaps(df, ["day", "app"])
    want = {}
    for day, app, n in rows:
        if n is not None:
            want.setdefault((day // 3, app), set()).add(n)
    got = counted(parts.withColumn("span", F.floor(F.col("day") / 3)), ["span", "app"], "n").collect()
    assert {(r["span"], r["app"]): r["n"] for r in got} == {k: len(v) for k, v in want.items()}
    one, other = parts.filter("day < 3").drop("day"), parts.filter("day between 3 and 5").drop("day")
    both = {r["app"]: r["n"] for r in counted_in_both(one, other, ["app"], "n").collect()}
    assert both == {a: n for a in ("a", "b", None) if (n := len(want[(0, a)] & want[(1, a)]))}
    assert counted(parts.limit(0), ["app"], "n").count() == 0
