"""Stored sketches against exact values, and SQL functions against the column functions."""

from pyspark.sql import functions as F

from installarc.functions import dims, events, money
from installarc.functions.sql import register_functions
from installarc.plans.profile import column_sketches, united, within_error


def test_sketches_of_days_unite(spark):
    df = spark.range(20_000).select(
        (F.col("id") % 7000).alias("n"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), F.col("id") % 11)).alias("t.x"),
        F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).otherwise(F.sqrt("id")).alias("x"),
        F.array("id").alias("a"),
        F.lit(None).cast("string").alias("none"),
        F.expr("date'2024-01-01' + cast(id % 30 as int)").alias("day"),
    )
    stored = column_sketches(df.filter("id < 9000"), "t", F.col("day")).unionByName(column_sketches(df.filter("id >= 9000"), "t", F.col("day")))
    whole = {r["column_name"]: r for r in united(stored).collect()}
    assert {c: r["rows_count"] for c, r in whole.items()} == dict.fromkeys(df.columns, 20_000)
    assert whole["none"]["null_count"] == 20_000 and whole["none"]["distinct_estimate"] == 0 and whole["none"]["q50"] is None
    assert whole["t.x"]["null_count"] == 6667 and whole["t.x"]["distinct_estimate"] == 11
    assert abs(whole["a"]["distinct_estimate"] - 20_000) < 1000 and abs(whole["n"]["q50"] - 3333) < 300
    assert all(r["within_error"] for r in within_error(united(stored), {"t": df.drop("x", "a")}).collect())
    wrong = united(stored).withColumn("distinct_estimate", F.col("distinct_estimate") * 2)
    assert not all(r["within_error"] for r in within_error(wrong, {"t": df.drop("x", "a")}).collect())
    days = united(stored, ("column_name", "day")).filter("column_name = 'n' and day is not null")
    assert days.count() == 30 and column_sketches(df.limit(0), "t").count() == 0


def test_sql_functions_equal_column_functions(spark):
    register_functions(spark)
    names = ["iOS", "ANDROID", "app-store", "Play_Store", "google", "web", "", None]
    kinds = ["Consumable", "non_consumable", "subs", "inapp", "", None]
    rows = [(n, k, e, p, r, m) for n in names for k in kinds for e in ("NON_RENEWING_PURCHASE", None) for p, r, m in ((2.5, 0.0, 0.7), (None, 2.0, None), (3.0, None, -1.0))]
    df = spark.createDataFrame(rows, "n string, k string, e string, p double, r double, m double")
    df.createOrReplaceTempView("sql_rows")
    text = spark.sql(
        "SELECT platform_of(n) a, store_platform_of(n) b, app_of(n, k) c, revenue_type_of(k, e) d, price_usd(p, r, m) x, price_gross_usd(p, r) y FROM sql_rows"
    )
    c = F.col
    plan = df.select(
        dims.platform_of(c("n")).alias("a"), dims.store_platform_of(c("n")).alias("b"), dims.app_of(c("n"), c("k")).alias("c"),
        events.revenue_type_of(c("k"), c("e")).alias("d"), money.price_usd(c("p"), c("r"), c("m")).alias("x"), money.price_gross_usd(c("p"), c("r")).alias("y"),
    )
    assert text.collect() == plan.collect()
    assert "platform_of" not in text._jdf.queryExecution().optimizedPlan().toString()
