"""Marts built as tables: identities between them, rebuilds and plan shape."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from installarc.functions import metrics
from installarc.functions.dims import COHORT_KEY
from installarc.plans.build import build_marts
from installarc.settings import RunWindow
from installarc.sources import tables


@pytest.fixture(scope="module")
def built(spark, small, tmp_path_factory):
    inp = entry.Inputs(spark, small)
    inputs = {
        "lifetimes": inp.stored("lifetimes"),
        "activity": inp.stored("activity"),
        "ad_daily": inp.stored("ad_daily"),
        "inapp": inp.raw["inapp"],
        "subscription": inp.raw["subscription"],
        "costs": inp.costs(),
    }
    root = str(tmp_path_factory.mktemp("marts"))
    paths = build_marts(spark, inputs, entry.CONFIG, entry.FULL, root)
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_long_sums_equal_daily_sums(built):
    for metric in (*metrics.PURCHASE_COUNTS, *metrics.AD_COUNTS, *metrics.DAILY_MONEY, *metrics.TOTALS):
        assert total(built["cohort_long"], metric) == total(built["daily"], metric), metric


def test_installs_appear_on_day_zero_only(built):
    late = built["cohort_long"].filter((F.col("day_idx") > 0) & (F.col("installs") + F.col("clicks") > 0))
    assert late.count() == 0
    assert total(built["cohort_long"], "installs") == built["cohort_users"].count()


def test_wide_totals_equal_long_totals(built):
    listed = built["cohort_long"].filter(F.col("application").isin(*entry.CONFIG.apps))
    for metric in (*metrics.WIDE_COUNTS, *metrics.WIDE_MONEY):
        assert total(built["cohort_wide"], f"{metric}_utn") == total(listed, metric), metric


def test_unlimited_new_payers_are_all_payers(built):
    assert built["cohort_wide"].filter("new_payers_utn <> paying_users_utn").count() == 0


def test_buckets_do_not_shrink_while_mature(built):
    grown = built["cohort_wide"].filter("cohort_date <= date '2024-01-01'")
    assert grown.count() > 0
    assert grown.filter("not (purchases_0 <= purchases_3 and purchases_3 <= purchases_30 and purchases_30 <= purchases_utn)").count() == 0


def test_curve_identities(built):
    curves = built["curves"]
    for value in ("ad_revenue_gross", "total_revenue_net"):
        assert curves.filter(f"{value}_prev_day + {value} <> {value}_cumulative").count() == 0
    last = curves.groupBy(*COHORT_KEY).agg(F.max_by("ad_revenue_gross_cumulative", "cohort_day").alias("end"))
    listed = built["cohort_long"].filter(F.col("application").isin(*entry.CONFIG.apps))
    assert total(last, "end") == total(listed, "ad_revenue_gross")


def test_tables_are_partitioned(built, spark):
    plan = built["daily"].filter("event_date = date '2024-01-10'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "month" in built["cohort_long"].columns


def test_rebuilt_days_without_rows_disappear(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(date(2024, 1, d), d) for d in range(1, 11)]
    df = spark.createDataFrame(rows, "day date, v int")
    tables.replace_days(df, path, "day", RunWindow(run_date=date(2024, 1, 11), full_refresh=True), ["day", "v"])
    window = RunWindow(run_date=date(2024, 1, 9), start=date(2024, 1, 5), end=date(2024, 1, 7))
    part = df.filter("day = date '2024-01-06'").withColumn("v", F.lit(60))
    tables.replace_days(part, path, "day", window, ["day", "v"])
    tables.replace_days(part, path, "day", window, ["day", "v"])  # running it again changes nothing
    got = {r.day.day: r.v for r in spark.read.parquet(path).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 6: 60, 8: 8, 9: 9, 10: 10}


@pytest.mark.parametrize("nothing", ["v > 100", "false"])
def test_rebuilding_days_that_became_empty(spark, tmp_path, nothing):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(date(2024, 1, d), d) for d in range(1, 6)], "day date, v int")
    tables.replace_days(df, path, "day", RunWindow(run_date=date(2024, 1, 11), full_refresh=True), ["day", "v"])
    window = RunWindow(run_date=date(2024, 1, 9), start=date(2024, 1, 2), end=date(2024, 1, 3))
    tables.replace_days(df.filter(nothing), path, "day", window, ["day", "v"])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 4, 5]


def test_raw_feeds_get_their_trusted_time(spark, tmp_path):
    path = str(tmp_path / "feed")
    spark.createDataFrame([(datetime(2024, 1, 1), datetime(2020, 1, 1))], "version timestamp, timestamp timestamp").write.parquet(path)
    assert tables.read_table(spark, path, "session_events").columns == ["event_time", "timestamp"]
    assert tables.read_table(spark, path).columns == ["version", "timestamp"]


PLANNED = ["asof_join", "lifetime_activity_daily", "payers", "cohort_wide", "monetization_curves", "revenue_by_source", "inapp_fact"]


@pytest.mark.parametrize("name", PLANNED)
def test_plans_avoid_what_does_not_scale(spark, small, name):
    """No cross joins, no Python rows, no forced broadcasts, no window over everything."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry.queries()[name](spark, small)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for bad in ("CartesianProduct", "NestedLoop", "BroadcastExchange", "EvalPython", "InPandas", "SinglePartition"):
        assert bad not in plan, bad


def test_window_filter_reaches_the_files(spark, built):
    from installarc.plans import cohorts

    window = RunWindow(run_date=date(2024, 1, 20))
    rows = cohorts.inapp_rows(entry.Inputs(spark, "/root/testdata/sf0.001").raw["inapp"], window, entry.CONFIG)
    plan = rows.select("event_time")._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-13" in plan and "2024-01-20" in plan
