"""Cases that the contracts name and that once went wrong, on tiny rows."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from installarc.functions import events, times
from installarc.operators.lookup import attach, rate_lookup, session_match
from installarc.operators.shape import in_shape
from installarc.plans import purchases, subscriptions
from installarc.sources import tables

D = Decimal
KEYS = ["app_name", "client_id"]
T0 = datetime(2024, 1, 10, 10)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def rates(spark, extra=()):
    rows = [
        ("USD", "EUR", date(2024, 1, 5), date(2024, 1, 9), D(2)),
        ("USD", "EUR", date(2024, 1, 12), None, D(4)),
        *extra,
    ]
    schema = "base_currency string, currency string, valid_from_date date, valid_to_date date, value decimal(18,8)"
    return spark.createDataFrame(rows, schema)


def test_rates_have_no_last_day_and_one_base(spark):
    days = [date(2024, 1, 4), date(2024, 1, 5), date(2024, 1, 9), date(2024, 1, 10), date(2024, 1, 12), date(2031, 2, 20)]
    facts = spark.createDataFrame([(i, "EUR", d) for i, d in enumerate(days)] + [(9, None, days[1]), (10, "XXX", days[1])], "id int, cur string, day date")
    other = [("GBP", "EUR", date(2024, 1, 1), None, D(9))]
    got = {r.id: r.rate for r in rate_lookup(facts, rates(spark, other), "cur", F.col("day"), "rate").collect()}
    assert got == {0: None, 1: D(2), 2: D(2), 3: None, 4: D(4), 5: D(4), 9: None, 10: None}
    of_gbp = rate_lookup(facts, rates(spark, other), "cur", F.col("day"), "rate", base="GBP")
    assert {r.rate for r in of_gbp.filter("cur = 'EUR'").collect()} == {D(9)}


def test_an_event_belongs_to_the_latest_started_session_that_holds_it(spark):
    schema = "app_name string, client_id string, session_id string, session_start timestamp, session_end timestamp, n int"
    sessions = spark.createDataFrame(
        [
            ("a", "c", "A", at(0), at(60), 1),
            ("a", "c", "B", at(5), at(6), 2),
            ("a", "c", "C", at(50), at(200), 3),
            ("a", "c", "D", at(55), at(58), 4),
            ("a", "d", "E", at(0), at(0), 5),
            ("a", None, "F", at(0), at(900), 6),
        ],
        schema,
    )
    minutes = {0: "A", 4: "A", 5: "B", 6: "B", 7: "A", 30: "A", 50: "C", 56: "D", 59: "C", 61: "C", 200: "C", 201: None}
    rows = [("a", "c", at(m), m) for m in minutes] + [("a", "d", at(0), 1000), ("a", "d", at(1), 1001), ("a", None, at(1), 1002)]
    found = session_match(spark.createDataFrame(rows, "app_name string, client_id string, t timestamp, id int"), sessions, KEYS, "t", ["n"])
    got = {r.id: r.session_id for r in found.collect()}
    assert got == minutes | {1000: "E", 1001: None, 1002: None}
    assert {r.n for r in found.filter("session_id = 'C'").collect()} == {3}


SUB = (
    "app_name string, transaction_id string, original_transaction_id string, event_transaction_id string, product_id string, period_type string,"
    "is_trial_conversion int, currency string, source string, client_id string, event_time timestamp, type string, price decimal(28,8),"
    "takehome_percentage decimal(9,6), comission_percentage decimal(9,6), store string, country string, state int, notification string, cancel_reason string"
)


def sub(tx, kind, minute, reason=None, source="aggregator", state=None):
    return (
        "a", tx, "chain", f"{tx}-{minute}", "p", "NORMAL", 0, "USD", source, "c", at(minute), kind, D(100),
        D(1), D(0), "play_store", "US", state, None, reason,
    )


def test_a_cancellation_neither_replaces_a_purchase_nor_adds_revenue(spark):
    rows = [
        sub("t1", "INITIAL_PURCHASE", 0),
        sub("t1", "CANCELLATION", 2000, "UNSUBSCRIBE"),
        sub("t2", "RENEWAL", 5),
        sub("t2", "CANCELLATION", 10, "CUSTOMER_SUPPORT"),
        sub("t2", "CANCELLATION", 20, "UNSUBSCRIBE"),
    ]
    fees = spark.createDataFrame([("ANDROID", "US", D(1))], "platform string, country string, vat_income_multiplier decimal(18,8)")
    none = spark.createDataFrame([], "app_name string, transaction_id string, client_id string, country string, trigger_name string, app_version string, session_number int, session_id string, device_name string, device_version string")
    lives = spark.createDataFrame([("a", "c", at(-60), "life")], "app_name string, client_id string, install_time timestamp, user_lifetime_id string")
    stream = subscriptions.subscription_stream([spark.createDataFrame(rows, SUB)], rates(spark), fees)
    fact = subscriptions.subscription_fact(stream, none, lives, rates(spark), fees)
    got = {(r.transaction_id, r.event_name, r.cancel_ind, r.cancel_reason): r for r in fact.collect()}
    assert len(got) == 5
    bought = got["t1", "purchase", 0, None]
    assert bought.event_time == at(0) and bought.price_gross == 100 and bought.refund_ind == 0 and bought.new_user == 1
    ended = got["t1", "refund", 1, "UNSUBSCRIBE"]
    assert ended.price == 0 and ended.price_gross == 0 and ended.cancel_time == at(2000)
    assert got["t2", "refund", 1, "CUSTOMER_SUPPORT"].price_gross == 100
    assert got["t2", "purchase", 0, None].refund_ind == 1
    assert sum(r.price_gross for r in got.values() if r.event_name == "purchase") == 200


def test_play_refunds_by_reason(spark):
    df = spark.createDataFrame([("play", 0, None, "101"), ("play", 101, None, None), ("app_store", 0, None, "101")], "s string, n int, t string, r string")
    signal = events.is_refund_signal(F.col("s"), F.col("n"), F.col("t"), F.col("r"))
    assert [r[0] for r in df.select(signal).collect()] == [True, True, False]


def test_an_impossible_signal_does_not_hide_a_refund(spark):
    staged = spark.createDataFrame([("a", "t", "IOS", at(0))], "app_name string, transaction_id string, platform string, event_time timestamp")
    rows = [("a", "t", at(-5), "early", "play", 101, None, None), ("a", "t", at(9), "late", "play", 101, None, None), ("a", "t", at(7), "mid", "play", 101, None, None)]
    schema = "app_name string, transaction_id string, refund_time timestamp, refund_transaction_id string, source string, state int, notification string, cancel_reason string"
    got = purchases.inapp_refunds(staged, spark.createDataFrame(rows, schema)).collect()
    assert [r.refund_transaction_id for r in got] == ["mid"]


def test_contract_columns(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="misspelt"):
        in_shape(df, ["id", "misspelt"])
    assert in_shape(df, ["id", "later"], {"later": "int"}).dtypes == [("id", "bigint"), ("later", "int")]
    two = spark.createDataFrame([(0, "x"), (0, "y")], "id long, v string")
    assert [r.v for r in attach(df, two, "id").collect()] == ["y"]


@pytest.mark.parametrize(
    "text",
    [
        "2024-01-10T10:00:00Z", "2024-01-10 10:00:00+0000", "2024-01-10 10:00:00 +00:00", "2024-01-10T12:00:00+0200",
        "1704880800000", "1704880800", "2024-01-10 10:00", "2024-01-10T10:00Z", "2024-01-10 10:00:00.000000000", " 2024-01-10 10:00:00 ",
    ],
)
def test_timestamp_spellings(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(times.parse_timestamp(F.col("t"))).first()[0] == T0


def test_a_cluster_needs_a_shared_folder():
    class Session:
        def __init__(self, master, named=None, called=None):
            self.conf = type("Conf", (), {"get": lambda self, key, default=None: named})()
            self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": lambda self: called})()

    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            tables.work_dir(Session(master))
    assert tables.work_dir(Session("yarn", "hdfs://a/b")).startswith("hdfs://a/b/")
    assert tables.work_dir(Session("yarn", None, "hdfs://c")).startswith("hdfs://c/")
    assert tables.work_dir(Session("local[4]"))


def test_nothing_is_left_after_a_run(spark, tmp_path, small):
    import __spark_entry__ as entry

    inp = entry.Inputs(spark, small)
    inp.stage.root = str(tmp_path / "run")
    assert entry.QUERIES["upsert_keys"](inp).count() and (tmp_path / "run").exists()
    inp.stage.drop()
    assert list(tmp_path.iterdir()) == []


def test_vanished_dates_and_keys(spark, tmp_path):
    path, stage = str(tmp_path / "t"), tables.Staging(spark)
    df = spark.createDataFrame([(date(2024, 1, d), k, d) for d in range(1, 6) for k in "ab"], "day date, k string, v int")
    tables.replace_partitions(df, path, "day", ["day", "k"])
    tables.replace_partitions(df.filter("v = 3").withColumn("v", F.lit(30)), path, "day", ["day", "k"], lambda d: d >= "2024-01-03")
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 1, 2, 2, 30, 30]
    new = spark.createDataFrame([(date(2024, 1, 1), "a", 10), (date(2024, 1, 9), "c", 90)], df.schema)
    gone = spark.createDataFrame([(date(2024, 1, 2), "a", 0), (date(2024, 1, 2), "b", 0)], df.schema)
    tables.upsert_rows(new, path, "day", ["day", "k"], ["day", "k"], stage, gone)
    stage.drop()
    got = sorted((r.day.day, r.k, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, "a", 10), (1, "b", 1), (3, "a", 30), (3, "b", 30), (9, "c", 90)]
