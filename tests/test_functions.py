"""Column functions on hand-made values."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from installarc.functions import dims, events, times
from installarc.functions.money import money, price_gross_usd, price_usd, signed

D = Decimal


def values(spark, schema, data, column):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(column.alias("v")).collect()]


def test_platform_names(spark):
    got = values(spark, "p string", [("iOS",), ("IOS 17",), ("Android",), ("web",), (None,)], dims.platform_of(F.col("p")))
    assert got == ["ios", "ios", "android", "unknown", "unknown"]


def test_store_names_keep_the_wildcard(spark):
    stores = [("app_store",), ("App Store",), ("play-store",), ("Google",), ("web",), (None,)]
    got = values(spark, "s string", stores, dims.store_platform_of(F.col("s")))
    assert got == ["ios", "ios", "android", "android", "unknown", "unknown"]


def test_app_default_and_fallback(spark):
    got = values(spark, "a string, b string", [("x", "y"), ("", "y"), (None, ""), (None, None)], dims.app_of(F.col("a"), F.col("b")))
    assert got == ["x", "y", "unknown", "unknown"]


def test_weeks_start_on_monday(spark):
    days = [(date(2024, 1, 7),), (date(2024, 1, 8),)]
    assert values(spark, "d date", days, dims.week_start(F.col("d"))) == [date(2024, 1, 1), date(2024, 1, 8)]


def test_group_by_uses_the_cleaned_value(spark):
    """Raw spellings of one platform fall into one group."""
    df = spark.createDataFrame([("iOS",), ("IOS",), ("ios",)], "platform string")
    grouped = df.select(dims.platform_of(F.col("platform")).alias("platform")).groupBy("platform").count()
    assert [tuple(r) for r in grouped.collect()] == [("ios", 3)]


def test_rates_that_do_not_scale(spark):
    schema = "p decimal(18,8), r decimal(18,8), m decimal(18,8)"
    data = [
        (D(10), None, None),
        (D(10), D(0), D(-1)),
        (D(10), D(-2), D(0)),
        (D(10), D(4), D("0.5")),
        (None, D(4), D("0.5")),
    ]
    net = price_usd(F.col("p"), F.col("r"), F.col("m"))
    gross = price_gross_usd(F.col("p"), F.col("r"))
    assert values(spark, schema, data, net) == [D(10), D(10), D(10), D("1.25"), D(0)]
    assert values(spark, schema, data, gross) == [D(10), D(10), D(10), D("2.5"), D(0)]


def test_rounding_is_half_up(spark):
    got = values(spark, "x double", [(0.000000015,), (-0.000000015,)], money(F.col("x")))
    assert got == [D("0.00000002"), D("-0.00000002")]


def test_sign_comes_from_the_event(spark):
    got = values(spark, "x int, r boolean", [(5, True), (-5, True), (-5, False)], signed(F.col("x"), F.col("r")))
    assert got == [-5, -5, 5]


def test_revenue_types(spark):
    data = [
        ("sub_month", None),
        ("Consumable", None),
        ("non_consumable", None),
        ("inapp_x", None),
        (None, "NON_RENEWING_PURCHASE"),
        ("other", "CANCELLATION"),
        (None, None),
    ]
    got = values(spark, "k string, t string", data, events.revenue_type_of(F.col("k"), F.col("t")))
    assert got == ["subscription", "inapp", "inapp", "inapp", "inapp", "subscription", "subscription"]


def test_source_prices(spark):
    data = [("play", D(2500000), None), ("app_store", D(1990), None), ("aggregator", D(10), D("0.85")), ("x", D(3), None)]
    price = events.source_price(F.col("s"), F.col("p"), F.col("t"))
    got = values(spark, "s string, p decimal(28,8), t decimal(9,6)", data, price)
    assert got == [D("2.5"), D("1.99"), D("8.5"), D(3)]


def test_refund_signals(spark):
    data = [
        ("play", 101, None, None),
        ("play", 5, "REFUND", "CUSTOMER_SUPPORT"),
        ("app_store", 5, None, None),
        ("app_store", None, "REFUND", None),
        ("aggregator", None, None, "CUSTOMER_SUPPORT"),
        ("aggregator", 101, "REFUND", "UNSUBSCRIBE"),
        (None, None, None, None),
    ]
    signal = events.is_refund_signal(F.col("s"), F.col("n"), F.col("t"), F.col("r"))
    got = values(spark, "s string, n int, t string, r string", data, signal)
    assert got == [True, False, True, True, True, False, False]


def test_local_dates(spark):
    zone = "America/Los_Angeles"
    instants = [(datetime(2024, 7, 1, 3),), (datetime(2024, 7, 1, 7),), (datetime(2024, 1, 1, 7, 59),)]
    got = values(spark, "t timestamp", instants, times.local_date(F.col("t"), zone))
    assert got == [date(2024, 6, 30), date(2024, 7, 1), date(2023, 12, 31)]
    got = values(spark, "d date", [(date(2024, 7, 1),)], times.local_date_of_day(F.col("d"), zone))
    assert got == [date(2024, 6, 30)]


def test_day_filter_equals_conversion(spark):
    for zone in ("America/Los_Angeles", "Asia/Tokyo", "UTC"):
        days = [(date(2024, 3, d),) for d in range(8, 13)]
        start = date(2024, 3, 10)
        direct = times.local_date_of_day(F.col("d"), zone) >= F.lit(start)
        ranged = F.col("d") >= times.first_day_reaching(start, zone)
        assert values(spark, "d date", days, direct) == values(spark, "d date", days, ranged)


def test_timestamp_spellings(spark):
    texts = [
        ("2024-01-02 03:04:05",),
        ("2024-01-02 03:04:05.123456",),
        ("2024-01-02T03:04:05Z",),
        ("2024-01-02T03:04:05.5+02:00",),
        ("2024-01-02",),
        ("1704164645",),
        ("n/a",),
        (None,),
    ]
    got = values(spark, "t string", texts, times.parse_timestamp(F.col("t")))
    at = datetime(2024, 1, 2, 3, 4, 5)
    assert got[:3] == [at, at.replace(microsecond=123456), at]
    assert got[3] == datetime(2024, 1, 2, 1, 4, 5, 500000)
    assert got[4:] == [datetime(2024, 1, 2), at, None, None]


def test_more_spellings_of_timestamps(spark):
    at = datetime(2024, 1, 2, 3, 4, 5)
    texts = ["2024-01-02 03:04:05 UTC", "2024/01/02 03:04:05", "2024-01-02T05:04:05+02", "2024-01-02 03:04:05 gmt", "1704164645000000", "1704164645.25"]
    got = values(spark, "t string", [(t,) for t in [*texts, "2024/01/02", "1.5", "12:30 +02"]], times.parse_timestamp(F.col("t")))
    assert got == [at] * 5 + [at.replace(microsecond=250000), datetime(2024, 1, 2), None, None]
