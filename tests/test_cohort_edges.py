"""Cohort marts on hand-made rows: the cases that test tables rarely contain."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from installarc.functions import dims
from installarc.plans import cohorts
from installarc.settings import MartConfig, RunWindow

D = Decimal
DAY = date(2024, 3, 1)
CONFIG = MartConfig(
    run_date=date(2024, 3, 20), run_ts=datetime(2024, 3, 20), apps=("A",), cohort_start=date(2024, 1, 1),
    curve_start=date(2024, 1, 1), curve_end=date(2025, 1, 1), max_cohort_day=10,
)
FULL = RunWindow(run_date=CONFIG.run_date, full_refresh=True)

LIFETIME = (
    "app_name string, client_id string, user_lifetime_id string, user_lifetime_number int, install_time timestamp, "
    "install_date date, lifetime_end_time timestamp, platform string, country_code string, media_source string, "
    "promo_campaign string, promo_campaign_id string, ad string, adset string, install_device_name string, install_device_type string"
)
EVENT = (
    "event_name string, client_id string, app_name string, platform string, event_time timestamp, price decimal(18,8), "
    "price_gross decimal(18,8), local_price decimal(18,8), currency string, period_type string, "
    "is_trial_conversion int, type string, cancel_ind int"
)
ACTIVITY = (
    "app_name string, client_id string, activity_date_utc date, sessions_count long, session_duration_seconds_total long, "
    "session_event_count_total long, last_session_end_utc timestamp, app_version_last string"
)
AD = (
    "event_date date, app_name string, client_id string, impressions_count long, impressions_banner long, "
    "impressions_interstitial long, impressions_rewarded long, ad_revenue_total decimal(18,8), revenue_banner decimal(18,8), "
    "revenue_interstitial decimal(18,8), revenue_rewarded decimal(18,8)"
)
COST = (
    "day date, platform string, application string, country string, media_source string, promo_campaign string, "
    "promo_campaign_id string, adset string, ad string, cost decimal(18,8), clicks long, impressions long"
)


def at(day, hour, minute=0):
    return datetime(2024, 3, day, hour, minute)


def life(n, start, end=None, client="c1", app="A", platform="iOS", media=None):
    return (app, client, f"{client}-{n}", n, start, start.date(), end, platform, "US", media, None, None, None, None, None, None)


def buy(when, amount=10, name="purchase", currency="USD", period="NORMAL", client="c1", kind="INITIAL_PURCHASE", conv=0, cancel=None):
    return (name, client, "A", "iOS", when, D(amount), D(amount) * 2, D(amount) * 3, currency, period, conv, kind, cancel)


class World:
    def __init__(self, spark, lifetimes, inapp=(), subs=(), activity=(), ads=(), costs=()):
        make = spark.createDataFrame
        self.lifetimes = make(list(lifetimes), LIFETIME)
        self.inapp, self.subs = make(list(inapp), EVENT), make(list(subs), EVENT)
        self.activity, self.ads = make(list(activity), ACTIVITY), make(list(ads), AD)
        self.costs = make(list(costs), COST)

    def users(self):
        return cohorts.cohort_users(self.lifetimes, CONFIG)

    def daily(self, window=FULL):
        return cohorts.lifetime_activity_daily(
            self.activity, self.inapp, self.subs, self.ads, self.lifetimes, window, CONFIG
        )

    def payers(self):
        return cohorts.payers(self.users(), self.inapp, self.subs, CONFIG)

    def long(self):
        return cohorts.cohort_long(self.users(), self.costs, self.daily(), CONFIG)

    def wide(self):
        return cohorts.cohort_wide(self.long(), self.payers(), cohorts.cohort_activity_utn(self.daily(), CONFIG), CONFIG)


def test_same_day_reinstall_uses_two_rules(spark):
    """Daily facts follow the timestamp; payers and ads follow the date."""
    world = World(
        spark,
        [life(1, at(1, 8), at(1, 12)), life(2, at(1, 12))],
        inapp=[buy(at(1, 9)), buy(at(1, 13), 5), buy(at(1, 7), 1)],
        ads=[(DAY, "A", "c1", 4, 1, 1, 2, D(3), D(1), D(1), D(1))],
    )
    daily = {r.user_lifetime_id: r for r in world.daily().collect()}
    assert daily["c1-1"].inapp_revenue_net == D(10) and daily["c1-2"].inapp_revenue_net == D(5)
    # the first lifetime starts and ends on one date, so it owns no date at all
    assert daily["c1-1"].ad_impressions == 0 and daily["c1-2"].ad_impressions == 4
    payers = world.payers().collect()
    # by date even the purchase before the install belongs to the day's last lifetime
    assert [(r.user_lifetime_id, r.purchases_total, r.inapp_amount_usd_total) for r in payers] == [("c1-2", 3, D(16))]


def test_event_at_the_boundary_belongs_to_the_new_lifetime(spark):
    world = World(spark, [life(1, at(1, 8), at(2, 8)), life(2, at(2, 8))], inapp=[buy(at(2, 8))])
    assert [r.user_lifetime_id for r in world.daily().collect()] == ["c1-2"]


def test_activity_day_follows_its_last_session(spark):
    activity = [("A", "c1", date(2024, 3, 2), 3, 60, 9, at(2, 20), "v2")]
    world = World(spark, [life(1, at(1, 8), at(2, 12)), life(2, at(2, 12))], activity=activity)
    rows = world.daily().collect()
    assert [(r.user_lifetime_id, r.sessions_count, r.app_version_last) for r in rows] == [("c1-2", 3, "v2")]


def test_session_ending_after_midnight_may_precede_the_cohort_day(spark):
    """An activity day older than its lifetime's cohort date is left out."""
    activity = [("A", "c1", date(2024, 3, 1), 1, 60, 2, at(2, 0, 30), "v1")]
    world = World(spark, [life(1, at(2, 0, 10))], activity=activity)
    assert world.daily().count() == 0


def test_clients_that_cannot_be_attributed(spark):
    lifetimes = [life(1, at(1, 8), client=c) for c in ("", dims.ZERO_CLIENT)] + [life(1, at(1, 8), app="")]
    world = World(spark, lifetimes, inapp=[buy(at(1, 9), client=c) for c in ("", None, dims.ZERO_CLIENT)])
    assert world.users().count() == 0 and world.daily().count() == 0


def test_subscription_counters(spark):
    subs = [
        buy(at(1, 9), 10, period="NORMAL", kind="renewal"),
        buy(at(1, 10), 20, period="TRIAL"),
        buy(at(1, 11), 30, period="normal", conv=1),
        buy(at(1, 12), -4, name="refund", period=None, cancel=1),
    ]
    row = World(spark, [life(1, at(1, 8))], subs=subs).daily().first()
    assert (row.purchases, row.subscription_purchases, row.trial_purchases) == (2, 2, 1)
    assert (row.trial_converted_purchases, row.renewal_purchases, row.cancelations) == (1, 1, 1)
    assert (row.refunds, row.subscription_refunds_num) == (1, 1)
    assert row.subs_revenue_gross == D(80) and row.subs_revenue_net == D(36)
    assert row.subs_refunds_revenue_net == D(4) and row.total_revenue_net == D(36)


def test_net_total_contains_ad_gross(spark):
    world = World(
        spark,
        [life(1, at(1, 8))],
        inapp=[buy(at(2, 9))],
        ads=[(date(2024, 3, 2), "A", "c1", 1, 1, 0, 0, D("0.5"), D("0.5"), D(0), D(0))],
    )
    row = world.daily().first()
    assert row.total_revenue_gross == D("20.5") and row.total_revenue_net == D("10.5")


def test_trial_only_user_is_a_payer(spark):
    world = World(spark, [life(1, at(1, 8))], subs=[buy(at(1, 9), period="TRIAL")])
    assert world.daily().first().purchases == 0
    payer = world.payers().first()
    assert (payer.is_subscription_payer, payer.is_inapp_payer, payer.purchases_total) == (1, 0, 1)
    assert payer.first_inapp_purchase_date is None and payer.inapp_currency is None


@pytest.mark.parametrize(
    "currencies, label, total",
    [(["USD", "USD"], "USD", D(60)), (["USD", None], "USD", D(60)), (["USD", "EUR"], "MULTI", None), ([None], "MULTI", None)],
)
def test_currency_label(spark, currencies, label, total):
    bought = [buy(at(1, 9 + i), currency=c) for i, c in enumerate(currencies)]
    row = World(spark, [life(1, at(1, 8))], inapp=bought).payers().first()
    assert (row.inapp_currency, row.inapp_amount_local_total) == (label, total)
    assert (row.subscription_amount_usd_total, row.subscription_amount_local_total) == (D(0), None)


def test_spend_and_installs_without_each_other(spark):
    cost = (DAY, "IOS", "A", "US", "paid", None, None, None, None, D(7), 3, 100)
    world = World(spark, [life(1, at(1, 8))], costs=[cost])
    rows = {r.media_source: r for r in world.long().collect()}
    assert (rows[""].installs, rows[""].cost) == (1, D(0))
    assert (rows["paid"].installs, rows["paid"].cost, rows["paid"].clicks) == (0, D(7), 3)


def test_raw_spellings_share_a_cohort(spark):
    cost = (DAY, "IOS app", "A", "US", None, None, None, None, None, D(7), 3, 100)
    rows = World(spark, [life(1, at(1, 8), platform="iOS")], costs=[cost]).long().collect()
    assert [(r.platform, r.installs, r.cost) for r in rows] == [("ios", 1, D(7))]


def test_wide_buckets_and_maturity(spark):
    """Cohort of March 1st, last full day March 19th: bucket 14 is mature, 30 is not."""
    world = World(
        spark,
        [life(1, at(1, 8))],
        inapp=[buy(at(1, 9)), buy(at(4, 9)), buy(at(18, 9))],
        activity=[("A", "c1", date(2024, 3, 4), 2, 10, 5, at(4, 10), "v")],
    )
    row = world.wide().first()
    assert [row[f"purchases_{b}"] for b in (0, 1, 2, 3, 7, 14, 30, 180, 360, "utn")] == [1, 1, 1, 2, 2, 2, 0, 0, 0, 3]
    assert [row[f"active_users_{b}"] for b in (0, 3, 7, "utn")] == [0, 1, 0, 1]
    assert [row[f"paying_users_{b}"] for b in (0, 3, 30, "utn")] == [1, 1, 0, 1]
    assert [row[f"new_payers_{b}"] for b in (0, 3, "utn")] == [1, 0, 1]
    assert row.installs_0 == 1 and row.total_refunds_revenue_utn == D(0)
    assert len(row) == 336


def test_wide_covers_all_buckets_when_old(spark):
    old = life(1, datetime(2024, 1, 1, 5))
    config = MartConfig(run_date=date(2025, 6, 1), run_ts=datetime(2025, 6, 1), apps=("A",), cohort_start=date(2024, 1, 1))
    window = RunWindow(run_date=config.run_date, full_refresh=True)
    world = World(spark, [old], inapp=[buy(datetime(2024, 1, 1, 6)), buy(datetime(2024, 6, 29, 6)), buy(datetime(2025, 3, 1))])
    users = cohorts.cohort_users(world.lifetimes, config)
    daily = cohorts.lifetime_activity_daily(world.activity, world.inapp, world.subs, world.ads, world.lifetimes, window, config)
    long = cohorts.cohort_long(users, world.costs, daily, config)
    payers = cohorts.payers(users, world.inapp, world.subs, config)
    row = cohorts.cohort_wide(long, payers, cohorts.cohort_activity_utn(daily, config), config).first()
    assert [row[f"purchases_{b}"] for b in (30, 180, 360, "utn")] == [1, 2, 2, 3]


def test_only_listed_apps_case_matters(spark):
    world = World(spark, [life(1, at(1, 8)), life(1, at(1, 8), app="a")])
    assert [r.application for r in world.wide().collect()] == ["A"]


def test_payers_without_long_rows_make_no_wide_row(spark):
    world = World(spark, [life(1, at(1, 8))], inapp=[buy(at(1, 9))])
    empty = world.long().filter(F.lit(False))
    assert cohorts.cohort_wide(empty, world.payers(), cohorts.cohort_activity_utn(world.daily(), CONFIG), CONFIG).count() == 0


def test_curve_is_dense(spark):
    """First value on day 2: zeros before, flat after, cut at the configured last day."""
    world = World(
        spark, [life(1, at(1, 8))], ads=[(date(2024, 3, d), "A", "c1", 1, 1, 0, 0, D(d), D(d), D(0), D(0)) for d in (3, 5)]
    )
    rows = sorted(cohorts.monetization_curves(world.long(), CONFIG).collect(), key=lambda r: r.cohort_day)
    assert [r.cohort_day for r in rows] == list(range(11))
    assert [int(r.ad_revenue_gross) for r in rows[:6]] == [0, 0, 3, 0, 5, 0]
    assert [int(r.ad_revenue_gross_cumulative) for r in rows[:6]] == [0, 0, 3, 3, 8, 8]
    assert [int(r.ad_revenue_gross_prev_day) for r in rows[:6]] == [0, 0, 0, 3, 3, 8]
    assert {r.installs for r in rows} == {1} and {r.ad_revenue_gross_day0 for r in rows} == {D(0)}


def test_curve_without_day0_row_and_young_cohort(spark):
    """A cohort whose only row lies after its mature day still gets its grid of zeros."""
    world = World(spark, [life(1, at(18, 8))], ads=[(date(2024, 3, 19), "A", "c1", 1, 1, 0, 0, D(2), D(2), D(0), D(0))])
    no_day0 = world.long().filter("day_idx > 0").withColumn("day_idx", F.lit(5))
    rows = sorted(cohorts.monetization_curves(no_day0, CONFIG).collect(), key=lambda r: r.cohort_day)
    assert [(r.cohort_day, int(r.ad_revenue_gross_cumulative)) for r in rows] == [(0, 0), (1, 0)]


def test_lifetime_ending_on_the_first_window_day_is_kept(spark):
    """Rebuilding a window gives the same rows for its days as a full build."""
    world = World(
        spark,
        [life(1, at(1, 8), at(10, 12)), life(2, at(10, 12))],
        inapp=[buy(at(10, 9)), buy(at(10, 13), 5), buy(at(9, 9), 3)],
    )
    full = world.daily().filter(F.col("event_date") >= date(2024, 3, 10))
    part = world.daily(RunWindow(run_date=CONFIG.run_date, start=date(2024, 3, 10)))
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, part.collect()))
    assert part.count() == 2


def test_window_modes():
    run = date(2024, 3, 20)
    day = date(2024, 3, 5)
    modes = {
        "lookback": RunWindow(run_date=run),
        "full": RunWindow(run_date=run, full_refresh=True),
        "start": RunWindow(run_date=run, start=day),
        "end": RunWindow(run_date=run, end=day),
        "both": RunWindow(run_date=run, start=day, end=date(2024, 3, 25), full_refresh=True),
    }
    yesterday = date(2024, 3, 19)
    assert {k: (w.first_day, w.last_day) for k, w in modes.items()} == {
        "lookback": (date(2024, 3, 13), yesterday),
        "full": (None, yesterday),
        "start": (day, yesterday),
        "end": (None, day),
        "both": (day, yesterday),
    }
    assert [w.is_partial for w in modes.values()] == [True, False, True, True, True]
