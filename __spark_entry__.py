
from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from installarc.functions import dims
from installarc.functions.money import price_gross_usd, price_usd
from installarc.functions.sql import register_functions, register_lifetimes
from installarc.operators.lookup import attach, rate_lookup
from installarc.operators.overlap import overlap_join
from installarc.operators.shape import padded_union
from installarc.operators.timeline import asof_join, interval_join
from installarc.plans import active, attribution, cohorts, curves, features, payloads, profile, purchases, reference, revenue, sessions, subscriptions
from installarc.plans.build import build_marts
from installarc.settings import MartConfig, RunWindow, prepare
from installarc.sources.bucketed import match_pair, write_pair
from installarc.sources.changes import changed_days, newest_change, rebuild_changed
from installarc.sources.published import publish_partitions
from installarc.sources.sample import BASE_TABLES, Sample
from installarc.sources.tables import EVENT_TIME_COLUMNS, Staging, read_table, replace_days, replace_partitions, upsert_rows

try:  # the operators for training data can be left out
    from installarc.llm import queries as llm_queries
except ImportError:
    llm_queries = None
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None

FIRST_DAY, RUN_DATE = date(2024, 1, 1), date(2024, 2, 1)

CONFIG = MartConfig(
    run_date=RUN_DATE,
    run_ts=datetime(2024, 2, 1),
    apps=("App A", "App A GP", "app b ios"),
    revenue_apps=("app a", "app a gp", "app b ios"),
    cohort_start=FIRST_DAY,
    curve_start=FIRST_DAY,
    curve_end=RUN_DATE,
    max_cohort_day=30,
    revenue_start=date(1995, 1, 1),
)
FULL = RunWindow(run_date=RUN_DATE, full_refresh=True)

USER = ["app_name", "client_id"]


class Inputs:
    """Plan inputs derived from one directory of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.raw = Sample(prepare(spark), sf_dir)
        self.stage = Staging(spark)
        self._stored: dict[str, DataFrame] = {}
        self._lazy: dict[str, DataFrame] = {}

    def stored(self, name: str) -> DataFrame:
        """An input that several steps of one query read, as a staged table."""
        if name not in self._stored:
            self._stored[name] = self.stage(getattr(self, name)())
        return self._stored[name]

    def once(self, name: str) -> DataFrame:
        """An input built once per query but left lazy, so unused columns are never computed."""
        if name not in self._lazy:
            self._lazy[name] = getattr(self, name)()
        return self._lazy[name]

    def lifetimes(self) -> DataFrame:
        return attribution.install_lifetimes(self.raw["installs"])

    def sessions(self) -> DataFrame:
        return sessions.sessions(self.raw["session_events"])

    def activity(self) -> DataFrame:
        return sessions.activity_daily(
            self.sessions(), self.stored("lifetimes"), RUN_DATE, CONFIG.run_ts, self.stage
        )

    def ad_daily(self) -> DataFrame:
        return revenue.ad_user_daily(self.raw["ad_primary"], self.raw["ad_history"], CONFIG.run_ts, self.stage)

    def rates(self) -> DataFrame:
        return reference.rates_scd2(self.raw["rate_snapshots"])

    def costs(self) -> DataFrame:
        a = revenue.network_spend(
            self.raw["spend_a"],
            "net_1",
            {
                "day": "report_time",
                "platform": "os",
                "application": "app",
                "country": "geo",
                "promo_campaign": "campaign",
                "promo_campaign_id": "campaign_id",
                "adset": "ad_group",
                "adset_id": "ad_group_id",
                "ad": "creative",
                "ad_id": "creative_id",
                "site_id": "publisher",
                "cost": "spend",
                "clicks": "clicks",
                "impressions": "shows",
            },
        )
        b = revenue.network_spend(
            self.raw["spend_b"],
            "net_2",
            {
                "day": "report_day",
                "platform": "platform",
                "application": "application",
                "ad": "keyword",
                "keywords": "keyword",
                "currency": "currency",
                "cost": "local_cost",
                "clicks": "clicks",
                "impressions": "impressions",
            },
        )
        return revenue.ua_costs([a, b], self.rates(), self.stage)

    def users(self) -> DataFrame:
        return cohorts.cohort_users(self.stored("lifetimes"), CONFIG)

    def daily(self, window: RunWindow = FULL) -> DataFrame:
        return cohorts.lifetime_activity_daily(
            self.once("activity"),
            self.raw["inapp"],
            self.raw["subscription"],
            self.stored("ad_daily"),
            self.stored("lifetimes"),
            window,
            CONFIG,
            self.stage,
        )

    def long(self) -> DataFrame:
        return cohorts.cohort_long(self.users(), self.costs(), self.stored("daily"), CONFIG)

    def payers(self) -> DataFrame:
        return cohorts.payers(self.users(), self.raw["inapp"], self.raw["subscription"], CONFIG)

    def utn(self) -> DataFrame:
        return cohorts.cohort_activity_utn(self.stored("daily"), CONFIG)

    def revenue(self) -> DataFrame:
        raw = self.raw
        return revenue.revenue_by_source(
            raw["subscription"],
            raw["inapp"],
            raw["payments"],
            revenue.ad_feed(raw["ad_history"]),
            revenue.store_feed(raw["store_raw"]),
            revenue.attribution_feed(raw["attribution_raw"]),
            revenue.ad_feed(raw["ad_primary"], "project"),
            CONFIG,
        )

    def staged(self) -> DataFrame:
        raw = self.raw
        return purchases.inapp_staged(
            raw["purchases_raw"],
            raw["products"],
            raw["validations"],
            raw["fees"],
            self.rates(),
            self.stored("sessions"),
            raw["campaigns"],
            self.stage,
        )

    def refunds(self) -> DataFrame:
        return purchases.inapp_refunds(self.stored("staged"), self.raw["refund_candidates"])

    def stream(self) -> DataFrame:
        raw = self.raw
        feeds = [raw["sub_aggregator"], raw["sub_app_store"], raw["sub_play"]]
        return subscriptions.subscription_stream(feeds, self.rates(), raw["fees"], self.stage)

    def context(self) -> DataFrame:
        raw = self.raw
        return subscriptions.subscription_context(
            raw["paid_activations"], raw["trial_activations"], self.stored("sessions")
        )

    def profile(self) -> DataFrame:
        facts = {"orders", "lineitem", "events", "conversations"}
        layers = {t: "facts" if t in facts else "dimensions" for t in BASE_TABLES}
        return reference.table_profile({t: self.raw[t] for t in BASE_TABLES}, layers)

    def attribution_events(self) -> DataFrame:
        return attribution.attribution_events(self.raw["raw_installs"], self.raw["raw_reinstalls"])


# --- one function per registered query --------------------------------------------


def asof_query(inp: Inputs) -> DataFrame:
    payload = ["user_lifetime_id", "install_time", "lifetime_end_time"]
    found = asof_join(inp.raw["inapp"], inp.stored("lifetimes"), USER, "event_time", "install_time", payload)
    return found.select(*USER, "event_name", "event_time", "price", *payload)


def interval_query(inp: Inputs) -> DataFrame:
    found = interval_join(
        inp.raw["inapp"],
        inp.stored("lifetimes"),
        USER,
        "event_time",
        "install_time",
        "lifetime_end_time",
        ["user_lifetime_id", "user_lifetime_number"],
    )
    return found.select(*USER, "event_name", "event_time", "price", "user_lifetime_id", "user_lifetime_number")


def bucketed_query(inp: Inputs) -> DataFrame:
    """Purchases in lifetimes, both stored in buckets of clients.."""
    keys = ["app_name", "client_id"]
    bought = inp.raw["inapp"].select(*keys, "event_name", "event_time", "price")
    spans = inp.stored("lifetimes").select(*keys, "install_time", "lifetime_end_time", "user_lifetime_id", "user_lifetime_number")
    name = f"owned_{uuid.uuid4().hex[:12]}"
    pair = write_pair(bought, spans, name, keys, "event_time", "install_time", "lifetime_end_time", 16, inp.stage)
    return match_pair(inp.raw.spark, pair, ["user_lifetime_id", "user_lifetime_number"])


def overlap_query(inp: Inputs) -> DataFrame:
    """Purchases in the lifetimes that run or ended less than three days before: every one, and the one begun last."""
    spans = inp.stored("lifetimes").withColumn("until", F.col("lifetime_end_time") + F.expr("INTERVAL 3 DAYS"))
    payload = ["user_lifetime_id", "install_time"]
    found = [
        overlap_join(inp.raw["inapp"], spans, USER, "event_time", "install_time", "until", payload, keep=keep, how=how).withColumn(
            "mode", F.lit(keep)
        )
        for keep, how in (("all", "inner"), ("latest", "left"))
    ]
    return padded_union(found).select(*USER, "event_name", "event_time", "price", *payload, "mode")


def date_range_query(inp: Inputs) -> DataFrame:
    users = cohorts.window_lifetimes(inp.stored("lifetimes"), None, FULL, CONFIG)
    rows = cohorts.ad_rows(inp.stored("ad_daily"), FULL, CONFIG)
    found = cohorts.match_by_day(rows, users, ["user_lifetime_id"], "install_time")
    return found.select(
        "event_date", "application", "client_id", "user_lifetime_id", "ad_impressions", "ad_revenue_gross"
    )


def active_lifetimes_query(inp: Inputs) -> DataFrame:
    window = RunWindow(run_date=date(2024, 1, 20))
    frames = [
        cohorts.activity_rows(inp.once("activity"), window, CONFIG),
        cohorts.inapp_rows(inp.raw["inapp"], window, CONFIG),
        cohorts.subscription_rows(inp.raw["subscription"], window, CONFIG),
        cohorts.ad_rows(inp.stored("ad_daily"), window, CONFIG),
    ]
    return cohorts.window_lifetimes(inp.stored("lifetimes"), cohorts.window_clients(frames), window, CONFIG)


def price_query(inp: Inputs) -> DataFrame:
    rate, fee = F.col("currency_rates_denominator"), F.col("vat_income_multiplier")
    return inp.raw["inapp"].select(
        "client_id",
        "event_time",
        "local_price",
        price_usd(F.col("local_price"), rate, fee).alias("price_usd"),
        price_gross_usd(F.col("local_price"), rate).alias("price_gross_usd"),
    )


def rate_lookup_query(inp: Inputs) -> DataFrame:
    facts = inp.raw["purchases_raw"].select("transaction_id", "version", "currency", "event_time")
    day = F.to_date("event_time")
    return rate_lookup(facts, inp.rates(), "currency", day, "rate", stage=inp.stage)


def dimension_query(inp: Inputs) -> DataFrame:
    nations = inp.raw["nation"].select(F.col("n_name").alias("country_code"), "n_nationkey", "n_regionkey")
    located = attach(inp.stored("lifetimes"), nations, "country_code")
    regions = inp.raw["region"].select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return (
        attach(located, regions, "n_regionkey", {"r_name": "unknown"})
        .groupBy(F.col("r_name").alias("region"), dims.platform_of(F.col("platform")).alias("platform"))
        .agg(F.count(F.lit(1)).alias("lifetimes"))
    )


def revenue_feed_query(inp: Inputs) -> DataFrame:
    """The four daily feeds stacked under their names."""
    raw = inp.raw
    feeds = {
        "attribution": revenue.attribution_feed(raw["attribution_raw"]),
        "store": revenue.store_feed(raw["store_raw"]),
        "ad_impression": revenue.ad_feed(raw["ad_primary"], "project", source_table="ad_impressions"),
        "ad_user": revenue.ad_feed(raw["ad_history"], source_table="ad_users"),
    }
    return padded_union([df.withColumn("feed", F.lit(name)) for name, df in feeds.items()])


def json_query(inp: Inputs) -> DataFrame:
    snaps = reference.campaign_snapshots(inp.raw["snapshots_raw"])
    blocks = {
        "goal": reference.campaign_goals(snaps),
        "budget": reference.campaign_budgets(snaps),
        "target": reference.campaign_targeting(snaps),
    }
    return padded_union([df.withColumn("kind", F.lit(kind)) for kind, df in blocks.items()])


def first_24h_query(inp: Inputs) -> DataFrame:
    return sessions.first_24h(inp.raw["session_events"], inp.stored("lifetimes"))


def source_compare_query(inp: Inputs) -> DataFrame:
    raw = inp.raw
    keys = ["event_date", "app_name", "ad_type"]
    return revenue.compare_ad_sources(
        revenue.ad_feed(raw["ad_primary"]), revenue.ad_feed(raw["ad_history"]), keys, "revenue_total"
    )


def feature_pairs_query(inp: Inputs) -> DataFrame:
    """All pairs of 178 features: every daily metric on the first six days, and later sums."""
    out = features.feature_pairs(inp.daily(), 6, RUN_DATE, inp.stage)
    return out.withColumns({c: F.round(c, 6) for c in ("pearson", "spearman")})


def feature_corr_query(inp: Inputs) -> DataFrame:
    signals = cohorts.early_signals(inp.daily(), 2)
    early = [c for c in signals.columns if c.startswith("early_")]
    out = reference.feature_correlation(signals, early, "later_revenue")
    return out.withColumn("correlation", F.round("correlation", 6))


def incremental_query(inp: Inputs) -> DataFrame:
    """Facts built up to a day, then continued by a lookback run; equal to a full build."""
    spark, path = inp.raw.spark, inp.stage.folder()
    order = ["event_date", "application", "client_id", "user_lifetime_id"]
    early = RunWindow(run_date=date(2024, 1, 27), full_refresh=True)
    late = RunWindow(run_date=RUN_DATE)
    replace_days(inp.daily(early), path, "event_date", early, order)
    replace_days(inp.daily(late), path, "event_date", late, order)
    return daily_sums(spark.read.parquet(path))


def daily_sums(stored: DataFrame) -> DataFrame:
    return stored.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("lifetimes"),
        F.sum("sessions_count").alias("sessions_count"),
        F.sum("purchases").alias("purchases"),
        F.sum("total_revenue_gross").cast("decimal(18,8)").alias("total_revenue_gross"),
        F.sum("total_revenue_net").cast("decimal(18,8)").alias("total_revenue_net"),
    )


def late_query(inp: Inputs) -> DataFrame:
    """Facts of a run that missed some purchases of a day, mended once the file with them is there; equal to a full build."""
    spark, feed, path = inp.raw.spark, inp.stage.folder(), inp.stage.folder()
    order = ["event_date", "application", "client_id", "user_lifetime_id"]
    late = (F.to_date("event_time") == date(2024, 1, 9)) & (F.crc32(F.col("client_id").cast("binary")) % 3 == 0)
    rows = inp.stage(inp.raw["inapp"].withColumn("late", F.coalesce(late, F.lit(False))))

    def build(window: RunWindow) -> DataFrame:
        return cohorts.lifetime_activity_daily(
            inp.once("activity"), spark.read.parquet(feed), inp.raw["subscription"], inp.stored("ad_daily"), inp.stored("lifetimes"), window, CONFIG, inp.stage
        )

    rows.filter("not late").drop("late").write.parquet(feed)
    seen = newest_change(spark, feed)
    replace_days(build(FULL), path, "event_date", FULL, order)
    rows.filter("late").drop("late").write.mode("append").parquet(feed)
    days = changed_days(spark, feed, F.col("event_time"), seen)
    rebuild_changed(build, path, "event_date", order, [days], RUN_DATE, RunWindow(run_date=RUN_DATE, lookback_days=2))
    return daily_sums(spark.read.parquet(path))


def session_runs(inp: Inputs) -> tuple[str, str]:
    """Tables of sessions and of daily activity after two runs, of which the first saw half of the 12th only."""
    parts, rows, daily = inp.stage.folder(), inp.stage.folder(), inp.stage.folder()
    events = inp.raw["session_events"]
    runs = [
        (events.filter(F.col("event_time") < datetime(2024, 1, 12, 12, 30)), RunWindow(run_date=date(2024, 1, 13), full_refresh=True)),
        (events, RunWindow(run_date=RUN_DATE, start=date(2024, 1, 12))),
    ]
    for seen, window in runs:
        sessions.store_parts(seen, parts, window)
        days = sessions.update_sessions(parts, rows, window, inp.stage)
        sessions.update_activity(rows, daily, days, inp.stored("lifetimes"), RUN_DATE, CONFIG.run_ts, inp.stage)
    return rows, daily


def incremental_sessions_query(inp: Inputs) -> DataFrame:
    return inp.raw.spark.read.parquet(session_runs(inp)[0]).drop("start_date")


def incremental_activity_query(inp: Inputs) -> DataFrame:
    return inp.raw.spark.read.parquet(session_runs(inp)[1])


def sql_prices_query(inp: Inputs) -> DataFrame:
    """Prices, platform and kind of each payment in SQL text alone."""
    spark = inp.raw.spark
    register_functions(spark)
    inp.raw["payments"].createOrReplaceTempView("payments_in_sql")
    return spark.sql(
        "SELECT payment_id, received_at, app_of(application, NULL) AS app_name, store_platform_of(store_name) AS platform, "
        "revenue_type_of(product_id_type, type) AS revenue_type, "
        "price_gross_usd(price, currencyRatesDenominator) AS price_gross_usd, price_usd(price, currencyRatesDenominator, 0.5) AS price_usd "
        "FROM payments_in_sql"
    )


def sql_lifetimes_query(inp: Inputs) -> DataFrame:
    """Lifetimes of some days by platform, from a table function in SQL text."""
    spark = inp.raw.spark
    register_functions(spark)
    register_lifetimes(spark, inp.stored("lifetimes"))
    return spark.sql(
        "SELECT platform_of(platform) AS platform, count(*) AS lifetimes, count_if(lifetime_end_time IS NULL) AS open_lifetimes, "
        "min(install_time) AS first_install FROM lifetimes_in(DATE '2024-01-10', DATE '2024-01-12') GROUP BY 1"
    )


def odd_payloads(inp: Inputs) -> DataFrame:
    """Campaign snapshots of which some have their blocks deeper, numbers as text, or a payload cut short."""
    odd = F.length("payload") % 4
    deeper = F.concat(F.lit('{"data":[{"v2":'), "payload", F.lit("}]}"))
    as_text = F.replace("payload", F.lit('"DE":1.5'), F.lit('"DE":"1.5"'))
    shown = F.when(odd == 1, deeper).when(odd == 2, as_text).when(odd == 3, F.expr("left(payload, length(payload) - 3)"))
    return inp.raw["snapshots_raw"].distinct().withColumn("payload", F.coalesce(shown, F.col("payload")))


def odd_payload_query(inp: Inputs) -> DataFrame:
    """Country blocks of payloads of any shape, and how many of each campaign are broken."""
    rows = inp.stage(odd_payloads(inp))
    found = payloads.named_blocks(rows, ["account_id", "snapshot_ts", "campaign_id"])
    broken = payloads.broken_payloads(rows, ["account_id", "campaign_id"]).withColumn("kind", F.lit("payloads"))
    return padded_union([found, broken])


PROFILED = {"customer": None, "orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


def column_profile_query(inp: Inputs) -> DataFrame:
    """Every column of some tables from sketches stored by month, with exact values held against the estimates."""
    path, tables = inp.stage.folder(), {name: inp.raw[name] for name in PROFILED}
    for name, day in PROFILED.items():
        month = F.trunc(F.col(day).cast("date"), "month") if day else None
        profile.column_sketches(tables[name], name, month).write.mode("append").parquet(path)
    return profile.within_error(profile.united(inp.raw.spark.read.parquet(path)), tables)


def incremental_curves_query(inp: Inputs) -> DataFrame:
    """Curves after three runs; what the first saw of its last two days was wrong, and one of its cohorts is gone later."""
    path, long = inp.stage.folder(), inp.stage(inp.long())
    last_days = F.col("event_date") >= date(2024, 1, 13)
    wrong = long.withColumn("total_revenue_net", F.when(last_days, F.col("total_revenue_net") * 2 + 1).otherwise(F.col("total_revenue_net")))
    kind = long.schema["total_revenue_net"].dataType
    wrong = wrong.withColumn("total_revenue_net", F.col("total_revenue_net").cast(kind))
    gone = long.filter(last_days & (F.col("day_idx") == 0)).withColumn("ad", F.lit("gone"))
    runs = [
        (wrong.unionByName(gone), RunWindow(run_date=RUN_DATE, end=date(2024, 1, 14))),
        (long, RunWindow(run_date=RUN_DATE, start=date(2024, 1, 13), end=date(2024, 1, 24))),
        (long, RunWindow(run_date=RUN_DATE, start=date(2024, 1, 25))),
    ]
    for seen, window in runs:
        curves.store_curves(seen, path, window, CONFIG, inp.stage)
    return curves.curves_of(inp.raw.spark.read.parquet(path), CONFIG)


def active_query(inp: Inputs) -> DataFrame:
    """Active and returning lifetimes by day, week and month from bitmaps that two runs have stored."""
    ids, path, daily = inp.stage.folder(), inp.stage.folder(), inp.stored("daily")
    for window in (RunWindow(run_date=date(2024, 1, 17), full_refresh=True), RunWindow(run_date=RUN_DATE, start=date(2024, 1, 15))):
        active.store_active(daily, ids, path, window, inp.stage)
    parts = inp.raw.spark.read.parquet(path)
    return padded_union([active.active_users(parts, period) for period in ("day", "week", "month")])


NO_DAY = date(2024, 1, 5)  # a cohort day that the tables of the sink queries hold as NULL


def nullable_utn(inp: Inputs) -> DataFrame:
    """Active users by cohort with keys that can be NULL: unknown dimensions, and the day of one cohort."""
    unknown = {c: F.when(F.col(c) != "", F.col(c)) for c in dims.COHORT_KEY if c != "cohort_date"}
    day = F.when(F.col("cohort_date") != F.lit(NO_DAY), F.col("cohort_date"))
    return inp.stage(inp.utn().withColumns({**unknown, "cohort_date": day}))


def upsert_query(inp: Inputs) -> DataFrame:
    """A cohort table whose later and undated cohorts are written again over a first version."""
    path, utn, order = inp.stage.folder(), nullable_utn(inp), list(dims.COHORT_KEY)
    later = F.coalesce(F.col("cohort_date") >= date(2024, 1, 15), F.lit(True))
    first = utn.withColumn("clients_sdk_utn", F.when(later, 0).otherwise(F.col("clients_sdk_utn")))
    # two dates that the next run no longer has, one within the days it owns and one that is not its own
    gone = utn.filter(later).limit(1).withColumn("cohort_date", F.lit(date(2024, 3, 1)))
    old = utn.filter(later).limit(1).withColumn("cohort_date", F.lit(date(2023, 12, 1)))
    replace_partitions(first.unionByName(gone).unionByName(old), path, "cohort_date", order)
    replace_partitions(utn.filter(later), path, "cohort_date", order, lambda day: day is None or day >= "2024-01-15")
    stored = inp.raw.spark.read.parquet(path).select(*utn.columns)
    return stored.filter(F.coalesce(F.col("cohort_date") > date(2023, 12, 1), F.lit(True)))


def published_query(inp: Inputs) -> DataFrame:
    """The same for readers of a published table, for whom all partitions of a run change in one step."""
    root, name = inp.stage.folder(), f"active_users_{uuid.uuid4().hex[:12]}"
    utn, order = nullable_utn(inp), list(dims.COHORT_KEY)
    later = F.coalesce(F.col("cohort_date") >= date(2024, 1, 15), F.lit(True))
    first = utn.withColumn("clients_sdk_utn", F.when(later, 0).otherwise(F.col("clients_sdk_utn")))
    gone = utn.filter(later).limit(1).withColumn("cohort_date", F.lit(date(2024, 3, 1)))
    publish_partitions(first.unionByName(gone), name, root, "cohort_date", order)
    publish_partitions(utn.filter(later), name, root, "cohort_date", order, lambda day: day is None or day >= "2024-01-15")
    return inp.raw.spark.table(name)


def upsert_keys_query(inp: Inputs) -> DataFrame:
    """A cohort table in which single keys are replaced, added and deleted; other rows of their dates stay."""
    path, utn, order = inp.stage.folder(), nullable_utn(inp), list(dims.COHORT_KEY)
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]
    pick = F.pmod(F.crc32(F.concat_ws("|", *shown).cast("binary")), F.lit(5))
    changed, added, kept = utn.filter(pick == 0), utn.filter(pick == 1), utn.filter(pick > 1)
    stale = changed.withColumn("clients_sdk_utn", F.lit(-1).cast("long"))
    gone = kept.withColumn("application", F.concat(F.coalesce("application", F.lit("")), F.lit(" gone")))
    replace_partitions(kept.unionByName(stale).unionByName(gone), path, "cohort_date", order)
    upsert_rows(changed.unionByName(added), path, "cohort_date", order, order, inp.stage, gone)
    return inp.raw.spark.read.parquet(path).select(*utn.columns)


#: Of each mart: the column that dates it, and one that is added up.
MART_SUMS = {
    "cohort_users": ("cohort_date", None),
    "daily": ("event_date", "total_revenue_net"),
    "cohort_long": ("event_date", "total_revenue_net"),
    "utn": ("cohort_date", "clients_sdk_utn"),
    "payers": ("cohort_date", "purchases_total"),
    "cohort_wide": ("cohort_date", "ad_revenue_gross_utn"),
    "curves": ("cohort_date", "total_revenue_net"),
}


def built_marts_query(inp: Inputs) -> DataFrame:
    """All marts built as stored tables in order and read back whole: rows and a sum of each day."""
    inputs = {
        "lifetimes": inp.stored("lifetimes"),
        "activity": inp.stored("activity"),
        "ad_daily": inp.stored("ad_daily"),
        "inapp": inp.raw["inapp"],
        "subscription": inp.raw["subscription"],
        "costs": inp.costs(),
    }
    paths = build_marts(inp.raw.spark, inputs, CONFIG, FULL, inp.stage.folder())

    def sums(name: str) -> DataFrame:
        day, amount = MART_SUMS[name]
        total = F.sum(amount) if amount else F.lit(0)
        return (
            inp.raw.spark.read.parquet(paths[name])
            .groupBy(F.col(day).cast("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("rows_count"), total.cast("decimal(18,8)").alias("total"))
            .withColumn("table_name", F.lit(name))
        )

    return padded_union([sums(name) for name in paths])


def trusted_time_query(inp: Inputs) -> DataFrame:
    """Every raw feed read with its trusted time column, counted by day."""
    base = inp.raw["session_events"].select(F.col("event_time").alias("_at"))
    out = []
    for feed, column in sorted(EVENT_TIME_COLUMNS.items()):
        path = inp.stage.folder()
        wrong = F.col("_at") - F.expr("INTERVAL 400 DAYS")  # a client's clock
        base.select(F.col("_at").alias(column), wrong.alias("timestamp")).write.parquet(path)
        days = read_table(inp.raw.spark, path, feed).groupBy(F.to_date("event_time").alias("event_date"))
        out.append(days.agg(F.count(F.lit(1)).alias("rows_count")).withColumn("feed", F.lit(feed)))
    return padded_union(out)


def run_windows_query(inp: Inputs) -> DataFrame:
    """The daily fact's in-app rows in each of the five window modes."""
    windows = {
        "bounds": RunWindow(run_date=RUN_DATE, start=date(2024, 1, 5), end=date(2024, 1, 9)),
        "start": RunWindow(run_date=RUN_DATE, start=date(2024, 1, 20)),
        "end": RunWindow(run_date=RUN_DATE, end=date(2024, 1, 9)),
        "lookback": RunWindow(run_date=date(2024, 1, 20)),
        "full": FULL,
    }
    rows = [cohorts.inapp_rows(inp.raw["inapp"], w, CONFIG).withColumn("mode", F.lit(m)) for m, w in windows.items()]
    return padded_union(rows).groupBy("mode", "event_date").agg(F.count(F.lit(1)).alias("rows_count"))


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "scd2_lifetimes": lambda i: attribution.install_lifetimes(i.stored("attribution_events")),
    "asof_join": asof_query,
    "interval_join": interval_query,
    "bucketed_join": bucketed_query,
    "overlap_join": overlap_query,
    "date_range_join": date_range_query,
    "active_lifetimes": active_lifetimes_query,
    "cohort_users": Inputs.users,
    "lifetime_activity_daily": Inputs.daily,
    "cohort_long": Inputs.long,
    "cohort_activity_utn": Inputs.utn,
    "payers": Inputs.payers,
    "cohort_wide": lambda i: cohorts.cohort_wide(i.long(), i.payers(), i.utn(), CONFIG),
    "monetization_curves": lambda i: cohorts.monetization_curves(i.long(), CONFIG),
    "revenue_by_source": Inputs.revenue,
    "price_usd": price_query,
    "sessions": Inputs.sessions,
    "activity_daily": Inputs.activity,
    "user_profile": lambda i: attribution.user_profile(
        i.stored("attribution_events"), attribution.first_seen(i.raw["session_events"])
    ),
    "first_seen": lambda i: attribution.first_seen(i.raw["session_events"]),
    "inapp_staged": Inputs.staged,
    "inapp_refunds": Inputs.refunds,
    "inapp_fact": lambda i: purchases.inapp_fact(i.stored("staged"), i.refunds()),
    "subscription_stream": Inputs.stream,
    "subscription_context": Inputs.context,
    "subscription_fact": lambda i: subscriptions.subscription_fact(
        i.stream(), i.context(), i.stored("lifetimes"), i.rates(), i.raw["fees"], i.stage
    ),
    "rates_scd2": Inputs.rates,
    "rate_lookup": rate_lookup_query,
    "ad_user_daily": Inputs.ad_daily,
    "ua_costs": Inputs.costs,
    "dimension_lookup": dimension_query,
    "revenue_feed": revenue_feed_query,
    "latest_snapshot": lambda i: reference.latest_snapshot(reference.campaign_snapshots(i.raw["snapshots_raw"])),
    "campaign_snapshots": lambda i: reference.campaign_snapshots(i.raw["snapshots_raw"]).drop(
        "targeting_countries", "goal_country_values", "budget_country_values"
    ),
    "json_country_explode": json_query,
    "payment_stream": lambda i: purchases.payment_stream(i.raw["payments"]),
    "first_24h": first_24h_query,
    "revenue_compare": lambda i: revenue.compare_sources(
        i.revenue(), ["own_events", "payments", "store", "attribution", "ad_network"], "own_events"
    ),
    "source_compare": source_compare_query,
    "feature_corr": feature_corr_query,
    "feature_pairs": feature_pairs_query,
    "table_profile": Inputs.profile,
    "odd_payloads": odd_payload_query,
    "column_profile": column_profile_query,
    "sql_prices": sql_prices_query,
    "sql_lifetimes": sql_lifetimes_query,
    "layer_totals": lambda i: reference.layer_totals(i.profile()),
    "largest_tables": lambda i: reference.largest_tables(i.profile(), 5, ["lineitem"]),
    "incremental_equals_full": incremental_query,
    "late_data_equals_full": late_query,
    "incremental_sessions": incremental_sessions_query,
    "incremental_activity": incremental_activity_query,
    "active_users": active_query,
    "incremental_curves": incremental_curves_query,
    "upsert_partitions": upsert_query,
    "upsert_keys": upsert_keys_query,
    "published_partitions": published_query,
    "built_marts": built_marts_query,
    "trusted_times": trusted_time_query,
    "run_windows": run_windows_query,
    "unreadable_starts": lambda i: attribution.unreadable_starts(i.raw["raw_installs"], i.raw["raw_reinstalls"]),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries as ``(spark, directory) -> DataFrame``."""

    def bind(plan: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: plan(Inputs(spark, sf_dir))

    found = {name: bind(plan) for name, plan in QUERIES.items()}
    if llm_queries:
        found |= llm_queries.QUERIES
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    """Independent SQL for every query, for the checking database."""
    from checks.oracle import statements

    found = statements()
    if llm_queries:
        found |= llm_queries.ORACLES
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def entry(spark: SparkSession) -> DataFrame:
    """Daily revenue per install lifetime on the smallest test tables."""
    return Inputs(spark, "/root/testdata/sf0.001").daily()
