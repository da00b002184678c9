"""Monetization curves kept as maps from day to amounts, so that a new day is added without the days before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from installarc.functions import dims
from installarc.functions.money import money, sum_long, sum_money
from installarc.settings import MartConfig, RunWindow, stamped
from installarc.sources.tables import Staging, replace_partitions, stored_partitions

VALUES = ("ad_revenue_gross", "total_revenue_net")
KEY = list(dims.COHORT_KEY)


def day_maps(long: DataFrame, window: RunWindow, config: MartConfig) -> DataFrame:
    """(cohort key, days): amounts, installs and spend by cohort day, of the window's days of the long cohort fact."""
    kept = long.filter(
        config.has_app(F.col("application"))
        & F.col("cohort_date").between(F.lit(config.curve_start), F.date_sub(F.lit(config.curve_end), 1))
        & F.col("day_idx").between(0, config.max_cohort_day)
        & window.has_day(F.col("event_date"))
    )
    day_zero = F.col("day_idx") == 0
    per_day = kept.groupBy(*KEY, "day_idx").agg(
        *[sum_money(F.col(v)).alias(v) for v in VALUES],
        sum_long(F.when(day_zero, F.col("installs"))).alias("installs"),
        sum_money(F.when(day_zero, F.col("cost"))).alias("spend"),
    )
    entry = F.struct("day_idx", F.struct(*VALUES, "installs", "spend").alias("amounts"))
    return per_day.groupBy(*KEY).agg(F.map_from_entries(F.collect_list(entry)).alias("days"))


def merged_days(old: Column, new: Column, cohort_date: Column, window: RunWindow) -> Column:
    """Days of a window as they are now, all others as they were. A day is a cohort day, so the window's are known by date."""
    kept = F.map_filter(old, lambda day, _: ~window.has_day(F.date_add(cohort_date, day)))
    return F.map_zip_with(kept, new, lambda _, a, b: F.coalesce(b, a))


def store_curves(long: DataFrame, path: str, window: RunWindow, config: MartConfig, stage: Staging) -> None:
    """Bring stored curves (a row for each cohort, partitioned by ``cohort_date``) up to a window of the long cohort fact.

    Only the window's days are read of the fact, and only cohort dates with such a day, now or before, are written. A
    repeated run changes nothing; days that have no rows any more leave the curves, and so do cohorts without days.
    """
    new = stage(day_maps(long, window, config))
    kind = new.schema["days"].dataType
    rows = new.select(*KEY, F.lit(None).cast(kind).alias("old"), F.col("days").alias("new"))
    if stored_partitions(long.sparkSession, path, "cohort_date"):
        in_window = lambda day, _: window.has_day(F.date_add("cohort_date", day))
        stored = long.sparkSession.read.parquet(path).filter(F.col("cohort_date") <= F.lit(window.last_day))
        if window.first_day is not None:  # older cohorts have no day in the window
            stored = stored.filter(F.col("cohort_date") >= F.date_sub(F.lit(window.first_day), config.max_cohort_day))
        hit = stored.filter(F.size(F.map_filter("days", in_window)) > 0).select("cohort_date")
        touched = stage(hit.unionByName(new.select("cohort_date")).distinct())
        old = stored.join(touched, "cohort_date", "left_semi")
        rows = rows.unionByName(old.select(*KEY, F.col("days").alias("old"), F.lit(None).cast(kind).alias("new")))
        gone = {row[0].isoformat() for row in touched.collect()}  # as many as cohort dates
    else:
        gone = set()
    nothing = F.map_from_arrays(F.array().cast("array<int>"), F.array().cast(f"array<{kind.valueType.simpleString()}>"))
    both = rows.groupBy(*KEY).agg(*[F.coalesce(F.first(c, ignorenulls=True), nothing).alias(c) for c in ("old", "new")])
    days = both.select(*KEY, merged_days(F.col("old"), F.col("new"), F.col("cohort_date"), window).alias("days"))
    replace_partitions(stage(days.filter(F.size("days") > 0)), path, "cohort_date", KEY, lambda value: value in gone)


def curves_of(stored: DataFrame, config: MartConfig) -> DataFrame:
    """The same rows as ``monetization_curves``, from stored curves.

    A cohort's days are folded into running totals in one pass over its map; each day with amounts is then stretched to the
    next one, so nothing is joined or sorted over rows.
    """
    kinds = {v: stored.schema["days"].dataType.valueType[v].dataType.simpleString() for v in VALUES}
    entries = F.array_sort(F.map_entries("days"))
    step = "struct<day:int," + ",".join(f"{v}:{k},sum_{v}:{k}" for v, k in kinds.items()) + ">"
    start = F.struct(F.array().cast(f"array<{step}>").alias("steps"), *[F.lit(0).cast(k).alias(f"sum_{v}") for v, k in kinds.items()])

    def fold(state: Column, entry: Column) -> Column:
        sums = {v: (state[f"sum_{v}"] + entry["value"][v]).cast(k) for v, k in kinds.items()}
        parts = [x for v in VALUES for x in (entry["value"][v].alias(v), sums[v].alias(f"sum_{v}"))]
        one = F.struct(entry["key"].alias("day"), *parts).cast(step)
        return F.struct(F.concat(state["steps"], F.array(one)).alias("steps"), *[sums[v].alias(f"sum_{v}") for v in VALUES])

    age = F.greatest(F.date_diff(F.lit(config.last_full_day), "cohort_date"), F.lit(0))
    zero = F.try_element_at("days", F.lit(0))
    nil = {v: F.lit(0).cast(k) for v, k in kinds.items()}
    walked = stored.select(
        *KEY,
        F.least(age, F.lit(config.max_cohort_day)).alias("last_day"),
        F.coalesce(zero["installs"], F.lit(0)).cast("long").alias("installs"),
        money(F.coalesce(zero["spend"], F.lit(0))).alias("spend"),
        *[F.coalesce(zero[v], nil[v]).cast(kinds[v]).alias(f"{v}_day0") for v in VALUES],
        F.aggregate(entries, start, fold)["steps"].alias("steps"),
    )
    # days before the first with amounts are zeros, so the first is stretched backwards
    follows = F.transform(
        "steps",
        lambda s, i: F.struct(
            s.alias("at"),
            F.when(i == 0, F.lit(0)).otherwise(s["day"]).alias("from"),
            F.least(F.coalesce(F.get("steps", i + 1)["day"] - 1, F.col("last_day")), F.col("last_day")).alias("to"),
        ),
    )
    spans = walked.withColumn("span", F.explode(F.filter(follows, lambda s: s["from"] <= s["to"])))
    grid = spans.withColumn("cohort_day", F.explode(F.sequence("span.from", "span.to")))
    own, early = F.col("cohort_day") == F.col("span.at.day"), F.col("cohort_day") < F.col("span.at.day")
    measures = []
    for v in VALUES:
        value = F.when(own, F.col(f"span.at.{v}")).otherwise(nil[v])
        total = F.when(early, nil[v]).otherwise(F.col(f"span.at.sum_{v}"))
        measures += [
            value.cast(kinds[v]).alias(v),
            total.cast(kinds[v]).alias(f"{v}_cumulative"),
            (total - value).cast(kinds[v]).alias(f"{v}_prev_day"),
            F.col(f"{v}_day0"),
        ]
    parts = dims.cohort_parts(F.col("cohort_date"))
    return stamped(grid.select(*parts, "cohort_day", *dims.COHORT_DIMS, "installs", "spend", *measures), config)
