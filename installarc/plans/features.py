"""Feature tables of early days for models of later revenue, and the correlations of all their pairs."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from installarc.functions import metrics
from installarc.operators.moments import pair_correlations, rank_correlations

#: What the later days are summed up to.
LATER = ("sessions_count", "purchases", "ad_impressions", "total_revenue_net")


def feature_names(days: int) -> list[str]:
    """Every daily metric on each of the first ``days`` days, and the later sums."""
    early = (*metrics.SESSION_COUNTS, *metrics.PURCHASE_COUNTS, *metrics.AD_COUNTS, *metrics.DAILY_MONEY, *metrics.TOTALS)
    return [f"{m}_d{d}" for m in early for d in range(days)] + [f"{m}_later" for m in LATER]


def early_features(daily: DataFrame, days: int, run_date: date) -> DataFrame:
    """One row per lifetime: each metric on each early day and the sums of all later days, as doubles.

    A day without activity is 0. A day that has not ended by ``run_date`` is NULL; so are later sums before the first later day has.
    """

    def total(metric: str, when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(metric).cast("double"))), F.lit(0.0))

    age = F.date_diff(F.lit(run_date), F.first("cohort_date"))
    columns = []
    for name in feature_names(days):
        metric, _, tail = name.rpartition("_")
        day = days if tail == "later" else int(tail[1:])
        when = F.col("day_idx") >= day if tail == "later" else F.col("day_idx") == day
        columns.append(F.when(age > day, total(metric, when)).alias(name))
    return daily.groupBy("user_lifetime_id").agg(*columns)


def feature_pairs(daily: DataFrame, days: int, run_date: date, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(feature_a, feature_b, rows_count, pearson, spearman) of all pairs of early and later features."""
    names = feature_names(days)
    table = stage(early_features(daily, days, run_date))
    linear = pair_correlations(table, names).withColumnRenamed("correlation", "pearson")
    ranks = rank_correlations(table, names, stage).select("feature_a", "feature_b", F.col("correlation").alias("spearman"))
    return linear.join(ranks, ["feature_a", "feature_b"])
