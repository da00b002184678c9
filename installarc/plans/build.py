"""Build the cohort marts in dependency order as stored tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from installarc.functions.dims import COHORT_KEY
from installarc.plans import cohorts
from installarc.settings import MartConfig, RunWindow
from installarc.sources.tables import Staging, replace_days, replace_partitions, write_full

DAILY_ORDER = ["event_date", "application", "client_id", "user_lifetime_id"]
LONG_ORDER = ["event_date", *COHORT_KEY]


def build_marts(
    spark: SparkSession, inputs: Mapping[str, DataFrame], config: MartConfig, window: RunWindow, root: str
) -> dict[str, str]:
    """Write every cohort mart under ``root`` and return the table paths.

    Each mart is read back from storage by the next one, so a lost executor never
    costs more than the mart being built, and tables read twice are computed once.
    """
    paths = {
        name: f"{root.rstrip('/')}/{name}"
        for name in ("cohort_users", "daily", "cohort_long", "utn", "payers", "cohort_wide", "curves")
    }

    stage = Staging(spark)

    def read(name: str) -> DataFrame:
        return spark.read.parquet(paths[name])

    users = cohorts.cohort_users(inputs["lifetimes"], config)
    write_full(
        users, paths["cohort_users"], "cohort_date", ["cohort_date", "application", "client_id", "user_lifetime_id"]
    )
    daily = cohorts.lifetime_activity_daily(
        inputs["activity"],
        inputs["inapp"],
        inputs["subscription"],
        inputs["ad_daily"],
        inputs["lifetimes"],
        window,
        config,
        stage,
    )
    replace_days(daily, paths["daily"], "event_date", window, DAILY_ORDER)
    long = cohorts.cohort_long(read("cohort_users"), inputs["costs"], read("daily"), config)
    write_full(long, paths["cohort_long"], "event_date", LONG_ORDER)
    utn = cohorts.cohort_activity_utn(read("daily"), config)
    write_full(utn, paths["utn"], "cohort_date", list(COHORT_KEY))
    payers = cohorts.payers(read("cohort_users"), inputs["inapp"], inputs["subscription"], config)
    write_full(payers, paths["payers"], "cohort_date", ["application", "client_id", "user_lifetime_id"])
    wide = cohorts.cohort_wide(read("cohort_long"), read("payers"), read("utn"), config)
    replace_partitions(wide, paths["cohort_wide"], "cohort_date", list(COHORT_KEY), owned=lambda value: True)
    curves = cohorts.monetization_curves(read("cohort_long"), config)
    write_full(curves, paths["curves"], "cohort_date", [*COHORT_KEY, "cohort_day"])
    stage.drop()
    return paths
