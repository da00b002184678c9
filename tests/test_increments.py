"""Late files and sessions over several windows, on small rows."""

import os
import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from installarc.plans.sessions import merge_parts, session_parts, sessions, store_parts, update_sessions
from installarc.settings import RunWindow
from installarc.sources.changes import changed_days, newest_change, rebuild_changed, windows_of
from installarc.sources.tables import Staging, replace_days

RUN = date(2024, 2, 1)


def test_windows_of_changed_days():
    days = [date(2024, 1, 9), date(2024, 1, 3), date(2024, 1, 4), date(2024, 2, 1), date(2024, 3, 1), date(2024, 1, 9)]
    spans = lambda ws: [(w.first_day, w.last_day) for w in ws]
    assert spans(windows_of(days, RUN)) == [(date(2024, 1, 3), date(2024, 1, 4)), (date(2024, 1, 9), date(2024, 1, 9))]
    within = RunWindow(run_date=RUN, lookback_days=2)
    assert spans(windows_of([date(2024, 1, 29)], RUN, within)) == [(date(2024, 1, 29), date(2024, 1, 31))]
    assert spans(windows_of([], RUN)) == []
    full = RunWindow(run_date=RUN, full_refresh=True)
    assert windows_of(days, RUN, full) == [full]


def written(spark, path, rows, at):
    """Append rows as files that were written ``at``."""
    before = set(os.listdir(path)) if os.path.isdir(path) else set()
    spark.createDataFrame(rows, "at timestamp, till timestamp, v int").coalesce(1).write.mode("append").parquet(path)
    for name in set(os.listdir(path)) - before:
        os.utime(os.path.join(path, name), (at.timestamp(), at.timestamp()))


def test_only_days_of_late_files_are_rebuilt(spark, tmp_path):
    feed, path = str(tmp_path / "feed"), str(tmp_path / "facts")
    day = lambda n, h=5: datetime(2024, 1, n, h)
    written(spark, feed, [(day(n), None, n) for n in range(1, 32)], datetime(2024, 2, 1, 1))
    since = newest_change(spark, feed)
    asked = []

    def build(window):
        asked.append((window.first_day, window.last_day))
        rows = spark.read.parquet(feed).filter(window.has_time(F.col("at")))
        return rows.groupBy(F.to_date("at").alias("day")).agg(F.sum("v").alias("v"))

    full = RunWindow(run_date=RUN, full_refresh=True)
    replace_days(build(full), path, "day", full, ["day"])
    written(spark, feed, [(day(11), None, 1000), (day(13), day(14), 1), (None, None, 5)], datetime(2024, 2, 2, 1))
    assert newest_change(spark, feed) > since
    after = since + timedelta(seconds=1)
    assert sorted(r["day"].day for r in changed_days(spark, feed, F.col("at"), after).collect()) == [11, 13]
    assert changed_days(spark, feed, F.col("at"), None).count() == 31
    late = changed_days(spark, feed, F.col("at"), after, F.col("till"))
    asked.clear()
    rebuild_changed(build, path, "day", ["day"], [late], RUN, RunWindow(run_date=RUN, lookback_days=1))
    assert [(a.day, z.day) for a, z in asked] == [(11, 11), (13, 14), (31, 31)]
    stored = {r["day"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert stored == {r["day"]: r["v"] for r in build(full).collect()} and stored[date(2024, 1, 11)] == 1011
    assert newest_change(spark, str(tmp_path / "feed")) is not None
    os.mkdir(tmp_path / "none")
    assert newest_change(spark, str(tmp_path / "none")) == datetime(1970, 1, 1)


EVENTS = (
    "app_name string, client_id string, session_id string, session_number int, event_time timestamp, event_name string,"
    "app_version string, country string, device_name string, device_version string"
)


def events_of(seed, n):
    rnd, out = random.Random(seed), []
    for i in range(n):
        client = rnd.choice(["c0", "c0", "c1", None])
        start = datetime(2024, 1, 10) + timedelta(minutes=rnd.randrange(60 * 24 * 6))
        for k in range(rnd.randrange(1, 5)):  # sessions of up to two days
            out.append(("a", client, rnd.choice([f"s{i}", f"s{i}", None]), i, start + timedelta(hours=rnd.randrange(48), seconds=k), f"e{i}-{k}", f"{k}", "x", None, "y"))
    return out


def test_runs_over_windows_equal_one_run(spark, tmp_path):
    events = spark.createDataFrame(events_of(1, 60), EVENTS)
    parts, path, stage = str(tmp_path / "parts"), str(tmp_path / "sessions"), Staging(spark)
    whole = sessions(events)
    plain = lambda df: sorted((tuple(r) for r in df.select(*whole.columns).collect()), key=repr)
    assert plain(merge_parts(session_parts(events))) == plain(whole)
    # a first run that has also seen events which are gone later, one that is repeated, a late one for early days
    extra = events.filter("client_id = 'c1'").withColumns({"session_id": F.lit("gone"), "event_time": F.lit(datetime(2024, 1, 11, 3))})
    early = F.col("event_time") < datetime(2024, 1, 12, 12)
    held_back = F.coalesce(F.col("client_id") == "c1", F.lit(False)) & (F.col("event_time") < datetime(2024, 1, 11))
    steps = [
        (events.filter(early & ~held_back).unionByName(extra), RunWindow(run_date=date(2024, 1, 13), full_refresh=True)),
        (events.filter(~held_back), RunWindow(run_date=RUN, start=date(2024, 1, 12))),
        (events.filter(~held_back), RunWindow(run_date=RUN, start=date(2024, 1, 12))),
        (events, RunWindow(run_date=RUN, start=date(2024, 1, 10), end=date(2024, 1, 11))),
    ]
    for seen, window in steps:
        store_parts(seen, parts, window)
        days = update_sessions(parts, path, window, stage)
    assert plain(spark.read.parquet(path)) == plain(whole)
    lone = events.filter("session_id is not null")
    parts, path = str(tmp_path / "parts2"), str(tmp_path / "sessions2")
    for window in (RunWindow(run_date=RUN, full_refresh=True), RunWindow(run_date=RUN, start=date(2024, 1, 10), end=date(2024, 1, 10))):
        store_parts(lone, parts, window)
        days = update_sessions(parts, path, window, stage)
    assert max(days) < date(2024, 1, 15)  # sessions of later days were left alone
