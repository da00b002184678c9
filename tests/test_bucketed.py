"""Bucketed tables match without an exchange and like the shuffled match."""

import uuid
from datetime import datetime, timedelta

from installarc.operators.timeline import interval_join
from installarc.sources.bucketed import match_pair, write_pair
from installarc.sources.tables import Staging

KEYS, T0 = ["app", "client"], datetime(2024, 1, 1)
EVENTS = "app string, client string, at timestamp, note string"
SPANS = "app string, client string, start timestamp, end timestamp, number int, note_2 string"


def _tables(spark):
    hours = lambda n: T0 + timedelta(hours=n)
    spans = [("a", f"c{c}", hours(10 * s), hours(10 * s + (0 if s == 1 else 8)), s, "x") for c in range(20) for s in range(3)]
    spans += [("a", "c1", hours(40), None, 9, "open"), (None, "c1", hours(0), None, 1, "y"), ("a", "c2", None, None, 1, "z")]
    spans += [("b", "many spans", hours(2 * s), hours(2 * s + 1), s, None) for s in range(30)]
    events = [("a", f"c{c}", hours(h / 2), None) for c in range(25) for h in range(100)]
    events += [("b", "many spans", hours(h / 4), "m") for h in range(40)] + [("a", "c3", hours(h / 100), "hot") for h in range(500)]
    events += [(None, "c1", hours(1), "n"), ("a", None, hours(1), "n"), ("a", "c1", None, "n"), *[("a", "c1", hours(1), "again")] * 3]
    return spark.createDataFrame(events, EVENTS), spark.createDataFrame(spans, SPANS)


def _bag(df):
    return sorted(map(str, df.collect()))


def _pair(spark, events, spans, **limits):
    return write_pair(events, spans, f"pair_{uuid.uuid4().hex[:10]}", KEYS, "at", "start", "end", 4, Staging(spark), **limits)


def test_match_equals_interval_join(spark):
    events, spans = _tables(spark)
    want = _bag(interval_join(events, spans, KEYS, "at", "start", "end", ["number", "note_2"]))
    for limits in ({}, {"max_events": 300, "max_spans": 10}, {"max_events": 0}):
        pair = _pair(spark, events, spans, **limits)
        got = match_pair(spark, pair, ["number", "note_2"])
        assert got.columns == [*events.columns, "number", "note_2"] and _bag(got) == want
        heavy = {tuple(r) for r in spark.table(pair.table("heavy_events")).select(*KEYS).distinct().collect()}
        assert heavy == {("a", "c3"), ("b", "many spans")} if "max_spans" in limits else len(heavy) == (26 if limits else 0)
        pair.drop(spark)
        assert not spark.catalog.tableExists(pair.table("events"))


def test_buckets_meet_without_exchange(spark):
    pair = _pair(spark, *_tables(spark))
    events, spans = (spark.table(pair.table(p)) for p in ("events", "spans"))
    assert len(events.inputFiles()) <= 4 and len(spans.inputFiles()) <= 4
    plan = match_pair(spark, pair, ["number"])._jdf.queryExecution().executedPlan().toString()
    light = plan[: plan.index("heavy_events")] if "heavy_events" in plan else plan
    joined = light[light.index("SortMergeJoin") :]
    joined = joined[: joined.index("Window")] if "Window" in joined else joined
    assert "Exchange" not in joined and joined.count("Bucketed: true") == 2


def test_empty_tables(spark):
    events, spans = _tables(spark)
    for a, b in ((events.limit(0), spans), (events, spans.limit(0))):
        assert match_pair(spark, _pair(spark, a, b), ["number"]).collect() == []
