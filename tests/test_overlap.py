"""Overlapping spans against plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from installarc.operators.lookup import session_match
from installarc.operators.overlap import overlap_join

T0 = datetime(2024, 1, 1)
EVENT, SPAN = "app string, client string, at timestamp, n int", "app string, client string, s timestamp, e timestamp, id string"


def made(seed):
    rnd = random.Random(seed)
    who = lambda: ("a", "c0" if rnd.random() < 0.5 else rnd.choice(["c1", "c2", None]))
    events = [(*who(), None if rnd.random() < 0.03 else T0 + timedelta(minutes=10 * rnd.randrange(5000)), i) for i in range(400)]
    events += events[:3]
    spans = []
    for i in range(120):
        start = T0 + timedelta(minutes=10 * rnd.randrange(5000))
        length = rnd.choice([0, 10, 60, 61, 600, 20_000, 400_000])
        end = None if rnd.random() < 0.05 else start + timedelta(minutes=length)
        spans.append((*who(), None if rnd.random() < 0.03 else start, end, f"s{i}"))
    spans += [("a", "c0", datetime(1960, 1, 1), datetime(2090, 1, 1), "old"), ("a", "c1", T0, T0 - timedelta(1), "back"), spans[0]]
    return events, spans


def holding(event, spans, closed):
    return [
        s for s in spans
        if None not in (event[1], event[2], s[1], s[2]) and s[:2] == event[:2]
        and s[2] <= event[2] and (s[3] is None or event[2] < s[3] or (closed and event[2] == s[3]))
    ]


@pytest.mark.parametrize("closed", [False, True])
def test_all_and_latest(spark, closed):
    events, spans = made(5)
    e, s = spark.createDataFrame(events, EVENT), spark.createDataFrame(spans, SPAN)
    args = (e, s, ["app", "client"], "at", "s", "e", ["id"])
    pairs = [(x[3], h[4]) for x in events for h in holding(x, spans, closed)]
    for seconds, parts in ((3600, 1), (60, 3)):
        got = overlap_join(*args, closed=closed, bin_seconds=seconds, parts=parts).collect()
        assert sorted((r["n"], r["id"]) for r in got) == sorted(pairs)
    left = overlap_join(*args, closed=closed, how="left").collect()
    lone = [(x[3], None) for x in events if not holding(x, spans, closed)]
    assert sorted(((r["n"], r["id"]) for r in left), key=repr) == sorted(pairs + lone, key=repr)
    latest = overlap_join(*args, closed=closed, keep="latest", how="left").collect()
    best = [(x[3], max(((h[2], h[4]) for h in holding(x, spans, closed)), default=(None, None))[1]) for x in events]
    assert sorted(((r["n"], r["id"]) for r in latest), key=repr) == sorted(best, key=repr)


def test_few_bins_and_odd_tables(spark):
    events, spans = made(6)
    e, s = spark.createDataFrame(events, EVENT), spark.createDataFrame(spans, SPAN)
    found = overlap_join(e, s, ["app", "client"], "at", "s", "e")
    assert found.columns == e.columns
    assert overlap_join(e.limit(0), s, ["app", "client"], "at", "s", "e", ["id"]).count() == 0
    none = overlap_join(e, s.limit(0), ["app", "client"], "at", "s", "e", ["id"], how="left")
    assert none.count() == len(events) and none.filter("id is not null").isEmpty()
    clash = e.withColumns({"_bin": F.lit("x"), "ID": F.lit("y")})
    assert "_bin" in overlap_join(clash, s, ["app", "client"], "at", "s", "e", ["id"]).columns
    with pytest.raises(ValueError):
        overlap_join(e, s, ["app", "client"], "at", "s", "e", keep="first")


def test_session_of_decades_costs_two_bins(spark):
    long = [("a", "c", datetime(1950, 1, 1), datetime(2100, 1, 1), "x")]
    sessions = spark.createDataFrame(long, "app string, client string, session_start timestamp, session_end timestamp, session_id string")
    events = spark.createDataFrame([("a", "c", T0, 1), ("a", "d", T0, 2)], EVENT)
    matched = session_match(events, sessions, ["app", "client"], "at")
    assert {r["n"]: r["session_id"] for r in matched.collect()} == {1: "x", 2: None}
