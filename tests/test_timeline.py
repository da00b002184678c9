"""As-of, interval and sequence operators against plain Python on small rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from installarc.operators.lookup import session_match
from installarc.operators.timeline import asof_join, interval_join, sequence_rows

T0 = datetime(2024, 1, 1)
KEYS = ["app", "client"]


def rows(seed, n, keys=4, hours=200):
    """Random (app, client, time) rows; client c0 holds about half of them."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        client = "c0" if rnd.random() < 0.5 else f"c{rnd.randrange(keys)}"
        # whole minutes, so equal instants and exact chunk borders occur
        out.append(("a", client, T0 + timedelta(minutes=rnd.randrange(hours * 6) * 10), i))
    return out


def spans(seed, n):
    """Disjoint half-open spans per client, the last one open."""
    starts = {}
    for app, client, t, _ in rows(seed, n):
        starts.setdefault((app, client), set()).add(t)
    out = []
    for (app, client), times in starts.items():
        ordered = sorted(times)
        for i, t in enumerate(ordered):
            end = ordered[i + 1] if i + 1 < len(ordered) else None
            if i % 5 == 3:  # a gap before the next span
                end = t + timedelta(minutes=5)
            out.append((app, client, t, end, f"{client}-{i}"))
    return out


def frames(spark, events, lifetimes):
    e = spark.createDataFrame(events, "app string, client string, at timestamp, id int")
    s = spark.createDataFrame(
        lifetimes, "app string, client string, start timestamp, end timestamp, name string"
    )
    return e, s


@pytest.mark.parametrize("chunk", ["hour", "day", "month"])
def test_asof_equals_brute_force(spark, chunk):
    events, lifetimes = rows(1, 300), spans(2, 60)
    events += [("a", None, T0, 1000), ("a", None, T0, 1001), (None, "c0", T0, 1002), ("a", "c0", None, 1003)]
    lifetimes += [("a", None, T0, None, "nobody")]
    e, s = frames(spark, events, lifetimes)
    got = {r.id: r.name for r in asof_join(e, s, KEYS, "at", "start", ["name"], chunk=chunk).collect()}
    for app, client, at, i in events:
        before = [
            (start, name)
            for a, c, start, _, name in lifetimes
            if at is not None and None not in (app, client) and (a, c) == (app, client) and start <= at
        ]
        assert got[i] == (max(before)[1] if before else None), i
    assert len(got) == len(events)


def test_asof_ties_take_the_last(spark):
    e, s = frames(
        spark,
        [("a", "c", T0, 1), ("a", "c", T0 + timedelta(hours=5), 2)],
        [("a", "c", T0, None, "x1"), ("a", "c", T0, None, "x2")],
    )
    out = asof_join(e, s, KEYS, "at", "start", ["name"], tie_break=["name"])
    assert {r.id: r.name for r in out.collect()} == {1: "x2", 2: "x2"}


@pytest.mark.parametrize("chunk", ["hour", "month"])
def test_interval_join_equals_range_join(spark, chunk):
    e, s = frames(spark, rows(3, 400), spans(4, 80))
    ours = interval_join(e, s, KEYS, "at", "start", "end", ["name"], chunk=chunk)
    inside = (F.col("at") >= F.col("start")) & (F.col("end").isNull() | (F.col("at") < F.col("end")))
    direct = e.join(s, KEYS).filter(inside)
    got = sorted((r.id, r.name) for r in ours.select("id", "name").collect())
    assert got == sorted((r.id, r.name) for r in direct.select("id", "name").collect())
    assert len(got) == len({i for i, _ in got}), "at most one span per event"


def test_sequence_equals_brute_force(spark):
    data = rows(5, 250) + [("a", None, T0, 900), ("a", None, T0, 901)]
    df = spark.createDataFrame(data, "app string, client string, at timestamp, id int")
    out = sequence_rows(df, KEYS, "at", number="n", next_time="next", tie_break=["id"]).collect()
    assert len(out) == len(data)
    groups = {}
    for row in sorted(data, key=lambda r: (r[2], r[3])):
        groups.setdefault((row[0], row[1]), []).append(row)
    got = {r.id: (r.n, r.next) for r in out}
    for (app, client), ordered in groups.items():
        for i, (_, _, _, row_id) in enumerate(ordered):
            if client is None:
                assert got[row_id] == (None, None)
            else:
                following = ordered[i + 1][2] if i + 1 < len(ordered) else None
                assert got[row_id] == (i + 1, following)


def test_a_hot_key_is_spread_over_chunks(spark):
    """No window or join of the match is partitioned by the bare key on event rows."""
    e, s = frames(spark, rows(6, 50), spans(7, 20))
    plan = asof_join(e, s, KEYS, "at", "start", ["name"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    events_window = plan.index("Window [last(_hit")
    assert "[app" in plan[events_window:] and "_chunk" in plan[events_window : plan.index("\n", events_window)]


def test_session_match_bounds(spark):
    events = spark.createDataFrame(
        [("a", "c", T0 + timedelta(minutes=m), m) for m in (0, 10, 11, 30, 40, 41)],
        "app string, client string, at timestamp, id int",
    )
    sessions = spark.createDataFrame(
        [("a", "c", "s1", T0, T0 + timedelta(minutes=10)), ("a", "c", "s2", T0 + timedelta(minutes=30), T0 + timedelta(minutes=40))],
        "app string, client string, session_id string, session_start timestamp, session_end timestamp",
    )
    got = {r.id: r.session_id for r in session_match(events, sessions, KEYS, "at").collect()}
    assert got == {0: "s1", 10: "s1", 11: None, 30: "s2", 40: "s2", 41: None}
