import hashlib
import heapq
import re
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from installarc.llm import queries, repair

BLANKS = " \t\n\x0b\x0c\r"
EMPTY = hashlib.sha256(b"").hexdigest()


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        fate = crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2:]
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def search(rows):
    """Cheapest, then least audit, by a best-first search over (cost, audit); with the repaired lines."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, form, lines = heapq.heappop(heap)
        state = "s" if form == "s" else form[-1:]
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, lines
        turn = "a" if state == "u" else "u"
        named = {"u": "user", "a": "assistant"}[turn]
        steps = [(3, "I", i, turn, (f"{named}:",))]
        if i < len(rows):
            role, text, fault = rows[i]
            steps.append((4, "D", i + 1, "", ()))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                steps.append((3 + more, "R", i + 1, turn, (f"{named}:{text}",)))
                if role[:1] == turn or (role[:1] == "s" and not form):
                    steps.append((more, "K", i + 1, role[:1], (f"{role}:{text}",)))
        for price, letter, at, add, line in steps:
            heapq.heappush(heap, (cost + price, audit + letter, at, form + add, lines + line))


def brute(rows):
    """By conv_id: gaps, faults, illegal neighbours, cost, audit and the repaired lines of undamaged ``rows``."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(
            ((r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"{len(r[2].encode())}:{r[2]}{r[3]}".encode()).hexdigest(), r) for r in rows if r[0] == conv),
            key=lambda x: x[:4],
        )
        turns, seen, judged = [r[-1][1] for r in mine if r[-1][1] is not None], set(), []
        for *_, (_, _, role, text) in mine:
            end = text.rstrip(BLANKS)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(judged, judged[1:])]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [sum(f == x for *_, f in judged) for x in ("blank", "duplicate", "truncated")]
        cost, audit, lines = search(judged)
        out[conv] = (gaps, *faults, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, "\n".join(lines))
    return out


def results(found):
    hashes = {r["key"]: r["repaired_sha256"] for r in repair.joined_hashes(found.edits).collect()}
    fields = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    keyed = found.report.withColumn("of", repair.conversation_key(F.col("conv_id"))).collect()
    return {r["conv_id"]: (*[r[f] for f in fields], hashes.get(r["of"], EMPTY)) for r in keyed}


def expected(rows):
    return {k: (*v[:-1], hashlib.sha256(v[-1].encode()).hexdigest()) for k, v in brute(rows).items()}


KIND = "conv_id long, turn long, role string, text string"


def test_equals_search(spark):
    random = np.random.default_rng(3)
    rows = []
    for conv in range(150):
        for turn in range(int(random.integers(1, 9))):
            role = ("user", "assistant", "system", "tool", "User", "")[random.choice(6, p=[0.35, 0.35, 0.1, 0.1, 0.05, 0.05])]
            text = ("Yes.", "No", "ok!  ", " \n", "", "well?\n", f"number {turn}.")[int(random.integers(7))]
            rows.append((conv, None if random.random() < 0.05 else turn * 2 if conv % 9 == 0 else turn, role, text))
    # several segments: cheapest edits that depend on what comes hundreds of rows later
    for conv, n in ((1000, 64), (1001, 65), (1002, 200), (1003, 128)):
        for turn in range(n):
            role = ("user", "assistant")[turn % 2 if conv != 1002 else int(random.integers(2))]
            rows.append((conv, turn, "system" if turn == 0 and conv == 1003 else role, f"t {turn}." if random.random() > 0.1 else "cut"))
    rows += [(None, 1, "user", "a."), (None, 1, "assistant", "b."), (2000, None, "u", "x"), (2001, 5, "user", " "), (2002, 1, "tool", "long " * 40_000)]
    docs = spark.createDataFrame(rows, KIND).withColumns({"key": F.lit("k"), "place": F.lit(7), "Kept": F.lit("x")})
    assert results(repair.repair(docs)) == expected(rows)


def test_tree_over_segments(spark, monkeypatch):
    monkeypatch.setattr(repair, "RUN", 3)  # three levels of segments of three rows
    random = np.random.default_rng(4)
    rows = [(1, i, ("user", "assistant", "tool")[int(random.integers(3))], ("a.", "b", f"{i}!")[int(random.integers(3))]) for i in range(40)]
    assert results(repair.repair(spark.createDataFrame(rows, KIND))) == expected(rows)


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {conv: (0,) * 6 + ("", EMPTY) for conv in {r[0] for r in rows}} | expected(damage(rows))
    got = queries.op13_repair_conversations(spark, small).collect()
    fields = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert {r["conv_id"]: tuple(r[f] for f in fields) for r in got} == want and len(got) == len(want)


def test_empty_table(spark):
    found = repair.repair(spark.createDataFrame([], KIND))
    assert found.report.count() == 0 and found.edits.count() == 0 and repair.joined_hashes(found.edits).count() == 0
