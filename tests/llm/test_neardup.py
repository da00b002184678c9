import random

import numpy as np
from pyspark.sql import functions as F

from installarc.llm import neardup
from installarc.llm.components import components
from installarc.llm.common import stage_for


def brute(rows, words, percent):
    sets = {}
    for i, (doc, text) in enumerate(rows):
        w = (text or "").lower().split()
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                up[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return {doc: (len(sets[i]), least[root(i)], least[root(i)] == doc) for i, (doc, _) in enumerate(rows)}


def corpus():
    rng, rows = random.Random(4), []
    vocabulary = [f"w{i}" for i in range(4000)]
    for size in (1, 2, 3, 4, 7, 9, 20, 60, 150, 400):
        base = rng.choices(vocabulary, k=size)
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, size // 30])):
                copy[rng.randrange(size)] = rng.choice(vocabulary)
            rows.append(" ".join(copy))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_equals_brute_force(spark):
    rows = [*corpus(), (900, None), (901, ""), (902, " \n"), (903, "Two words"), (904, "two WORDS")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for words, percent, nodes in ((3, 85, 1000), (5, 80, 7)):
        got = neardup.near_duplicates(docs, words, percent, piece_nodes=nodes).collect()
        assert {r["doc"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute(rows, words, percent)


def test_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(50))
    rows = [(5, text), (5, text), (None, text), (None, "only " + text), (None, "other text"), (3, text + " more"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = neardup.near_duplicates(docs)
    got = {(r["doc"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in found.collect()}
    assert got == {(5, 46): (3, False), (None, 46): (3, False), (None, 47): (3, False), (3, 47): (3, True), (None, 1): (None, True), (None, 0): (None, True)}
    assert neardup.representatives(found).count() == 3
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_estimate_is_corrected_and_close():
    rng, probes = np.random.default_rng(0), neardup._probes()
    for share, n in ((0.9, 600), (0.5, 600), (0.0, 600), (0.9, 40)):
        guesses = []
        for _ in range(30):
            both = rng.integers(0, 2**63, int(n * share)).astype(np.uint64)
            a, b = (np.concatenate([both, rng.integers(0, 2**63, n - len(both)).astype(np.uint64)]) for _ in "ab")
            agree = (neardup.registers(a, probes) == neardup.registers(b, probes)).mean()
            c = neardup.chance_match(float(n), float(n))
            guesses.append((agree - c) / (1 - c))
        assert abs(np.mean(guesses) - share / (2 - share)) < 0.03


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    edges = edges.unionByName(spark.createDataFrame([(900, 800), (800, 850), (7, 7)], "a long, b long"))
    got = {r["node"]: r["label"] for r in components(edges, stage_for(edges)).collect()}
    assert got == {i: 0 for i in range(301)} | {900: 800, 850: 800, 800: 800}


def test_text_ids(spark):
    same = " ".join(f"word{i}" for i in range(20))
    rows = [("b-1", same), ("a-2", same + "."), ("a-1", same), (None, same), ("z", None), ("y", "alone here it is by itself")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    found = neardup.near_duplicates(df, words=3, percent=80)
    got = {r["doc"]: (r["component_id"], r["kept"]) for r in found.collect()}
    assert got == {"b-1": ("a-1", False), "a-2": ("a-1", False), "a-1": ("a-1", True), None: ("a-1", False), "z": ("z", True), "y": ("y", True)}
    assert sorted(r["key"]["id"] for r in neardup.representatives(found).collect()) == ["a-1", "y", "z"]
