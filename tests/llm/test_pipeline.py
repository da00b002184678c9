import re
from collections import Counter

import pytest

import corpus_pipeline as pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
BLANK_WORD, TERM = "[^ \t-\r]+", "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("lang", [None, "de"])
def test_nothing_to_learn_from_drops_only_texts_without_letters(spark, lang):
    rows = [(1, "the tree", None), (2, "12 !?", lang), (3, None, lang), (4, "", "en" if lang else None), (5, "é", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = pipeline.known_language(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 5]


@pytest.fixture(scope="module")
def corpus(spark, small, tmp_path_factory):
    """The small fixture with planted cases, as a table directory."""
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{small}/documents.parquet").select(*COLUMNS)
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    text = docs.filter("doc_id = 1").first()["text"]
    item = max((r["text"] for r in items.collect()), key=lambda t: len(re.findall(TERM, lower(t))))
    planted = [
        (9001, text + " another ending", "en", "src1", 1),
        (9002, "12 !? 34", "en", "src1", 1),
        (9003, None, "en", "src1", 1),
        (9004, "the thing and the other one " + " , ".join(re.findall(TERM, item)).upper(), "en", "src2", 1),
    ]
    more = spark.createDataFrame(planted, docs.schema)
    docs.unionByName(more).write.parquet(f"{path}/documents.parquet")
    items.write.parquet(f"{path}/benchmark.parquet")
    return path


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def lettered(docs):
    return {d for d, t in docs.items() if any(c.isalpha() for c in t or "")}


def first_copies(docs):
    """Smallest ids of groups that are linked by a Jaccard similarity of 80 %; documents without words stay."""
    sets = {}
    for d, t in docs.items():
        w = re.findall(BLANK_WORD, lower(t))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    root = {d: d for d in docs}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in docs:
        for b in docs:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {d for d in docs if root[d] == d}


def free_of(docs, items):
    phrases = set()
    for t in items:
        w = re.findall(TERM, lower(t))
        phrases |= {tuple(w[i : i + 10]) for i in range(max(len(w) - 9, 1))} if w else set()
    out, lengths = set(), {len(p) for p in phrases}
    for d, t in docs.items():
        w = re.findall(TERM, lower(t))
        if not any(tuple(w[i : i + k]) in phrases for k in lengths for i in range(len(w) - k + 1)):
            out.add(d)
    return out


def test_stages_keep_what_plain_python_keeps(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect()]
    before = texts(docs)
    kept = [step(spark, docs, corpus).cache() for _, step in pipeline.STAGES]
    assert all(df.columns == COLUMNS for df in kept[:4])
    told, single, free = (Counter(r["doc_id"] for r in df.collect()) for df in kept[:3])
    assert told == Counter(lettered(before)) and not {9002, 9003} & set(told)
    assert single == Counter(first_copies(before)) and 9001 not in single
    assert free == Counter(free_of(before, items)) and 9004 not in free
    placed = kept[4].collect()
    assert Counter(r["doc_id"] for r in placed) == Counter(list(before))


def test_run_keeps_what_the_stages_keep(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect()]
    before, source = texts(docs), {r["doc_id"]: r["source"] for r in docs.collect()}
    clean = {d: before[d] for d in lettered(before)}
    clean = {d: clean[d] for d in first_copies(clean)}
    clean = {d: clean[d] for d in free_of(clean, items)}
    rows = pipeline.run(spark, corpus).collect()
    taken = Counter(r["doc_id"] for r in rows)
    assert set(taken) <= set(clean) and max(taken.values()) <= 2 and {r["text"] for r in rows} <= set(clean.values())

    size = {d: len(re.findall(BLANK_WORD, t)) for d, t in clean.items()}
    total = Counter()
    for d in clean:
        total[source[d]] += size[d]
    want, free, budget = {}, {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(total))}, 1.5 * sum(total.values())
    while full := [s for s in free if free[s] * budget / sum(free.values()) > 2 * total[s]]:
        want |= {s: 2 * total[s] for s in full}
        budget -= sum(2 * total[s] for s in full)
        free = {s: w for s, w in free.items() if s not in full}
    want |= {s: w * budget / sum(free.values()) for s, w in free.items()}
    for s in total:
        got = sum(taken[d] * size[d] for d in clean if source[d] == s)
        assert abs(got - want[s]) <= max(size.values())
        assert want[s] < 2 * total[s] or all(taken[d] == 2 for d in clean if source[d] == s)
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
