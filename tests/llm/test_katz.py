import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from installarc.llm import katz


def discounts(n):
    out, limit = {}, (6 * n[6] / n[1] if n[1] else 1.0)
    for r in range(1, 6):
        d = ((r + 1) * n[r + 1] / n[r] / r - limit) / (1 - limit) if n[r] and limit < 1 else 0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


def model(texts):
    """Probability of a word after a word, straight from the definition."""
    uni, bi = Counter(), Counter()
    for t in texts:
        uni.update(t)
        bi.update(zip(["<s>", *t], t))
    total, starts = sum(uni.values()), len(texts)
    d1, d2 = discounts(Counter(uni.values())), discounts(Counter(bi.values()))
    kept = sum(d1.get(c, 1.0) * c for c in uni.values())
    unknown = max(total - kept, total / (total + 1)) / total if total else 1.0

    def p1(w):
        return d1.get(uni[w], 1.0) * uni[w] * (1 - unknown) / kept if uni[w] else unknown

    followers = defaultdict(dict)
    for (h, w), c in bi.items():
        followers[h][w] = c

    def p2(w, h):
        c_h = starts if h == "<s>" else uni[h]
        if not c_h:
            return p1(w)
        seen = sum(d2.get(c, 1.0) * c for c in followers[h].values())
        scale = 1 / (c_h + 1) if c_h - seen < 1e-9 * c_h else 1 / c_h
        if w in followers[h]:
            return scale * d2.get(followers[h][w], 1.0) * followers[h][w]
        return (1 - scale * seen) / (1 - sum(map(p1, followers[h]))) * p1(w)

    return uni, p1, p2


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall("[^ \t-\r]+", lower), "</s>"]


@pytest.mark.parametrize("bucket_pairs", [1_000_000, 2_000])
def test_scores_match_the_definition(spark, small, bucket_pairs):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(1001, None), (1002, ""), (1002, ""), (None, "the AND the\x0bx")], "doc_id long, text string")
    docs = docs.unionByName(odd)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    got = katz.katz_scores(docs, ~held, block_bytes=50_000, bucket_words=60_000, bucket_pairs=bucket_pairs).collect()
    rows = [(r["doc_id"], tokens(r["text"])) for r in docs.collect()]
    learnt = [t for i, t in rows if i is None or crc32(str(i).encode()) % 7 != 2]
    uni, p1, p2 = model(learnt)
    n, v = sum(uni.values()), len(uni)
    want = Counter()
    for i, t in rows:
        base = sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in t)
        score = sum(math.log10(p2(w, h)) for h, w in zip(["<s>", *t], t))
        want[i, len(t), sum(uni[w] > 0 for w in t), round(base, 6), round(score, 6)] += 1
    assert {r["train_tokens"] for r in got} == {n}
    have = Counter((r["doc"], r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in got)
    assert have == want
    some = list(uni)
    for h in ("<s>", some[0], some[5], some[50]):
        assert math.isclose(sum(p2(w, h) for w in some) + p2("never seen", h), 1.0, rel_tol=1e-9)


def test_nothing_learnt_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = {r["doc"]: r for r in katz.katz_scores(docs, F.lit(False)).collect()}
    assert rows[1]["n_known"] == 0 and rows[1]["score"] == 0 and rows[2]["n_tokens"] == 1
    assert katz.katz_scores(docs.limit(0), F.lit(True)).count() == 0
