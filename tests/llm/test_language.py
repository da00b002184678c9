import math
import re

import numpy as np
from pyspark.sql import functions as F

from installarc.llm import language, queries


def test_held_out_accuracy(spark, small):
    found = queries.op4_identify_language(spark, small)
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang")
    right = found.join(docs, "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.98
    assert found.filter("score < 0 or score > 1").count() == 0


def _plain_grams(text, rows):
    """Table rows of all grams of one to three letters, in plain integers."""
    letters = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
    code = [ord(c) for c in " " + re.sub(" +", " ", letters) + " "]
    wide, out = 1 << 32, []
    for size in (1, 2, 3):
        for at in range(len(code) - size + 1):
            h = code[at] * 0x9E3779B1 % wide
            if size > 1:
                h ^= (code[at + 1] * 0x85EBCA77 + 1) % wide
            if size > 2:
                h ^= (code[at + 2] * 0xC2B2AE3D + 7) % wide
            out.append((h ^ (h >> 15)) % rows)
    return out


def test_training_and_decoding_equal_plain_python(spark, small):
    """Counts, bit weights, margins, losses and the nearest codeword, for every document, in plain Python."""
    rows = 4096
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    data = docs.collect()
    learnt = [r for r in data if r["doc_id"] % 2 and r["lang"] is not None and r["text"] is not None]
    model = language.train(docs.filter("doc_id % 2 = 1"), rows=rows)
    got = {r["doc_id"]: r for r in language.predict(docs, model).collect()}

    langs = sorted({r["lang"] for r in learnt})
    counts = {name: [0] * rows for name in langs}
    for r in learnt:
        for g in _plain_grams(r["text"], rows):
            counts[r["lang"]][g] += 1
    shares = {name: [c / sum(n) for c in n] for name, n in counts.items()}
    code = language.codewords(len(langs)).tolist()
    weights = []
    for bit in range(len(code[0])):
        on = [n for i, n in enumerate(langs) if code[i][bit] > 0]
        off = [n for i, n in enumerate(langs) if code[i][bit] < 0]
        mean = lambda names, g: sum(shares[n][g] for n in names) / len(names)
        weights.append([math.log(mean(on, g) + 0.1 / rows) - math.log(mean(off, g) + 0.1 / rows) for g in range(rows)])
    assert np.allclose(np.array(weights).T, model.weights, atol=1e-5)
    for r in data:
        told = got[r["doc_id"]]
        if not any(c.isalpha() for c in r["text"] or ""):
            assert told["lang_pred"] == "und" and told["score"] == 0
            continue
        found = _plain_grams(r["text"], rows)
        margins = [sum(w[g] for g in found) / len(found) for w in weights]
        loss = [sum(math.log1p(math.exp(-4.0 * c * m)) for c, m in zip(word, margins)) for word in code]
        share = [math.exp(min(loss) - x) for x in loss]
        share = [x / sum(share) for x in share]
        first, second = sorted(share, reverse=True)[:2]
        assert abs(told["score"] - first) < 1e-4
        if first - second > 1e-3:
            assert told["lang_pred"] == langs[share.index(first)]
        if abs(first - second - 0.05) > 1e-3:
            assert told["ambiguous"] == (first - second < 0.05)


def test_codewords_are_apart():
    for n in (2, 4, 5, 30):
        code = language.codewords(n)
        gaps = (code[:, None, :] != code[None]).sum(axis=2) + 100 * np.eye(n)
        assert gaps.min() >= max(1, code.shape[1] // 4)


def test_odd_rows(spark):
    known = [("en", "the house and the tree " * 9), ("de", "das haus und der baum " * 9), (None, "x"), ("en", None)]
    model = language.train(spark.createDataFrame(known, "lang string, text string"))
    assert model.languages == ["de", "en"]
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "123 !? 45"), (4, "THE TREE"), (5, "der baum"), (5, "der baum"), (6, "der baum " * 60_000)],
        "doc_id long, text string",
    ).withColumn("Score", F.lit("clash"))
    got = language.predict(docs, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score", "ambiguous"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert [rows[i]["lang_pred"] for i in range(1, 7)] == ["und", "und", "und", "en", "de", "de"]
    assert rows[1]["score"] == 0 and rows[1]["ambiguous"] and not rows[4]["ambiguous"]
    nothing = language.train(docs.select(F.lit(None).cast("string").alias("lang"), "text"))
    assert {r["lang_pred"] for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0
    single = language.train(spark.createDataFrame([("en", "the tree")], "lang string, text string"))
    assert {r["lang_pred"] for r in language.predict(docs, single).collect()} == {"und", "en"}
