from pyspark.sql import functions as F

from installarc.llm import lines


def test_odd_rows(spark):
    long = " ".join(f"p{i}" for i in range(30))
    rows = [(None, long), (7, long), (7, long), (7, long + "\nq")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("text", "Text")
    got = lines.dedup_lines(docs).collect()
    assert len(got) == 4 and [r["n_removed"] for r in got if r["doc_id"] is None] == [1]
    assert sorted(r["n_removed"] for r in got if r["doc_id"] == 7) in ([0, 0, 1], [0, 1, 1])
    named = spark.createDataFrame([("a", long), ("b", long)], "doc_id string, text string")
    assert {r["doc_id"]: r["n_removed"] for r in lines.dedup_lines(named).collect()} == {"a": 0, "b": 1}
    assert lines.dedup_lines(docs.limit(0)).count() == 0
    clash = docs.withColumns({"_line_key": F.lit(1), "_Gone": F.lit(2), "n_lines": F.lit(3), "key": F.lit(4), "print": F.lit(5)})
    found = lines.dedup_lines(clash)
    assert {"_line_key", "_Gone", "key", "print"} <= set(found.columns) and found.agg(F.sum("n_removed")).first()[0] == sum(r["n_removed"] for r in got)


def equal_runs(rows, least):
    """Runs by equal lines alone: each earlier equal line is followed as far as the lines stay equal."""
    docs = [((text or "").split("\n"), doc) for doc, text in sorted(rows)]
    places, out = {}, {}
    for d, (parts, doc) in enumerate(docs):
        gone = set()
        for i, line in enumerate(parts):
            for e, j in places.get(line, ()):
                earlier, k = docs[e][0], 0
                while i + k < len(parts) and j + k < len(earlier) and parts[i + k] == earlier[j + k]:
                    k += 1
                if sum(len(x.encode().split()) for x in parts[i : i + k]) >= least:
                    gone |= set(range(i, i + k))
            places.setdefault(line, []).append((d, i))
        out[doc] = sorted(gone)
    return out


def test_whole_runs_equal_runs_of_equal_lines(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    long, short = (" ".join(f"{w}{i}" for i in range(n)) for w, n in (("l", 40), ("s", 20)))
    rows += [(1000, f"a\n{long}\n{short}\n\nb"), (1001, f"c\n\n{long}\n{short}\n\nd"), (1002, f"{short}\n{long}"), (1003, f"{short}\n{long}\ne")]
    rows += [(1004, f"{long}\ntail"), (1005, f"{long}\ntail"), (1006, "\n".join(["x y z"] * 30)), (1007, ""), (1008, f"{short}\nend")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for least in (25, 6):
        got = {r["doc_id"]: r["removed"] for r in lines.dedup_lines(docs, least).collect()}
        assert got == equal_runs(rows, least)
        if least == 25:
            assert got[1001] == [2, 3, 4] and got[1005] == [0, 1] and got[1008] == []
