import hashlib
from zlib import crc32

from pyspark.sql import functions as F

from installarc.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(hashes, fanout):
    """(top, for each leaf its [(left, right)] from below)."""
    level, at = list(hashes), list(range(len(hashes)))
    paths = [[] for _ in hashes]
    while len(level) > 1:
        for i, k in enumerate(at):
            run = k - k % fanout
            paths[i].append(("".join(level[run:k]), "".join(level[k + 1 : run + fanout])))
        level = [h("".join(level[k : k + fanout])) for k in range(0, len(level), fanout)]
        at = [k // fanout for k in at]
    return level[0], paths


def brute(rows, fanout):
    """(doc_id, leaf, subroot, root, path) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r[0]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])], fanout) for g in groups}
    root, crown = tree([trees[g][0] for g in order], fanout)
    out = []
    for g, up in zip(order, crown):
        for x, path in zip(sorted(groups[g]), trees[g][1]):
            out.append((x[3], x[2], trees[g][0], root, path + up))
    return out


ODD = [
    (None, None, None, None, None), (1, None, "en", 3, ""), (1, "b", "en", 3, "a\nb"), (1, "b", "en", 3, "a\nb"), (1, "b", None, 3, "a"),
    (2, "é", "fr", 10**12, "x" * 300_000 + "\n"), (-5, "z", "fr", 0, "\n\n"), (3, "", "", 0, "-"), (4, "a", "en", 1, "1:a"),
]
KIND = "doc_id long, source string, lang string, n_chars long, text string"


def by_all(rows):
    return sorted(rows, key=repr)


def test_equals_brute_force(spark):
    many = [(i, f"s{i % 7 if i % 3 else 0}", "en", i, f"t\n{i}") for i in range(60)] + [(500, "lone", "en", 1, "x")]
    for rows, fanout in ((many + ODD, 3), (many[:1], 3), ([(i, "one", "en", 1, "same") for i in range(9)], 2)):
        docs = spark.createDataFrame(rows, KIND).withColumns({"tree": F.lit(1), "hash": F.lit("h"), "IDX": F.lit(2), "path": F.lit("p")})
        got = merkle.manifest(docs, fanout=fanout)
        got = got.withColumn("back", merkle.folded(F.col("path"), F.col("leaf"))).collect()
        assert all(r["back"] == r["root"] for r in got)
        found = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], [(s["left"], s["right"]) for s in r["path"]]) for r in got]
        assert by_all(found) == by_all(brute(rows, fanout))


def test_changed_rows_do_not_lead_to_the_root(spark):
    lost = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    rows = ODD + [(i, "c", "en", 1, f"{i}\n") for i in range(10, 20)]
    docs = spark.createDataFrame(rows, KIND)
    got = merkle.manifest(docs, found={"text": lost}).withColumn("back", merkle.folded(F.col("path"), F.col("found_leaf"))).collect()
    changed = {r[0] for r in rows if r[0] is not None and crc32(str(r[0]).encode()) % 2 == 0 and "\n" in (r[4] or "")}
    assert changed and {r["doc_id"] for r in got if r["back"] != r["root"]} == changed


def test_any_tables(spark):
    assert merkle.manifest(spark.createDataFrame([], KIND)).count() == 0
    named = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", None)], "doc_id string, source string")
    got = {r["doc_id"]: [(s["left"], s["right"]) for s in r["path"]] for r in merkle.manifest(named, ("doc_id", "source")).collect()}
    assert got["a"][0] == ("", leaf(("b", "x"))) and got["b"][0] == (leaf(("a", "x")), "") and len(got["c"]) == 1
