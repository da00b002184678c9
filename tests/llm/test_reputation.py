import math
import random

import duckdb
from pyspark.sql import functions as F

from checks.compare import compare
from installarc.llm import reputation
from installarc.llm.queries import ORACLES, RULES, op6_host_reputation


def judged(spark, urls, outcomes=(), **more):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame(list(outcomes), "page_id long, bad int")
    return {r["page_id"]: r for r in reputation.judge(pages, labels, RULES, **more).collect()}


def test_blocking_equals_sql(spark, tmp_path):
    rng, urls, bad = random.Random(3), [], []
    for host in range(60):
        share = rng.choice([0.02, 0.1, 0.97])
        suffix = rng.choice(["org", "co.uk", "de"])
        for i in range(rng.choice([1, 3, 40])):
            urls.append(f"http://h{host}.d{host % 25}.{suffix}/{i}")
            bad.append(int(rng.random() < share))
    urls += [f"http://hot.org/{i}" for i in range(3000)] + ["http://10.0.0.1:8/x", None, "none"]
    bad += [int(rng.random() < 0.05) for _ in range(3000)] + [1, 1, 0]
    for name, rows, schema in (
        ("pages", list(enumerate(urls)), "page_id long, url string"),
        ("labels", [(i, 1, b) for i, b in enumerate(bad) if i % 7], "doc_id long, quality int, toxic int"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    con = duckdb.connect()
    for name in ("pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    found = op6_host_reputation(spark, str(tmp_path))
    assert compare(found, con, ORACLES["op6_host_reputation"]) == []
    assert found.filter("basis = 'reputation' and verdict = 'block'").select("host").distinct().count() >= 5


def test_clashing_names(spark):
    names = ["_host", "_labelled", "_bad", "_fit", "_low", "_own_host", "low", "n", "bad", "Host"]
    pages = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x")], "page_id long, url string")
    pages = pages.select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    outcomes = spark.createDataFrame([(1, 1, 5)], "page_id long, bad int, _fit int")
    got = reputation.judge(pages, outcomes, RULES).collect()
    assert len(got) == 2 and got[0]["_fit"] == 3 and got[0]["host"] == "a.org" and got[0]["rule"] is None


def test_rules(spark):
    urls = [
        "http://Example.COM/en/x?q",
        "https://www.example.com/en/",
        "https://a.b.example.com/de/#t",
        "http://xexample.com/en/",
        "http://example.com",
        "http://m.n.net/es/1",
        "http://net/fr/",
        "http://m.n.net/ES/1",
        "no host",
        None,
        "",
        "ftp://u@h.org:80/p?a://b/c",
    ]
    got = judged(spark, urls)
    assert [got[i]["rule"] for i in range(12)] == [
        "example.com/en/", "www.example.com/en/", "com/", "com/", None, "net/es/", "net/fr/", None, None, None, None, None
    ]
    assert got[0]["host"] == "example.com" and got[0]["path"] == "/en/x" and got[4]["path"] == ""
    assert got[9]["host"] == got[9]["path"] == "" and got[11]["host"] == "u@h.org:80" and got[11]["path"] == "/p"


def test_bad_hosts_are_blocked_and_new_ones_follow_their_domain(spark):
    urls = [f"http://bad.evil.org/{i}" for i in range(40)] + [f"http://ok.fine.org/{i}" for i in range(40)]
    urls += ["http://one.fine.org/x", "http://new.fine.org/x", "http://also.evil.org/x"]
    outcomes = [(i, 1) for i in range(40)] + [(40 + i, 0) for i in range(40)] + [(80, 1), (0, None), (None, 1)]
    got = judged(spark, urls, outcomes)
    assert {got[i]["verdict"] for i in range(40)} == {"block"} and {got[40 + i]["verdict"] for i in range(40)} == {"allow"}
    assert got[80]["verdict"] == "allow"  # a single bad page is too little
    assert got[40]["bad_low"] < got[81]["bad_low"] < got[0]["bad_low"] or got[81]["bad_low"] < got[0]["bad_low"]


def test_domains(spark):
    hosts = ["a.b.co.uk", "b.co.uk", "x.y.com", "com", "10.0.0.1", ""]
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    got = df.select(reputation.registered_domain(df.h), reputation.public_suffix(df.h)).collect()
    assert [tuple(r) for r in got] == [
        ("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("y.com", "com"), ("com", "com"), ("10.0.0.1", ""), ("", "")
    ]


def test_empty_and_repeated(spark):
    pages = spark.createDataFrame([(1, "http://a.de/", "h"), (1, "http://a.de/", "h")], "page_id long, url string, HOST string")
    labels = spark.createDataFrame([(1, 1), (1, 0)], "page_id long, bad int")
    got = reputation.judge(pages, labels, ())
    assert got.count() == 2 and got.columns == ["page_id", "url", "host", "path", "rule", "verdict", "basis", "bad_low"]
    assert reputation.judge(pages.limit(0), labels.limit(0), RULES).count() == 0


def test_hot_host_leaves_the_evidence_of_others(spark):
    drawn = random.Random(1)
    rows = [(f"h{i}.org", 100, sum(drawn.random() < 0.1 for _ in range(100))) for i in range(6000)]
    rows += [("bad.org", 500, 500), ("hot.org", 300_000, 30_000)]
    hosts, low = spark.createDataFrame(rows, "host string, n long, bad long"), []
    for some in (hosts.filter("host <> 'hot.org'"), hosts):
        got = {r["host"]: r["low"] for r in reputation.host_reputation(some).collect()}
        low.append(got.pop("bad.org"))
        assert low[-1] > 0.5 and max(got.values()) < 0.3
    assert abs(low[0] - low[1]) < 0.05


def test_likeness_is_the_likeliest(spark):
    counts = [(10, 9, 0.3), (12, 1, 0.3), (40, 3, 0.2), (7, 6, 0.4), (1, 1, 0.3), (200, 90, 0.3)]

    def log_likelihood(alike):
        w, g = 1 / alike - 1, math.lgamma
        return sum(
            g(b + w * m) - g(w * m) + g(n - b + w - w * m) - g(w - w * m) - g(n + w) + g(w) for n, b, m in counts
        )

    groups = spark.createDataFrame(counts, "n long, bad long, parent_mean double")
    best = max((k / 10000 for k in range(1, 5000)), key=log_likelihood)
    assert abs(reputation._likeness(groups, reputation.Prior()) / best - 1) < 0.02
    assert reputation._likeness(groups.filter("n = 1"), reputation.Prior()) == 0.1
