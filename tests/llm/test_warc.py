import glob
import hashlib

import pytest
from pyspark.sql import functions as F

from installarc.llm import warc

KIND = "page_id long, url string, html string"


def inner(payload, tail="\r\n\r\n"):
    body = payload.encode()
    return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Page-ID: 666\r\nContent-Length: {len(body)}\r\n\r\n{payload}{tail}"


LONG = "same page " * 20
ROWS = [
    (1, "http://a/", "plain"), (2, "http://a/", LONG), (3, None, LONG), (4, "u\r\nWARC/1.1\r\n", LONG), (5, "x", None), (6, "x", ""),
    (7, "x", "WARC/1.1\r\n"), (8, "x", "WARC/1.0\r\nContent-Length: 99999999999999999999\r\n\r\nWARC/1."), (9, "x", inner("fake")),
    (10, "x", "before" + inner("a") + inner("b", "")), (11, "x", inner(inner("deep")) + "é" * 500), (12, "x", "\r\n\r\n\r\n\r\nWARC/1.1\r\n\r\n\r\n"),
    (13, "x", "k" * 99), (14, "x", "k" * 99), (15, "x", "k" * 100), (16, "x", "k" * 100), (0, "x", "k" * 100), (None, "y", "k" * 100), (None, None, "n"),
    (20, "t", "twin " * 30), (20, "t", "twin " * 30), (20, "t", "twin " * 30), (21, "t", "twin " * 30), (22, "x", "w" * 20_000), (23, "x", "W"),
    (24, "x", inner("x" * 5_000)[:-9]), (25, "x", "Content-Length: 3\r\n\r\n" + "WARC/1.1\r\n" * 300),
]


def expected(rows):
    out, groups = [], {}
    for i, (page, url, html) in enumerate(rows):
        groups.setdefault(html or "", []).append((page is None, page or 0, url or "", i))
    for html, members in groups.items():
        body = html.encode()
        first = rows[min(members)[-1]][0]
        for member in members:
            again = len(body) >= 100 and member != min(members)
            out.append((rows[member[-1]][0], len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


@pytest.fixture
def splits(spark):
    """A function that sets the size of Spark's splits."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def put(n):
        spark.conf.set(names[0], n)
        spark.conf.set(names[1], 0)
        spark.conf.set(names[2], 1)

    yield put
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def result(records):
    rows = warc.resolved(records).collect()
    whole = lambda x: None if x is None else int(x)
    return sorted(((whole(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["type"], whole(r["refers_to"])) for r in rows), key=repr)


def test_round_trip_in_splits_of_any_size(spark, tmp_path, splits):
    pages = spark.createDataFrame(ROWS, KIND).repartition(2).withColumns({"digest": F.lit("d"), "First": F.lit(1), "payload": F.lit("p")})
    warc.write(pages, str(tmp_path / "a"))
    for size in (10**8, 200):
        splits(size)
        found = warc.read(spark, str(tmp_path / "a"), payloads=size == 200)
        assert result(found.records) == expected(ROWS)
        assert all(r["intact"] for r in found.files.collect())
        assert found.files.agg(F.sum("records")).first()[0] == len(ROWS)
        if size == 200:
            texts = {r["page_id"]: r["payload"] for r in found.records.filter("type = 'response'").collect()}
            assert all(texts[str(p)] == (h or "") for p, _, h in ROWS if p in (1, 5, 8, 9, 10, 11, 12, 22, 24, 25))
            assert {r["url"] for r in found.records.filter("page_id = '4'").collect()} == {"u%0D%0AWARC/1.1%0D%0A"}


def test_boundaries_equal_a_walk_through_the_file(spark, tmp_path, splits):
    warc.write(spark.createDataFrame(ROWS, KIND).coalesce(1), str(tmp_path / "a"))
    offsets = set()
    for path in glob.glob(str(tmp_path / "a" / "part-*")):
        data, at = open(path, "rb").read(), 0
        while at < len(data):
            head = data.index(b"\r\n\r\n", at)
            offsets.add((path.rsplit("/", 1)[1], at))
            size = next(int(x.split(b":")[1]) for x in data[at:head].split(b"\r\n") if x.startswith(b"Content-Length"))
            at = head + 4 + size + 4
    splits(501)
    got = [(r["file"].rsplit("/", 1)[1], r["offset"]) for r in warc.read(spark, str(tmp_path / "a")).records.collect()]
    assert len(got) == len(offsets) and set(got) == offsets


def test_broken_chain_ends_there(spark, tmp_path):
    folder = tmp_path / "b"
    folder.mkdir()
    good = inner("one") + inner("two")
    (folder / "cut").write_bytes((good + inner("three"))[:-7].encode())
    (folder / "hole").write_bytes((inner("one") + "?" + inner("two")).encode())
    (folder / "late").write_bytes(("#" + good).encode())
    (folder / "fine").write_bytes(good.encode())
    (folder / "binary").write_bytes(b"WARC/1.0\r\nWARC-Type: resource\r\ncontent-length: 4\r\n\r\n\xff\xfe\x00\x80\r\n\r\n")
    found = warc.read(spark, str(folder))
    files = {r["file"].rsplit("/", 1)[1]: (r["records"], r["reached"], r["intact"]) for r in found.files.collect()}
    size = len(inner("one"))
    assert files["fine"] == (2, 2 * size, True) and files["hole"] == (1, size, False) and files["late"] == (0, 0, False)
    assert not files["cut"][2] and files["binary"][0] == 1 and files["binary"][2]
    got = [(r["file"].rsplit("/", 1)[1], r["payload_digest"]) for r in found.records.collect()]
    assert ("binary", hashlib.sha256(b"\xff\xfe\x00\x80").hexdigest()) in got and sum(f == "cut" for f, _ in got) == 2 and len(got) == 6


def test_other_ids_and_no_rows(spark, tmp_path):
    pages = spark.createDataFrame([("a b/<>\r\n", "é", LONG), ("", "", LONG)], "page_id string, url string, html string")
    warc.write(pages, str(tmp_path / "a"))
    got = {(r["page_id"], r["refers_to"]) for r in warc.resolved(warc.read(spark, str(tmp_path / "a")).records).collect()}
    assert got == {("a b/<>\r\n", ""), ("", None)}
    warc.write(pages.limit(0), str(tmp_path / "c"))
    found = warc.read(spark, str(tmp_path / "c"))
    assert found.records.count() == 0 and all(r["intact"] for r in found.files.collect())
