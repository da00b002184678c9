from installarc.llm import decontamination as d

ITEM = "one two three four five six seven eight nine ten eleven"


def found(spark, docs, items, **more):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    return [tuple(r)[2:] + (r["doc"],) for r in d.contamination(docs, items, **more).collect()]


def test_words_windows_and_overlaps(spark):
    docs = [
        (1, "x ONE, two-three four five six seven eight nine; ten! y"),
        (2, f"{ITEM} {ITEM}"),
        (3, "one two three four five six seven eight nine"),
        (4, "Kurz"),
        (5, None),
        (6, ""),
        (7, "... \n"),
        (None, "kurz kurz"),
        (4, "Kurz"),
    ]
    items = [(10, ITEM), (9, ITEM), (2, "kurz"), (3, None), (4, ""), (None, "absent kurz")]
    got = sorted(found(spark, docs, items), key=str)
    want = [
        (12, 10, ["10", "9"], True, 1),
        (22, 22, ["10", "9"], True, 2),
        (9, 0, [], False, 3),
        (1, 1, ["2"], True, 4),
        (1, 1, ["2"], True, 4),
        (0, 0, [], False, 5),
        (0, 0, [], False, 6),
        (0, 0, [], False, 7),
        (2, 2, ["2"], True, None),
    ]
    assert got == sorted(want, key=str)


def test_no_items_and_no_documents(spark):
    assert [r[:2] for r in found(spark, [(1, "a b")], [])] == [(2, 0)]
    assert found(spark, [], [(1, "a")]) == []


def test_full_index_equals_restricted_one(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    terms = d.phrases_of(items, 10).selectExpr("explode(cast(words as array<binary>)) as term").distinct()
    some = d.build_index(docs, vocabulary=terms, block_bytes=10_000)
    whole = d.build_index(docs, vocabulary=terms, vocabulary_limit=1, block_bytes=10_000)
    a = some.filter("term is not null").select("term", "n")
    b = whole.join(terms, "term", "left_semi").select("term", "n")
    assert a.count() and a.groupBy("term").sum("n").exceptAll(b.groupBy("term").sum("n")).count() == 0
    assert whole.filter("term is not null").count() > a.count()


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "b x a y c"), (2, "a b"), (3, "c"), (4, "a x x x x b c")], "doc_id long, text string")
    index = d.build_index(docs)
    phrases = spark.createDataFrame([(5, ["a", "b", "c"])], "phrase long, words array<string>")
    assert [tuple(r)[0:1] + tuple(r)[2:] for r in d.near_matches(index, phrases, 2).collect()] == [(1, 5, 0, 4)]
    assert d.near_matches(index, phrases, 1).count() == 0
    assert d.near_matches(index, phrases, 4).count() == 2
