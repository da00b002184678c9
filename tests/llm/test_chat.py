from pyspark.sql import functions as F

from installarc.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, part string"


def test_every_view_is_the_whole_dialogue(spark):
    rows = [(1, i, ("anna", "Bo Li", "system", "cy")[i % 4], f"t{i} <|im_end|> <\\", "x") for i in range(150)]
    got = chat.perspectives(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["participant"] for r in got} == {"anna", "Bo Li", "cy"} and {r["part"] for r in got} == {0, 1, 2}
    for who in ("anna", "Bo Li", "cy"):
        parts = sorted((r for r in got if r["participant"] == who), key=lambda r: (r["part"], r["piece"]))
        whole = "".join(r["text"] for r in parts)
        assert whole.count("<|im_start|>") == whole.count("<|im_end|>") == 150
        trained = [r["text"][s["start"] : s["end"]] for r in parts for s in r["spans"]]
        own = [t for _, _, role, t, _ in rows if role == who]
        assert [t.removesuffix("<|im_end|>").replace("<\\|", "<|").replace("<\\\\", "<\\") for t in trained] == own
        assert whole.count("<|im_start|>assistant\n") == len(own)
        assert "user name=Bo_Li" in whole or who == "Bo Li"


def test_odd_rows(spark):
    rows = [
        (None, None, "a", None, None),
        (None, 1, None, "who", None),
        (2, 0, "system", "alone", None),
        (3, 0, "a", "x", None),
        (3, 0, "a", "x", None),
        (3, 0, "b", "", None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["conv_id"], r["participant"], r["part"]): r for r in chat.perspectives(df).collect()}
    assert set(got) == {(None, "a", 0), (None, "a", None), (3, "a", 0), (3, "b", 0)}
    assert got[None, "a", 0]["text"] == "<|im_start|>user name=unknown\nwho<|im_end|>\n"
    assert got[3, "a", 0]["n_turns"] == 3 and len(got[3, "a", 0]["spans"]) == 2
    many = df.filter("conv_id = 3").withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(50))))
    pieces = chat.perspectives(many.drop("i"), part_turns=16).filter("participant = 'a'").collect()
    assert sum(r["n_turns"] for r in pieces) == 150 and max(r["n_turns"] for r in pieces) == 16
    assert chat.perspectives(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, small):
    from installarc.llm import queries

    for name in ("op2_chat_perspectives", "op6_host_reputation"):
        plan = queries.QUERIES[name](spark, small)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
