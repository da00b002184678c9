"""Payloads of any shape."""

from installarc.plans.payloads import broken_payloads, named_blocks


def test_blocks_wherever_they_lie(spark):
    rows = [
        (1, '{"goal":{"country_code_to_goal_value":{"US":1,"DE":"2.5","FR":null,"IT":"x"}}}'),
        (2, '[[{"a":{"b":{"country_code_to_daily_budget":{"US":3.5}}}}],{"country_code_to_goal_value":{}}]'),
        (3, '{"country_code_to_goal_value":{"US":{"country_code_to_goal_value":{"DE":9}}}}'),
        (4, '{"goal":'), (5, None), (6, ""), (7, "7"), (8, '{"country_code_to_goal_value":5}'), (9, '{"country_code_to_goal_value":["a"]}'),
    ]
    df = spark.createDataFrame(rows, "id int, payload string")
    got = sorted(((r["id"], r["kind"], r["country_code"], r["amount"]) for r in named_blocks(df, ["id"]).collect()), key=repr)
    want = [
        (1, "goal", "US", 1.0), (1, "goal", "DE", 2.5), (1, "goal", "FR", None), (1, "goal", "IT", None), (2, "budget", "US", 3.5),
        (3, "goal", "US", None), (9, "goal", None, None),
    ]
    assert got == sorted(want, key=repr)
    assert {r["id"]: r["broken_count"] for r in broken_payloads(df, ["id"]).collect()} == {i: int(i in (4, 6)) for i in range(1, 10)}
    assert named_blocks(df.limit(0), ["id"]).count() == 0
    assert named_blocks(df.filter("id = 2"), ["id"], depth=2).count() == 0
