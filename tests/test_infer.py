from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from gleanery.operators.infer import RetryPolicy, ask_many, ask_one, infer
from gleanery.operators.project import build_request


def failing(times, exc):
    calls = []

    def model(requests):
        calls.append(list(requests))
        if len(calls) <= times:
            raise exc
        return [" ok \n" for _ in requests]

    return model, calls


def test_waits_between_attempts():
    waits = []
    model, calls = failing(2, RuntimeError("busy"))
    assert ask_one(model, "r", RetryPolicy(sleep=waits.append)) == {"answer": "ok", "error": None, "attempts": 3}
    assert waits == [4.0, 8.0]


def test_gives_up_without_a_last_wait():
    waits = []
    model, calls = failing(99, RuntimeError("busy"))
    got = ask_one(model, "r", RetryPolicy(sleep=waits.append))
    assert got == {"answer": None, "error": "generation failed after 3 attempts", "attempts": 3}
    assert waits == [4.0, 8.0] and len(calls) == 3


def test_wait_is_capped():
    policy = RetryPolicy(max_attempts=9)
    assert [policy.delay(k) for k in range(1, 7)] == [4, 8, 16, 32, 60, 60]


def test_other_errors_fail_at_once():
    waits = []
    model, calls = failing(99, ValueError("bad picture"))
    got = ask_one(model, "r", RetryPolicy(sleep=waits.append))
    assert got == {"answer": None, "error": "bad picture", "attempts": 1} and not waits


def test_a_bad_row_fails_alone():
    def model(requests):
        if "bad" in requests:
            raise ValueError("no")
        return [r.upper() for r in requests]

    got = ask_many(model, ["a", "bad", "c"], RetryPolicy())
    assert [(g["answer"], g["error"]) for g in got] == [("A", None), (None, "no"), ("C", None)]


def test_calls_per_request_are_bounded():
    calls, waits = [], []

    def model(requests):
        calls.append(list(requests))
        return [RuntimeError("busy") if r == "bad" else r for r in requests]

    got = ask_many(model, ["a", "bad", "c"], RetryPolicy(sleep=waits.append))
    assert calls == [["a", "bad", "c"], ["bad"], ["bad"]] and waits == [4.0, 8.0]
    assert [g["attempts"] for g in got] == [1, 3, 1] and got[1]["error"] == "generation failed after 3 attempts"

    model, calls = failing(99, RuntimeError("busy"))
    assert [g["attempts"] for g in ask_many(model, ["a", "b"], RetryPolicy(sleep=waits.append))] == [3, 3]
    assert calls == [["a", "b"], ["a"], ["a"], ["b"], ["b"]]
    model, calls = failing(1, RuntimeError("busy"))
    got = ask_many(model, ["a", "b"], RetryPolicy(max_attempts=1, sleep=waits.append))
    assert [g["answer"] for g in got] == [None, "ok"] and calls == [["a"], ["b"]]


def test_wrong_number_of_answers_is_an_error():
    got = ask_many(lambda requests: ["x"] if len(requests) == 1 else [], ["a", "b"], RetryPolicy())
    assert [g["answer"] for g in got] == ["x", "x"]


def echo():
    def factory():
        def model(requests):
            return [str(sorted(r.items()) if isinstance(r, dict) else r) for r in requests]

        return model

    return factory


def test_null_requests_are_not_sent(spark):
    df = spark.createDataFrame([("a",), (None,), ("c",)], "q string")
    rows = infer(df, echo(), "q").collect()
    assert [(r["answer"], r["attempts"]) for r in rows] == [("a", 1), (None, None), ("c", 1)]


def test_several_request_columns(spark):
    df = spark.createDataFrame([("a", 1)], "q string, n int")
    assert infer(df, echo(), ["q", "n"], "said").first()["said"] == "[('n', 1), ('q', 'a')]"


def test_model_is_made_once_per_worker_and_only_when_needed(spark):
    made = spark.sparkContext.accumulator(0)
    called = spark.sparkContext.accumulator(0)

    def factory():
        made.add(1)

        def model(requests):
            called.add(len(requests))
            return ["x" for _ in requests]

        return model

    infer(spark.range(0).select(F.col("id").cast("string").alias("q")), factory, "q").collect()
    assert made.value == 0
    df = spark.range(400).repartition(16).select(F.col("id").cast("string").alias("q"))
    assert infer(df, factory, "q").where("answer = 'x'").select("answer", "attempts").count() == 400
    assert called.value == 400
    assert 1 <= made.value <= 16


def test_with_a_resource_profile(spark, monkeypatch):
    asked = []
    plain = DataFrame.mapInArrow

    def map_in_arrow(self, func, schema, barrier=False, profile=None):
        asked.append(profile)  # local mode has no stage-level resources
        return plain(self, func, schema, barrier)

    monkeypatch.setattr(DataFrame, "mapInArrow", map_in_arrow)
    profile = ResourceProfileBuilder().require(TaskResourceRequests().cpus(1)).build
    df = build_request(spark.createDataFrame([("a", bytearray(b"i"))], "id string, image binary"), "s", "u", ["image"])

    def factory():
        def model(requests):
            return ["/".join(p["type"] for m in r for p in m["content"]) for r in requests]

        return model

    row = infer(df, factory, "messages", profile=profile).first()
    assert row["answer"] == "text/image/text" and row["id"] == "a" and row["image"] == b"i"
    assert asked == [profile]


def test_request_parts(spark):
    df = spark.createDataFrame([(bytearray(b"1"), None, "t"), (None, "a", None)], "i binary, x string, y string")
    rows = build_request(df, "sys", "ask", ["i"], ["x", "y"]).collect()
    content = [[(p["type"], p["text"], p["image"]) for p in r["messages"][1]["content"]] for r in rows]
    assert content[0] == [("image", None, b"1"), ("text", "t", None), ("text", "ask", None)]
    assert content[1] == [("text", "a", None), ("text", "ask", None)]
    assert [m["role"] for m in rows[0]["messages"]] == ["system", "user"]
    bare = build_request(df, "sys", "ask").first()["messages"]
    assert [p["text"] for p in bare[1]["content"]] == ["ask"]
