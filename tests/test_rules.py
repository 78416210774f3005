import datetime as dt

import pytest
from pyspark.sql import functions as F

from threadline import schemas
from threadline.dims import Category, Taxonomy
from threadline.functions import text as T
from threadline.operators import chat, reports


def at(h, m=0, day=1):
    return dt.datetime(2026, 1, day, h, m)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_gap_of_exactly_the_threshold_splits_and_system_rows_do_not_move_the_clock(spark):
    rows = [("a", i, t, r) for i, (t, r) in enumerate([(at(8), "SYSTEM"), (at(8, 5), "CLIENT"), (at(8, 10), "ADMIN"), (at(12, 10), "CLIENT"), (at(20), "SYSTEM"), (at(16, 9), "ADMIN")])]
    df = spark.createDataFrame(rows, "f string, i int, ts timestamp_ntz, role string")
    out = chat.sessionise(df, ["f"], ["i"], 4, counts=F.col("role") != "SYSTEM").orderBy("i").select("session_no").collect()
    assert [r[0] for r in out] == [1, 1, 1, 2, 2, 2]


def test_backward_step_resets_the_clock(spark):
    df = spark.createDataFrame([("a", 0, at(10)), ("a", 1, at(3)), ("a", 2, at(8))], "f string, i int, ts timestamp_ntz")
    assert [r[0] for r in chat.sessionise(df, ["f"], ["i"], 4).orderBy("i").select("session_no").collect()] == [1, 1, 2]


def test_topic_split(spark):
    taxonomy = Taxonomy((Category("A", ("red",)), Category("B", ("blue",))))
    texts = [("CLIENT", "hi"), ("CLIENT", "red"), ("ADMIN", "blue"), ("CLIENT", "red"), ("CLIENT", "blue"), ("CLIENT", "hi")]
    df = spark.createDataFrame([("c", i, r, t) for i, (r, t) in enumerate(texts)], "c string, i int, role string, text string")
    out = chat.split_topics(df, ["c"], ["i"], taxonomy).orderBy("i").collect()
    assert [(r["segment"], r["category"]) for r in out] == [(0, "A")] * 4 + [(1, "B")] * 2


@pytest.mark.parametrize("rows, want", [
    ([("ADMIN", "hello")], "NO_RESPONSE"), ([("CLIENT", "x")], "RESPONSE"), ([("ADMIN", "a"), ("CLIENT", "x")], "RESPONSE"),
    ([("CLIENT", "x"), ("ADMIN", "thanks")], "RESPONSE"), ([("CLIENT", "x"), ("ADMIN", "z" * 40)], "NO_RESPONSE"),
    ([("CLIENT", "x"), ("ADMIN", "fine")], "RESPONSE"), ([("CLIENT", "x"), ("ADMIN", "is it ok?")], "NO_RESPONSE"),
])
def test_response_rule(spark, rows, want):
    df = spark.createDataFrame([("c", i, r, t) for i, (r, t) in enumerate(rows)], "c string, i int, role string, text string")
    out = chat.response_labels(df, "c", "i", T.word_pattern(("thanks",)), T.word_pattern(("wait",))).first()
    assert out["response"] == want


def test_scalar_rules(spark):
    assert one(spark, T.reduce_elongated(F.lit("errooor"))) == "error"
    assert one(spark, T.clean_text(F.lit("Hello!! see https://x.y/z 12 abc3"))) == "hello see abc3"
    assert one(spark, T.parse_chat_time(F.lit("5/8/23"), F.lit("9.05"))) == dt.datetime(2023, 8, 5, 9, 5)
    assert one(spark, T.parse_chat_time(F.lit("31/02/23"), F.lit("10.15"))) is None
    assert one(spark, T.remote_rate(F.lit(1), F.lit(1))) == 50.0 and one(spark, T.remote_rate(F.lit(0), F.lit(0))) == 0.0
    assert [one(spark, T.decide_status(*map(F.lit, x))) for x in (("A", "A", "C"), ("A", "B", "B"), ("A", "B", "C"), ("A", "B", None))] == ["KEEP", "UPDATE", "REVIEW", "REVIEW"]
    assert [one(spark, T.letters_suffix(F.lit(n))) for n in (0, 25, 26, 52)] == ["a", "z", "aa", "ba"]
    assert one(spark, T.first_json(F.lit('x {"k": 3,} y'), "k int"))["k"] == 3


def test_errors():
    with pytest.raises(ValueError):
        schemas.require(["sub_id"])
    with pytest.raises(ValueError):
        reports.in_range(None, "ts", "2026-01-02", "2026-01-01")
