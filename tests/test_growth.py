"""Forms of plans that keep work in proportion to the input."""

import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from tests.conftest import SF
from threadline import dims
from threadline.functions import text as T
from threadline.operators import chat, dictionary, distributions, features, learn
from threadline.plans import export_queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def patterns():
    return T.word_pattern(dims.REMOTE_WORDS), T.credential_pattern(dims.CREDENTIAL_WORDS), T.word_pattern(dims.CLOSING_WORDS), T.word_pattern(dims.WAITING_WORDS)


def test_the_full_master_deals_messages_once(spark, patterns):
    messages = export_queries._roles(export_queries.parsed(spark, SF))
    once = plan(messages).count("Exchange hashpartitioning(source_file")
    assert plan(distributions.full_master(messages, dims.TAXONOMY, *patterns)).count("Exchange hashpartitioning") == plan(messages).count("Exchange hashpartitioning") and once


def test_units_have_the_labels_of_their_conversation(spark, patterns):
    remote, credentials, closing, waiting = patterns
    said = [("ADMIN", "x"), ("CLIENT", "von a"), ("ADMIN", "nicht yet"), ("CLIENT", "mit b"), ("ADMIN", "y"), ("ADMIN", "ist"), ("SYSTEM", None)]
    data = [(f"f{n}_{k}.txt", i, role, text) for n in range(len(said) + 1) for k in range(4) for i, (role, text) in enumerate(said[k:n])]
    rows = spark.createDataFrame(data, "source_file string, msg_no int, role string, text string").withColumns({"ts": F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")), "has_media": F.lit(False)})
    got = {(r["conversation_id"], r["response"], r["handling"]) for r in distributions.full_master(rows, dims.TAXONOMY, *patterns).collect()}
    keyed = rows.withColumn("c", F.concat(F.regexp_replace("source_file", ".txt$", ""), F.lit("_conv_001")))
    want = chat.response_labels(keyed, "c", "msg_no", closing, waiting).join(chat.handling_labels(keyed, "c", remote, credentials), "c")
    assert got == {(r["c"], r["response"], r["handling"]) for r in want.collect()} and {r for _, r, _ in got} == {"RESPONSE", "NO_RESPONSE"}


def test_class_weights_do_not_deal_rows_by_class(spark):
    rows = spark.range(100).withColumn("label", (F.col("id") % 3).cast("string"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are too large for a guess of the planner
    try:
        weighted = learn.balanced_weights(rows, "label")
        assert "SortMergeJoin" not in plan(weighted) and weighted.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_features_of_short_texts_are_sparse(spark):
    rows = spark.createDataFrame([(i, f"word{i} word{i + 1} word{i + 2}", "ab"[i % 2]) for i in range(60)], "id long, text string, label string")
    features = learn.fit_features(rows, "label", min_docs=1.0)
    assert all(isinstance(r["features"], SparseVector) and r["features"].size == len(features.stages[-2].getOrDefault("terms")) for r in features.transform(rows).collect())


def test_texts_are_normalised_where_they_lie(spark):
    rows = spark.createDataFrame([(1, "aa bb aa"), (2, None), (3, ""), (4, "cc")], "id long, c string")
    table = dictionary.dictionary(spark.createDataFrame([("aa", "x")], "word string, replacement string"), spark.createDataFrame([], "word string, replacement string"), spark.createDataFrame([("cc",)], "word string"))
    whole, parts = (dictionary.normalised_by_table(rows, "id", "c", table, n) for n in (100, 1))
    assert "Generate" not in plan(whole) and "Exchange" not in plan(whole)
    want = [(1, "x bb x", 2), (2, None, None), (3, "", 0), (4, "cc", 0)]
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect())) == want


def test_top_lists_sort_no_whole_table(spark):
    rows = spark.createDataFrame([("b a b a",), ("a b",), ("c c a",)], "c string")
    top = features.top_grams(rows, F.col("c"), {1: 2, 2: 1})
    assert "Window" not in plan(top)
    assert sorted(map(tuple, top.collect())) == [(1, "a", 4), (1, "b", 3), (2, "a b", 2)]


def test_only_ngrams_of_marked_words_are_put_together(spark):
    texts = ["a b  c a b", "", None, "a", "c b a b c", " b a "]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for only in (None, ["a", "b"], []):
        want = []
        for n in (1, 2, 3):
            each = [[" ".join(g) for g in zip(*(w[k:] for k in range(n)), strict=False) if only is None or set(g) <= set(only)] for w in ([x for x in (t or "").split(" ") if x] for t in texts)]
            want += [(n, g, sum(e.count(g) for e in each), sum(g in e for e in each)) for g in sorted({g for e in each for g in e})]
        assert sorted(map(tuple, features.gram_totals(rows, F.col("t"), (1, 2, 3), only).collect())) == want
    made = list(features._grams("a b c".split(), 2, frozenset("ab")))
    assert made == ["a b"]
