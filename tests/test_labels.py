import numpy as np
import pytest
from pyspark.sql import functions as F

from threadline.dims import Category, Taxonomy
from threadline.functions import text as T
from threadline.operators import labels, learn

TAXONOMY = Taxonomy((Category("A", ("red",), (), "about red things"), Category("B", ("blue",), (), "about blue things")))


def test_contract(spark):
    rows = [("A", "1.7", None, "why " * 50, None, False, None), ("ODD", "x", None, None, "issue", False, None), ("B", "-1", "e", "r", "i", True, " "), ("A", "0.5", None, "r", None, False, "NEW_ONE"), (" ", "0.2", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "label string, confidence string, evidence string, reason string, main_issue string, needs_new boolean, proposal string").withColumn("kategori", F.lit(None).cast("string"))
    out = [r["c"] for r in df.select(labels.label_contract(F.struct(*df.columns), TAXONOMY).alias("c")).collect()]
    assert [(c["label"], c["confidence"], c["needs_new"], c["proposal"]) for c in out] == [("A", 1.0, False, None), ("OTHER", 0.0, True, "ODD"), ("B", 0.0, True, "B"), ("A", 0.5, True, "NEW_ONE"), ("OTHER", 0.2, True, None)]
    assert len(out[0]["evidence"]) == 120 and out[1]["evidence"] == "issue"
    none = spark.range(1).select(labels.label_contract(F.from_json(F.lit(None).cast("string"), labels.ANSWER), TAXONOMY).alias("c")).first()["c"]
    assert (none["label"], none["confidence"], none["needs_new"]) == ("OTHER", 0.0, False)


def test_a_failing_call_stops_nothing(spark):
    units = spark.createDataFrame([(1, "red here", "x"), (2, "boom", "x"), (3, "blue", " ")], "k int, client_text string, context string")

    def complete(prompt):
        if "boom" in prompt:
            raise RuntimeError("down")
        return '{"label": "A", "confidence": "0.9"}'

    out = {r["k"]: r for r in labels.label_units(units, "k", TAXONOMY, complete).collect()}
    assert (out[1]["label"], out[1]["agree"], out[1]["review"]) == ("A", True, False)
    assert out[2]["error"] == "RuntimeError: down" and out[2]["label"] == "OTHER" and out[2]["review"]
    assert not out[3]["agree"]


def test_taxonomy_grows_by_sound_proposals_of_large_clusters(spark):
    rows = [(6, "green_items", "about green items", ["Green!", "leaf"]), (6, "few", "too few words here", ["one"]), (2, "SMALL_ONE", "a small cluster it is", ["a", "b"]), (9, "A", "name in use already", ["x", "y"])]
    df = spark.createDataFrame(rows, "members int, name string, definition string, keywords array<string>")
    grown = labels.grown_taxonomy(TAXONOMY, df)
    assert [c.name for c in grown.categories] == ["A", "B", "GREEN_ITEMS"] and grown.version == 2 and grown.categories[2].keywords == ("green", "leaf")
    assert labels.grown_taxonomy(TAXONOMY, df.where("members < 5")) is TAXONOMY


def test_cluster_report(spark):
    texts = spark.createDataFrame([(1, "aa"), (2, "aaaa"), (3, "bb"), (4, "cc")], "k int, t string")
    found = spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "k int, cluster int")
    out = labels.cluster_report(texts, found, "k", "t").collect()
    assert [(r["cluster"], r["members"], r["sample"]) for r in out] == [(1, 2, "aaaa"), (3, 1, "bb"), (None, 1, "cc")]


def test_overrides_that_name_nothing_are_refused(spark):
    rows = spark.createDataFrame([(1, "a")], "k int, label string")
    with pytest.raises(ValueError):
        labels.overridden(rows, "k", "label", spark.createDataFrame([(2, "b")], "k int, label string"))


def test_text_rules(spark):
    def one(c):
        return spark.range(1).select(c.alias("x")).first()["x"]

    assert one(T.clean_text(F.lit("Hi (file terlampir) IMG-2023-WA01.jpg Pesan ini telah dihapus <Media tidak disertakan> ok"))) == "hi ok"
    assert one(T.decide_status(F.lit("A"), F.lit(" "), F.lit(" "))) == "REVIEW"
    assert [one(T.letters_suffix(F.lit(n))) for n in (701, 702, 18277, 18278)] == ["zz", "aaa", "zzz", "aaaa"]
    assert one(T.parse_time(F.lit("05/08/23 09:05"))).hour == 9 and one(T.parse_time(F.lit("2023-08-05 09:05"))) is None


def made(spark):
    rng = np.random.default_rng(2)
    words = {"x": "red rose ruby rust".split(), "y": "blue sky sea ink".split(), "z": "green leaf moss fern".split()}
    rows = [(i, f"g{i % 17}", k, " ".join([*rng.choice(words[k], 6), *rng.choice("so it was then".split(), 4)])) for i, k in enumerate("xyz" * 40)]
    return spark.createDataFrame(rows, "id int, grp string, label string, text string")


def test_models_learn_validate_and_are_selected(spark, tmp_path):
    rows = made(spark)
    kinds = {k: learn.models()[k] for k in ("complement_bayes", "logistic")}
    validated = learn.cross_validate(rows, "label", "id", kinds, folds=2)
    got = {r["model"]: r for r in validated.collect()}
    assert set(got) == set(kinds) and all(r["mean_accuracy"] > 0.9 and r["mean_weighted_f1"] > 0.9 for r in got.values())
    assert learn.select_model(validated) in kinds
    split = learn.group_split(rows, "grp")
    assert learn.leaking_groups(split, "grp").isEmpty()
    a, b = (split.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    fitted = {k: learn.train(a, "label", m) for k, m in kinds.items()}
    ranked = learn.evaluate(fitted, a, b, "label").collect()
    assert ranked[0]["accuracy"] >= ranked[-1]["accuracy"] > 0.9
    record = learn.keep_model(fitted["logistic"], f"{tmp_path}/m", "logistic", a, b, "grp").first()
    assert record["train_rows"] + record["test_rows"] == rows.count()
    blank = spark.createDataFrame([(1, "red ruby"), (2, " "), (3, None)], "id int, text string")
    scored = {r["id"]: (r["predicted"], round(r["confidence"])) for r in learn.score_texts(learn.PipelineModel.load(f"{tmp_path}/m"), blank, "label", "OTHER").collect()}
    assert scored[1][0] == "x" and scored[2] == scored[3] == ("OTHER", 100)


def test_tuning_and_active_learning(spark):
    rows = made(spark)
    model, best = learn.tune(rows, "label", "id", "logistic", {"regParam": [0.01, 5.0]}, folds=2)
    assert best["regParam"] == 0.01
    asked = []

    def relabel(few):
        asked.append(few.count())
        return few.select("id", F.lit("y").alias("new_label"))

    out = learn.active_learning(rows, "id", "label", model, relabel, spark.createDataFrame([(i, "y") for i in range(200)], "id int, previous_label string"), n=7)
    counts = {r["status"]: r["count"] for r in out.groupBy("status").count().collect()}
    assert asked == [7] and sum(counts.values()) == 120 and counts.get("UPDATE", 0) + counts["KEEP"] == 120
    again = learn.retrain(rows, "id", "label", rows.select("id", F.col("label").alias("chosen")), learn.models()["complement_bayes"])
    assert learn.predict(again, rows, "label").where("label = predicted").count() > 110
