import json
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.conftest import SF
from threadline.dims import STOP_WORDS
from threadline.operators import learn, sgd, splits


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source", "lang").where("lang is not null and text is not null")
    return docs.select("doc_id", F.substring("text", 1, 400).alias("text"), "source", F.col("lang").alias("label"))


def by_formula(texts, terms, least, sizes):
    """Unit vectors of sublinear TF-IDF over the commonest terms, with the term of each column."""
    cut = [[w for w in re.findall(r"\w\w+", t.lower()) if w not in STOP_WORDS] for t in texts]
    grams = [[" ".join(ws[i : i + n]) for n in sizes for i in range(len(ws) - n + 1)] for ws in cut]
    total, df = Counter(g for gs in grams for g in gs), Counter(g for gs in grams for g in set(gs))
    known = sorted((g for g in total if df[g] >= least), key=lambda g: (-total[g], g))[:terms]
    out = []
    for gs in grams:
        tf = Counter(g for g in gs if g in set(known))
        w = {g: (1 + math.log(n)) * (math.log((1 + len(texts)) / (1 + df[g])) + 1) for g, n in tf.items()}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1
        out.append({g: x / norm for g, x in w.items()})
    return out, total, df


@pytest.mark.parametrize("sizes", [(1,), (1, 2)])
def test_features_against_the_formula(spark, rows, sizes):
    data = rows.orderBy("doc_id").collect()
    want, total, df = by_formula([r["text"] for r in data], 120, 2, sizes)
    features = learn.fit_features(rows, "label", terms=120, min_docs=2.0, sizes=sizes)
    words = features.stages[-2].getOrDefault("terms")
    assert sorted((total[w] for w in words), reverse=True) == [total[w] for w in words] and len(words) == 120
    assert words == sorted((t for t in total if df[t] >= 2), key=lambda t: (-total[t], t))[:120]
    got = features.transform(rows).orderBy("doc_id").select(vector_to_array("features").alias("x")).collect()
    for g, w in zip(got, want, strict=True):
        assert {words[k]: x for k, x in enumerate(g["x"]) if x} == pytest.approx(w)


def test_a_smaller_vocabulary_is_a_cut(rows):
    large, small = (learn.fit_features(rows, "label", terms=n, min_docs=1.0) for n in (60, 20))
    a = learn.cut_features(learn.featured(large, rows, "label", ("doc_id",)), 20)
    b = learn.featured(small, rows, "label", ("doc_id",))
    x, y = ({r[0]: r[1] for r in df.select("doc_id", vector_to_array("features")).collect()} for df in (a, b))
    assert all(x[k] == pytest.approx(y[k]) for k in y) and len(x) == len(y)


def test_descent_converges_and_does_not_follow_the_tasks(spark, rows):
    features = learn.fit_features(rows, "label")
    ready = learn.featured(features, rows, "label")
    found = [sgd.SgdClassifier(weightCol="weight").fit(ready.repartition(n)) for n in (1, 7)]
    assert np.allclose(found[0].matrix(), found[1].matrix())
    right = found[0].transform(ready).agg(F.avg((F.col("prediction") == F.col("_label")).cast("double"))).first()[0]
    assert right > 0.95
    longer = sgd.SgdClassifier(weightCol="weight", epochs=24, tol=-1.0).fit(ready)
    last = sgd.SgdClassifier(weightCol="weight", epochs=25, tol=-1.0).fit(ready)
    assert np.abs(longer.matrix() - last.matrix()).max() < 0.1 * np.abs(last.matrix()).max()  # later epochs move the weights little


def test_grid_against_a_search_step_by_step(spark, rows):
    grids = {"multinomial_bayes": {"smoothing": [0.5, 2.0]}, "logistic": {"regParam": [0.01], "balanced": [True, False]}}
    vectors = {"sizes": [(1,)], "min_docs": [2.0], "terms": [30, 60]}
    got = learn.grid_search(rows, "label", "doc_id", grids, vectors, folds=2).collect()
    assert len(got) == 8 and sum(r["rank"] == 1 for r in got) == 2
    dealt = splits.stratified_folds(rows, "doc_id", "label", 2)
    for r in got[:3]:
        vector, values = json.loads(r["vector"]), json.loads(r["parameters"])
        each = []
        for k in range(2):
            a, b = dealt.where(F.col("fold") != k), dealt.where(F.col("fold") == k)
            features = learn.fit_features(a, "label", terms=vector["terms"], min_docs=2.0, sizes=(1,))
            model = learn.with_parameters(learn.models()[r["model"]], values).fit(learn.featured(features, a, "label"))
            each.append(learn.scores(learn.judged(model, features, learn.featured(features, b, "label"), "label"), "label", "").first()["weighted_f1"])
        assert r["mean_weighted_f1"] == pytest.approx(np.mean(each), abs=0.02)
    model, best = learn.tune(rows, "label", "doc_id", "logistic", grids["logistic"], 2, vectors=vectors)
    assert best == json.loads(next(r["parameters"] for r in got if r["rank"] == 1 and r["model"] == "logistic")) | {"sizes": [1], "min_docs": 2.0} | {"terms": best["terms"]}
    assert learn.predict(model, rows, "label").where("predicted = label").count() > 0.8 * rows.count()


def test_all_families_and_their_weights(rows):
    assert set(learn.models()) == {"logistic", "linear_svm", "complement_bayes", "multinomial_bayes", "sgd", "forest", "boosting"}
    assert {n for n, m in learn.models().items() if m.hasParam("weightCol") and m.isSet(m.weightCol)} == {"logistic", "linear_svm", "sgd", "forest"}


def test_scoring_cleans_and_normalises(spark, rows):
    model = learn.train(rows, "label", learn.models()["multinomial_bayes"])
    raw = spark.createDataFrame([(1, "THE <Media omitted> https://x.y of THHHE and"), (2, "<media omitted> 123 !!!"), (3, None), (4, " ")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in learn.score_texts(model, raw, "label", "OTHER", words=({"of": "off"}, {}, ("and",))).collect()}
    assert got[1]["normalised"] == "the off the and" and got[1]["text"].startswith("THE <Media")
    assert all((got[k]["predicted"], got[k]["confidence"], got[k]["probabilities"]) == ("OTHER", 100.0, {}) for k in (2, 3, 4))
    assert set(got[1]["probabilities"]) == {"en", "de", "fr", "es"} and sum(got[1]["probabilities"].values()) == pytest.approx(100, abs=0.05)


def test_group_folds_beyond_the_greedy_ones(spark):
    rng = np.random.default_rng(0)
    rows = spark.createDataFrame([(g, str(rng.choice(["a", "b", "c"], p=[0.7, 0.25, 0.05]))) for g in range(3000) for _ in range(int(rng.integers(1, 5)))] + [(9999, "c")] * 300 + [(None, "a"), (1, None)], "g long, label string")
    dealt = splits.group_folds(rows, "g", "label", 5, greedy=200)
    assert dealt.groupBy("g").agg(F.countDistinct("fold").alias("n")).where("n > 1").isEmpty()
    assert dealt.count() == rows.count() - 2
    shares = {(r["fold"], r["label"]): r["share"] for r in splits.fold_shares(dealt.where("g <> 9999"), "label").collect()}
    whole = {r["label"]: r["n"] / (dealt.count() - 300) for r in dealt.where("g <> 9999").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert all(abs(shares[f, c] - whole[c]) < 0.15 for f in range(5) for c in ("a", "b"))
    assert splits.group_folds(rows.limit(0), "g", "label").collect() == []
    even = splits.stratified_folds(rows, "g", "label", 4).groupBy("label", "fold").count().groupBy("label").agg((F.max("count") - F.min("count")).alias("d")).agg(F.max("d")).first()[0]
    assert even <= 1


def test_group_folds_in_ranges_are_those_of_one_range(spark):
    rng = np.random.default_rng(3)
    cells = [(g, str(rng.choice(["a", "b", "c"], p=[0.6, 0.3, 0.1]))) for g in range(400) for _ in range(int(rng.integers(1, 9)))]
    rows = spark.createDataFrame([*cells, (None, "only here")], "g long, label string")
    counts = {g: [sum(c == (g, x) for c in cells) for x in "abc"] for g, _ in cells}
    order = sorted(counts, key=lambda g: (-(3 * sum(n * n for n in counts[g]) - sum(counts[g]) ** 2), g))
    own = np.array([counts[g] for g in order], float)
    want = dict(zip(order, splits.greedy_folds(own, 5, np.zeros((5, 3)), own.sum(axis=0)), strict=True))
    for some in (60, 10**6):
        got = {r["g"]: r["fold"] for r in splits.group_folds(rows, "g", "label", 5, greedy=some).select("g", "fold").distinct().collect()}
        assert got == want
