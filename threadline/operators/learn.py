"""Splits, class weights and classifiers on the features."""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from functools import reduce
from itertools import product

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import CountVectorizerModel, NGram, Normalizer, RegexTokenizer, SQLTransformer, StopWordsRemover, StringIndexer, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadline.dims import STOP_WORDS
from threadline.functions.text import clean_text, normalised_texts, softmax
from threadline.operators.features import gram_totals, materialised, words_from, written
from threadline.operators.reports import class_metrics, summary_metrics
from threadline.operators.sgd import SgdClassifier
from threadline.operators.splits import stratified_folds


def hash_fold(key: str, folds: int = 5) -> Column:
    """Fold of a key, from the first 32 bits of the MD5 digest of its text form."""
    return (F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % folds).cast("int")


def group_split(rows: DataFrame, group: str, folds: int = 5) -> DataFrame:
    """Add ``split``: whole groups on one side, the first of ``folds`` folds is the test side. A fold depends on the group alone, so nothing is shuffled."""
    return rows.where(F.col(group).isNotNull()).withColumn("split", F.when(hash_fold(group, folds) == 0, "test").otherwise("train"))


def leaking_groups(rows: DataFrame, group: str) -> DataFrame:
    """Groups that stand on both sides; empty for a sound split."""
    return rows.groupBy(group).agg(F.countDistinct("split").alias("sides")).where("sides > 1")


def split_summary(rows: DataFrame, label: str) -> DataFrame:
    """Rows per label and side."""
    return rows.groupBy(label).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "test").alias("test"))


def balanced_weights(rows: DataFrame, label: str) -> DataFrame:
    """Add ``weight`` = N / (classes * class size)."""
    sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    totals = sizes.agg(F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_k"))
    weights = sizes.crossJoin(totals).select(F.col(label).alias("_l"), (F.col("_all") * 1.0 / (F.col("_k") * F.col("_n"))).alias("weight"))
    return rows.join(F.broadcast(weights), F.col(label) == F.col("_l")).drop("_l")  # a row a class: dealt by label, all rows would go to a few tasks


class TopTerms(Estimator):
    """Fits ``TermWeights`` of the commonest terms of ``_terms``: at least ``min_docs`` rows hold them, ties go by term, so a smaller vocabulary begins a larger one.

    A longer n-gram is no commoner than its words. So where enough single words are known, only n-grams of words as common as the
    last of these are counted: nearly all n-grams are rare, and they are neither shuffled nor held.
    """

    def __init__(self, terms: int, min_docs: float, sizes: tuple[int, ...] = (1, 2)) -> None:
        super().__init__()
        self.terms, self.min_docs, self.sizes = terms, min_docs, sizes

    def _fit(self, dataset: DataFrame) -> TermWeights:
        words, often = written(dataset.select("_words")), F.col("d") >= self.min_docs
        single = materialised(gram_totals(words, F.col("_words"), (1,)).where(often))
        parts = [single] if 1 in self.sizes else []
        if longer := tuple(n for n in self.sizes if n > 1):
            first = single.orderBy(F.desc("n"), "term").limit(self.terms).collect()  # no more than ``terms``
            known = words_from(single, first[-1]["n"] if len(first) == self.terms and first and parts else 1)
            parts.append(gram_totals(words, F.col("_words"), longer, known).where(often))
        top = reduce(DataFrame.unionByName, parts).orderBy(F.desc("n"), "term").limit(self.terms).collect()
        n = words.count()
        return TermWeights(terms=[r["term"] for r in top], idf=[math.log((1 + n) / (1 + r["d"])) + 1 for r in top])


class TermWeights(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Add ``_weights``: (1 + ln tf) idf of the known terms of ``_terms``, zero where there is none."""

    terms = Param(Params._dummy(), "terms", "the vocabulary in order", TypeConverters.toListString)
    idf = Param(Params._dummy(), "idf", "inverse document frequency of each term", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, terms: list[str] | None = None, idf: list[float] | None = None) -> None:
        super().__init__()
        if terms is not None:
            self._set(terms=terms, idf=idf)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        words, idf = self.getOrDefault(self.terms) or ["\u0000"], self.getOrDefault(self.idf) or [0.0]
        counted = CountVectorizerModel.from_vocabulary(words, inputCol="_terms", outputCol="_tf").transform(dataset)
        weights = F.zip_with(vector_to_array("_tf"), F.array(*[F.lit(x) for x in idf]), lambda tf, x: F.when(tf > 0, (1 + F.log(tf)) * x).otherwise(0.0))
        dense = counted.withColumn("_dense", array_to_vector(weights))
        sized = VectorSizeHint(inputCol="_dense", size=len(words), handleInvalid="optimistic").transform(dense)
        return VectorAssembler(inputCols=["_dense"], outputCol="_weights").transform(sized).drop("_dense")  # a text has few of the terms: sparse where that is smaller


def feature_stages(text: str = "text", terms: int = 400, min_docs: float = 2.0, sizes: tuple[int, ...] = (1, 2)) -> list:
    """N-grams of some sizes to unit TF-IDF vectors: sublinear counts, idf = ln((1 + n) / (1 + df)) + 1, the commonest terms."""
    parts = ", ".join("_words" if n == 1 else f"_grams{n}" for n in sizes)
    return [
        RegexTokenizer(inputCol=text, outputCol="_raw", pattern=r"[^\p{L}\p{N}_]+", minTokenLength=2),
        StopWordsRemover(inputCol="_raw", outputCol="_words", stopWords=list(STOP_WORDS)),
        *[NGram(n=n, inputCol="_words", outputCol=f"_grams{n}") for n in sizes if n > 1],
        SQLTransformer(statement=f"SELECT *, concat({parts}) AS _terms FROM __THIS__"),
        TopTerms(terms, min_docs, sizes), Normalizer(inputCol="_weights", outputCol="features"),
    ]


def models() -> dict[str, object]:
    """Baseline classifiers by name; those that take weights balance the classes."""
    args = {"featuresCol": "features", "labelCol": "_label"}
    return {
        "logistic": LogisticRegression(**args, weightCol="weight", maxIter=30), "linear_svm": OneVsRest(**args, weightCol="weight", classifier=LinearSVC(maxIter=20)),
        "complement_bayes": NaiveBayes(**args, modelType="complement"), "multinomial_bayes": NaiveBayes(**args, modelType="multinomial"), "sgd": SgdClassifier(**args, weightCol="weight"),
        "forest": RandomForestClassifier(**args, weightCol="weight", numTrees=30, seed=1), "boosting": OneVsRest(**args, classifier=GBTClassifier(maxIter=10, maxDepth=3, seed=1)),
    }


def fit_features(rows: DataFrame, label: str, text: str = "text", **vectors) -> PipelineModel:
    """The label index and the feature stages, fitted."""
    return Pipeline(stages=[StringIndexer(inputCol=label, outputCol="_label", handleInvalid="keep", stringOrderType="alphabetAsc"), *feature_stages(text, **vectors)]).fit(rows)


def featured(features: PipelineModel, rows: DataFrame, label: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Label, its index, balanced weight and features of labelled rows, written once, so that several models do not cut up the texts again."""
    out = features.transform(balanced_weights(rows, label))
    return materialised(out.select(*{label, *keep}, "_label", "weight", "_weights", "features"))


def train_all(rows: DataFrame, label: str, chosen: dict[str, object], text: str = "text") -> dict[str, PipelineModel]:
    """Several classifiers on the same features, which are made once; each result is a whole pipeline from text to prediction."""
    features = fit_features(rows, label, text)
    ready = featured(features, rows, label)
    return {name: PipelineModel(stages=[*features.stages, model.fit(ready)]) for name, model in chosen.items()}


def train(rows: DataFrame, label: str, model: object, text: str = "text") -> PipelineModel:
    """Features and classifier fitted together, so no fold sees another's vocabulary."""
    return train_all(rows, label, {"": model}, text)[""]


def class_name(features: PipelineModel) -> Column:
    """The label of a prediction's index."""
    return F.try_element_at(F.array(*[F.lit(x) for x in features.stages[0].labels]), F.col("prediction").cast("int") + 1)


def predict(model: PipelineModel, rows: DataFrame, label: str) -> DataFrame:
    """Add ``predicted``, ``confidence`` (probability, or softmax of the decision scores), ``probabilities`` (by label, in percent, two places) and ``margin``."""
    names = F.array(*[F.lit(x) for x in model.stages[0].labels])
    out = model.transform(rows.withColumn(label, F.col(label) if label in rows.columns else F.lit(None).cast("string")))
    own = vector_to_array("probability") if "probability" in out.columns else softmax(vector_to_array("rawPrediction"))
    out = out.withColumn("_own", F.slice(own, 1, F.size(names)))
    by_name = F.map_from_arrays(F.slice(names, 1, F.size("_own")), F.transform("_own", lambda p: F.round(p * 100, 2)))
    out = out.withColumn("predicted", class_name(model)).withColumn("confidence", F.array_max("_own")).withColumn("probabilities", by_name)
    out = out.withColumn("_scores", F.array_sort("_own", lambda a, b: F.when(a > b, -1).when(a < b, 1).otherwise(0)))
    return out.withColumn("margin", F.try_element_at("_scores", F.lit(1)) - F.coalesce(F.try_element_at("_scores", F.lit(2)), F.lit(0.0)))


def class_union(train_rows: DataFrame, test_rows: DataFrame, label: str) -> DataFrame:
    """All labels of both sides."""
    return train_rows.select(label).union(test_rows.select(label)).where(F.col(label).isNotNull()).distinct()


def shared_groups(train_rows: DataFrame, test_rows: DataFrame, group: str) -> DataFrame:
    """Groups that stand on both sides; a sound split has none."""
    return train_rows.select(group).intersect(test_rows.select(group))


def filled(rows: DataFrame, text: str, token: str = "empty") -> DataFrame:
    """Blank texts replaced by a token, so every row has a feature."""
    return rows.withColumn(text, F.when(F.trim(F.coalesce(text, F.lit(""))) == "", token).otherwise(F.col(text)))


def scores(predicted: DataFrame, label: str, name: str) -> DataFrame:
    """One row: model, accuracy and the macro and weighted averages of the per-class metrics."""
    accuracy = predicted.agg(F.avg((F.col(label) == F.col("predicted")).cast("double")).alias("accuracy"))
    return accuracy.crossJoin(summary_metrics(class_metrics(predicted, label, "predicted"))).select(F.lit(name).alias("model"), "*")


def judged(fitted: object, features: PipelineModel, ready: DataFrame, label: str) -> DataFrame:
    """Rows of made features with ``predicted``."""
    return fitted.transform(ready).select(label, class_name(features).alias("predicted"))


def accuracy(predicted: DataFrame, label: str, name: str = "train_accuracy") -> DataFrame:
    """One row: the share of right predictions."""
    return predicted.agg(F.avg((F.col(label) == F.col("predicted")).cast("double")).alias(name))


def cross_validate(rows: DataFrame, label: str, key: str, chosen: dict[str, object], folds: int = 5, text: str = "text") -> DataFrame:
    """Per model the mean and deviation of accuracy and F1 over stratified folds, and the accuracy on all rows of a fit on all rows.

    The vocabulary is fitted inside each fold, once for all models.
    """
    dealt = materialised(stratified_folds(filled(rows, text), key, label, folds))
    found = []
    for k in range(folds):
        inner, outer = dealt.where(F.col("fold") != k), dealt.where(F.col("fold") == k)
        features = fit_features(inner, label, text)
        a, b = featured(features, inner, label), featured(features, outer, label)
        found += [scores(judged(model.fit(a), features, b, label), label, name) for name, model in chosen.items()]
    features = fit_features(dealt, label, text)
    ready = featured(features, dealt, label)
    seen = [accuracy(judged(model.fit(ready), features, ready, label), label).select(F.lit(name).alias("model"), "train_accuracy") for name, model in chosen.items()]
    spread = [f(c).alias(f"{n}_{c}") for c in ("accuracy", "macro_f1", "weighted_f1") for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    return reduce(DataFrame.unionByName, found).groupBy("model").agg(*spread).join(reduce(DataFrame.unionByName, seen), "model")


def with_parameters(model: object, values: dict[str, object]) -> object:
    """A copy of a classifier with some parameters; ``balanced`` False takes the class weights away. Of one against the rest the inner one is set."""
    values = dict(values)
    balanced = values.pop("balanced", True)
    if isinstance(model, OneVsRest):
        out = model.copy()
        out.setClassifier(model.getClassifier().copy({model.getClassifier().getParam(k): v for k, v in values.items()}))
    else:
        out = model.copy({model.getParam(k): v for k, v in values.items()})
    if not balanced and out.isSet(out.getParam("weightCol")):
        out.clear(out.getParam("weightCol"))
    return out


def cut_features(ready: DataFrame, terms: int) -> DataFrame:
    """Features of the first terms alone, of unit length again: a smaller vocabulary is the beginning of a larger one."""
    short = ready.withColumn("_short", F.slice(vector_to_array("_weights"), 1, terms))
    norm = F.sqrt(F.aggregate("_short", F.lit(0.0), lambda a, x: a + x * x))
    return short.withColumn("features", array_to_vector(F.transform("_short", lambda x: F.when(norm > 0, x / norm).otherwise(0.0)))).drop("_short")


def combinations(grid: dict[str, list]) -> list[dict[str, object]]:
    """All parameter sets of a grid, the last name varying fastest."""
    return [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]


#: Vectoriser parameters that are searched unless others are given.
VECTORS = {"sizes": [(1,), (1, 2)], "min_docs": [1.0, 2.0], "terms": [300, 400, 500]}


def grid_search(rows: DataFrame, label: str, key: str, grids: dict[str, dict[str, list]], vectors: dict[str, list] | None = None, folds: int = 5, text: str = "text") -> DataFrame:
    """(model, vector, parameters, mean_weighted_f1, rank) of every family, vectoriser and parameter set over stratified folds; rank 1 is a family's best, ties by the order of the grid.

    The texts are cut up once a fold, n-gram sizes and least document count, with the largest vocabulary; smaller ones are cuts of
    it. So what is fitted most is classifiers on written features.
    """
    vectors = vectors or VECTORS
    dealt = materialised(stratified_folds(filled(rows, text), key, label, folds))
    found = []
    for sizes, least in product(vectors["sizes"], vectors["min_docs"]):
        for k in range(folds):
            inner, outer = dealt.where(F.col("fold") != k), dealt.where(F.col("fold") == k)
            features = fit_features(inner, label, text, terms=max(vectors["terms"]), min_docs=least, sizes=sizes)
            whole = [featured(features, side, label) for side in (inner, outer)]
            for terms in vectors["terms"]:
                a, b = (materialised(cut_features(x, terms)) for x in whole)
                for name, grid in grids.items():
                    for values in combinations(grid):
                        got = scores(judged(with_parameters(models()[name], values).fit(a), features, b, label), label, name).first()
                        found.append((name, json.dumps({"sizes": sizes, "min_docs": least, "terms": terms}), json.dumps(values), len(found), float(got["weighted_f1"] or 0.0)))
    spark = rows.sparkSession
    table = spark.createDataFrame(found, "model string, vector string, parameters string, n long, f1 double")  # a row a fit
    means = table.groupBy("model", "vector", "parameters").agg(F.avg("f1").alias("mean_weighted_f1"), F.min("n").alias("_n"))
    best = Window.partitionBy("model").orderBy(F.desc("mean_weighted_f1"), "_n")
    return means.withColumn("rank", F.row_number().over(best)).drop("_n")


def tune(rows: DataFrame, label: str, key: str, name: str, grid: dict[str, list], folds: int = 5, text: str = "text", vectors: dict[str, list] | None = None) -> tuple[PipelineModel, dict[str, object]]:
    """Grid search of one family by weighted F1 over folds; the best pipeline, fitted on all rows, and its parameters. The vectoriser's are searched too if given."""
    searched = grid_search(rows, label, key, {name: grid}, vectors or {"sizes": [(1, 2)], "min_docs": [2.0], "terms": [400]}, folds, text)
    top = searched.where("rank = 1").first()
    values, vector = json.loads(top["parameters"]), json.loads(top["vector"])
    full = filled(rows, text)
    features = fit_features(full, label, text, terms=vector["terms"], min_docs=vector["min_docs"], sizes=tuple(vector["sizes"]))
    best = with_parameters(models()[name], values).fit(featured(features, full, label))
    return PipelineModel(stages=[*features.stages, best]), values | (vector if vectors else {})


def evaluate(fitted: dict[str, PipelineModel], train_rows: DataFrame, test_rows: DataFrame, label: str) -> DataFrame:
    """Metrics of fitted models on the test side, with the gap of accuracy to the training side, best first, ties by name."""
    found = []
    for name, model in fitted.items():
        seen = accuracy(predict(model, train_rows, label), label)
        found.append(scores(predict(model, test_rows, label), label, name).crossJoin(seen).withColumn("gap", F.col("train_accuracy") - F.col("accuracy")))
    return reduce(DataFrame.unionByName, found).orderBy(F.desc("accuracy"), "model")


def train_and_evaluate(train_rows: DataFrame, test_rows: DataFrame, label: str, chosen: dict[str, object], text: str = "text") -> DataFrame:
    """``evaluate`` of several classifiers that are fitted here, the features of both sides being made once."""
    features = fit_features(train_rows, label, text)
    a, b = featured(features, train_rows, label), featured(features, test_rows, label)
    found = []
    for name, model in chosen.items():
        fitted = model.fit(a)
        seen = accuracy(judged(fitted, features, a, label), label)
        found.append(materialised(scores(judged(fitted, features, b, label), label, name).crossJoin(seen).withColumn("gap", F.col("train_accuracy") - F.col("accuracy"))))
    return reduce(DataFrame.unionByName, found).orderBy(F.desc("accuracy"), "model")


def select_model(validated: DataFrame) -> str:
    """Name of the model with the best mean weighted F1, ties by name; one row is read."""
    return validated.orderBy(F.desc("mean_weighted_f1"), "model").first()["model"]


def keep_model(model: PipelineModel, path: str, name: str, train_rows: DataFrame, test_rows: DataFrame, group: str) -> DataFrame:
    """Save a model and return its one-row record; an error if a group stands on both sides."""
    if not shared_groups(train_rows, test_rows, group).isEmpty():
        raise ValueError(f"a {group} stands in training and test")
    model.write().overwrite().save(path)
    spark = train_rows.sparkSession
    return spark.createDataFrame([(name, path, train_rows.count(), test_rows.count())], "model string, path string, train_rows long, test_rows long")


def load_model(path: str) -> PipelineModel:
    """A kept model."""
    return PipelineModel.load(path)


def prepared(rows: DataFrame, text: str, domain: dict[str, str], general: dict[str, str], protected: tuple[str, ...]) -> DataFrame:
    """Rows with the text cleaned and its words normalised, as the texts of the training side are; null becomes empty."""
    clean = rows.withColumn(text, clean_text(F.coalesce(F.col(text), F.lit(""))))
    return normalised_texts(clean, text, domain, general, protected).withColumn(text, F.coalesce("normalised", F.lit(""))).drop("normalised", "changed")


def score_texts(model: PipelineModel, rows: DataFrame, label: str, fallback: str, text: str = "text", words: tuple[dict[str, str], dict[str, str], tuple[str, ...]] | None = None) -> DataFrame:
    """Rows with ``predicted``, ``confidence`` in percent and ``probabilities``; a blank text gets the fallback at 100 and no probabilities.

    With ``words`` (domain and general words, protected ones) raw texts are cleaned and normalised first, and count as blank if nothing is left.
    """
    own = rows.withColumn("_given", F.col(text))
    own = prepared(own, text, *words) if words else own.withColumn(text, F.coalesce(text, F.lit("")))
    blank = F.trim(F.col(text)) == ""
    out = predict(model, own.withColumn("_blank", blank), label)
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    out = out.withColumns({
        "predicted": F.when(F.col("_blank"), fallback).otherwise(F.col("predicted")), "confidence": F.when(F.col("_blank"), 100.0).otherwise(F.col("confidence") * 100),
        "probabilities": F.when(F.col("_blank"), none).otherwise(F.col("probabilities")), "normalised": F.col(text), text: F.col("_given"),
    })
    return out.drop("_given", "_blank")


def active_learning(rows: DataFrame, key: str, label: str, model: PipelineModel, relabel: Callable[[DataFrame], DataFrame], previous: DataFrame, n: int = 30, text: str = "text") -> DataFrame:
    """Score all, take the n most uncertain, relabel them with ``relabel`` (rows to (key, new_label)) and decide: (key, label, predicted, margin, new_label, status, final)."""
    from threadline.operators.labels import relabelled

    scored = predict(model, rows.withColumn(text, F.coalesce(text, F.lit(""))), label)
    asked = most_uncertain(scored, key, n, text)
    return relabelled(scored.select(key, label, "predicted", "margin"), key, label, relabel(asked.select(key, text)), previous)


def retrain(rows: DataFrame, key: str, label: str, chosen: DataFrame, model: object, text: str = "text") -> PipelineModel:
    """Fit anew with the labels of a (key, chosen) table; the rows themselves stay as they are, so this can be repeated."""
    new = rows.drop(label).join(chosen.select(key, F.col("chosen").alias(label)), key).where(F.col(label).isNotNull())
    return train(filled(new, text), label, model, text)


def most_uncertain(scored: DataFrame, id_col: str, n: int, text: str = "text") -> DataFrame:
    """The n rows of smallest margin with a text; a top-k."""
    return scored.where(F.trim(F.col(text)) != "").orderBy("margin", id_col).limit(n)
