"""Toxicity by compression distance: two zstandard dictionaries, window lengths, calibrated thresholds.

One dictionary is trained on windows of ordinary texts, the other on windows of toxic texts around
characteristic words. Every window of a text (about one or two words, whole text) is compressed
with both; the distance of a window is the length with the ordinary dictionary minus the length with the
toxic one. A text's largest distances and the shares of windows beyond fixed distances go through
a logistic model that sets the thresholds on the labelled rows.

Characteristic words are those whose share among distinct (previous, word, next) contexts is
significantly larger in toxic texts; counting contexts rather than texts keeps copies from voting.

The fit uses a bounded sample of labelled rows: of each class those whose id hash falls below ``sample / count``
(``TOXIC_SAMPLE`` and ``ORDINARY_SAMPLE`` rows). What the model holds is bounded too: a dictionary is trained on at most about
``TRAIN_WINDOWS`` of the sample's windows, drawn by a hash of document and place, and ``CHARACTERISTIC`` words choose the
toxic ones. Nothing else is limited. The model is a function of the labelled rows and scores are one of the text alone:
neither depends on partitions or cores.

Cases: null and empty texts get the score of a text without any distance; labels that are null or
missing are not learned from, and of several labels of a document the largest counts; if a class is missing
all scores are its smoothed share; repeated rows are scored alike; extra columns are not looked at; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, table
from .language import held_out

#: Labelled rows to fit on, at most about so many of each class.
TOXIC_SAMPLE = 4000
ORDINARY_SAMPLE = 12_000
#: Windows that a dictionary is trained on, at most, and its size.
TRAIN_WINDOWS = 40_000
DICTIONARY_BYTES = 32_768
LEVEL = 12
CHARACTERISTIC = 3000
#: Least log-likelihood ratio and log odds of a characteristic word.
LEAST_RATIO = 15.0
LEAST_ODDS = 1.0
#: Up to 11 bytes that end before a blank, or one longer word.
WINDOW = re.compile(rb"(?s).{1,11}(?= )| ?[^ ]+")
SPACE = re.compile(rb"[\x09-\x0D ]+")
STEPS = (2, 3, 4, 5)


def windows(text: str | None) -> list[bytes]:
    """The windows of a whole text, in order, each between blanks."""
    flat = SPACE.sub(b" ", (text or "").encode("utf-8", "replace")).strip(b" ")
    return [w + b" " for w in WINDOW.findall(b" " + flat + b" ")] if flat else []


class Distance:
    """Compression lengths with two dictionaries; the compressors are made once a process."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.dictionaries = (ordinary, toxic)
        self.ready: list | None = None

    def __getstate__(self) -> dict:
        return {"dictionaries": self.dictionaries, "ready": None}

    def features(self, text: str | None) -> list[float]:
        """Largest distance, mean of the three largest, share and logarithmic count beyond each step."""
        if self.ready is None:
            self.ready = []
            for raw in self.dictionaries:
                known = zstandard.ZstdCompressionDict(raw)
                known.precompute_compress(level=LEVEL)
                self.ready.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        plain, toxic = self.ready
        away = np.array([len(plain(w)) - len(toxic(w)) for w in windows(text)] or [0])
        top = np.sort(away[away >= min(STEPS)])[::-1]
        best = float(top[0]) if len(top) else 0.0
        beyond = [(away >= s).sum() for s in STEPS]
        return [best, float(top[:3].sum()) / 3, *(n / len(away) for n in beyond), *(math.log1p(n) for n in beyond)]


N_FEATURES = 2 + 2 * len(STEPS)


def trained(samples: list[bytes]) -> bytes:
    """A dictionary of some windows; with too few for training, the windows themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-DICTIONARY_BYTES:] or b" "


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of a penalised logistic model by Newton steps, with the means and scales of the features."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    design = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    ridge = np.diag([penalty] * x.shape[1] + [1e-6])
    w = np.zeros(design.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grade = design.T @ (p - y) + ridge @ w
        w -= np.linalg.solve((design * (p * (1 - p) + 1e-6)[:, None]).T @ design + ridge, grade)
    return w, mean, scale


class Classifier:
    """Text to score."""

    def __init__(self, distance: Distance | None, weights: tuple[np.ndarray, np.ndarray, np.ndarray] | None, base: float) -> None:
        self.distance, self.weights, self.base = distance, weights, base

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.distance is None or self.weights is None:
            return np.full(len(texts), self.base)
        w, mean, scale = self.weights
        x = (np.array([self.distance.features(t) for t in texts]).reshape(-1, N_FEATURES) - mean) / scale
        return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def characteristic_words(sample: DataFrame) -> set[str]:
    """Words that toxic texts use in significantly more contexts. Columns of the sample: t (text), y (0 or 1)."""
    words = sample.select("y", F.filter(F.split(F.lower(F.coalesce("t", F.lit(""))), r"[\x09-\x0D ]+"), lambda w: w != "").alias("w"))
    spread = words.select("y", "w", F.posexplode("w").alias("i", "word"))
    around = F.xxhash64(F.coalesce(F.try_element_at("w", F.when(F.col("i") > 0, F.col("i"))), F.lit("")), F.coalesce(F.try_element_at("w", F.col("i") + 2), F.lit("")))
    contexts = spread.select("y", "word", around.alias("around")).distinct()
    counts = contexts.groupBy("word").agg(F.count_if(F.col("y") == 1).alias("a"), F.count_if(F.col("y") == 0).alias("b"))
    counts = cut_lineage(counts)
    total = counts.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    n_a, n_b = float(total["a"] or 1), float(total["b"] or 1)
    both = F.col("a") + F.col("b")
    part = lambda c, n: F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) * (n_a + n_b) / (both * n))).otherwise(0.0)
    ratio = 2 * (part("a", n_a) + part("b", n_b))
    odds = F.log((F.col("a") + 0.5) / n_a) - F.log((F.col("b") + 0.5) / n_b)
    top = counts.where((ratio > LEAST_RATIO) & (odds > LEAST_ODDS)).orderBy(ratio.desc(), "word").limit(CHARACTERISTIC)
    return {r["word"] for r in top.select("word").collect()}


def fit(labelled: DataFrame) -> Classifier:
    """Learn from (i, t, y) rows: id, text, label 0 or 1."""
    spark = labelled.sparkSession
    n = {r["y"]: r["n"] for r in labelled.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    base = (n.get(1, 0) + 0.5) / (n.get(0, 0) + n.get(1, 0) + 2)  # 0.25 without any label
    if not n.get(0) or not n.get(1):
        return Classifier(None, None, base)
    draw = F.pmod(F.xxhash64("i", F.lit("fit")), F.lit(1_000_000)) / 1e6
    share = F.when(F.col("y") == 1, TOXIC_SAMPLE / n[1]).otherwise(ORDINARY_SAMPLE / n[0])
    sample = cut_lineage(labelled.withColumn("i", F.col("i").cast("string")).where(draw < share).repartition(2 * spark.sparkContext.defaultParallelism, "i"))
    words = spark.sparkContext.broadcast(characteristic_words(sample))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = words.value
        for batch in batches:
            for i, y, t in zip(batch["i"], batch["y"], batch["t"], strict=True):
                own = windows(t)
                if y == 1:
                    own = [w for w in own if any(p in known for p in w.decode("utf-8", "ignore").lower().split())]
                if own:
                    yield pd.DataFrame({"i": i, "y": y, "k": range(len(own)), "w": own})

    pieces = sample.select("i", "y", "t").mapInPandas(cut, "i string, y int, k long, w binary")
    pieces = cut_lineage(pieces.select("y", "w", F.xxhash64("i", "k", "w").alias("at")))  # the draw rests on the document and the place, not on tasks
    amount = {r["y"]: r["n"] for r in pieces.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not amount.get(0) or not amount.get(1):
        return Classifier(None, None, base)
    chosen: dict[int, list[bytes]] = {}
    for y in (0, 1):
        part = F.pmod(F.col("at"), F.lit(1_000_000)) / 1e6 < TRAIN_WINDOWS / amount[y]
        chosen[y] = sorted(bytes(r["w"]) for r in pieces.where((F.col("y") == y) & part).select("w").collect())
    rng = np.random.default_rng(0)
    order = {y: [chosen[y][k] for k in rng.permutation(len(chosen[y]))] for y in chosen}
    distance = Distance(trained(order[0]), trained(order[1] * (1 + TRAIN_WINDOWS // max(1, 2 * len(order[1])))))
    shared = spark.sparkContext.broadcast(distance)

    @F.pandas_udf("array<double>")
    def features(t: pd.Series) -> pd.Series:
        return pd.Series([shared.value.features(x) for x in t])

    rows = sample.select("i", "y", features("t").alias("x")).collect()
    rows.sort(key=lambda r: (r["i"], r["y"], r["x"]))  # sums in one order, whatever the tasks
    return Classifier(distance, logistic(np.array([r["x"] for r in rows]), np.array([float(r["y"]) for r in rows])), base)


def score_toxicity(docs: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """Add ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def judge(t: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(t.tolist()))

    return docs.withColumn("score", judge(F.col(text_col))).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op6_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; learned without the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out("doc_id", 5, 0))
    labels = table(spark, sf_dir, "labels").where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    labelled = docs.where(~F.col("held_out")).join(labels, "doc_id").select(F.col("doc_id").alias("i"), F.col("text").alias("t"), "y")
    return score_toxicity(docs, fit(labelled)).select("doc_id", "held_out", "score", "predicted")


QUERIES = {"op6_compression_toxicity": op6_compression_toxicity}
ORACLES: dict[str, str] = {}
