"""A linear classifier by stochastic gradient descent: hinge loss, one against the rest, balanced classes.

Rows are packed once into blocks (matrices of features), spread over tasks. A step draws a part of the rows by a hash of row and
epoch, each block adds up its gradient, and the sums are added in two levels, so what comes to the driver is a few matrices of
the size of the model. The draw does not follow tasks, so the weights are the same however rows are spread (but for rounding).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadline.operators.features import materialised

BLOCK_ROWS = 4096
RATE = 10.0


def _blocks(data: DataFrame) -> DataFrame:
    """(task, x, y, w, h) of (x array, y, w, h) rows: matrices as bytes, at most ``BLOCK_ROWS`` rows each."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s in range(0, len(batch), BLOCK_ROWS):
                part = batch.iloc[s : s + BLOCK_ROWS]
                yield pd.DataFrame({"x": [np.stack(part["x"].to_numpy()).astype(np.float64).tobytes()], **{c: [part[c].to_numpy(t).tobytes()] for c, t in (("y", np.int64), ("w", np.float64), ("h", np.int64))}})

    return materialised(data.mapInPandas(pack, "x binary, y binary, w binary, h binary"))


def drawn(hashes: np.ndarray, epoch: int, step: int, steps: int) -> np.ndarray:
    """Which rows belong to a step of an epoch: every row to one step, to another in other epochs."""
    with np.errstate(over="ignore"):
        mixed = (hashes.astype(np.uint64) ^ np.uint64(epoch * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        return (mixed >> np.uint64(33)) % np.uint64(steps) == np.uint64(step)


def gradient(x: np.ndarray, y: np.ndarray, w: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Sum over rows of the gradient of the weighted hinge loss, a row a class, the intercept last; and the sum of weights."""
    sign = np.where(y[:, None] == np.arange(len(model)), 1.0, -1.0)
    inside = sign * (x @ model[:, :-1].T + model[:, -1]) < 1
    pull = -(inside * sign * w[:, None])
    return np.hstack([pull.T @ x, pull.sum(axis=0)[:, None]])


class SgdClassifier(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol, DefaultParamsReadable, DefaultParamsWritable):
    """Fits ``SgdModel``. Step t has the rate ``RATE`` / (1 + t / 10); an epoch is ``steps`` steps; it ends when the loss no longer falls."""

    alpha = Param(Params._dummy(), "alpha", "weight of the squared norm", TypeConverters.toFloat)
    epochs = Param(Params._dummy(), "epochs", "most epochs", TypeConverters.toInt)
    steps = Param(Params._dummy(), "steps", "steps an epoch", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "least fall of the loss in an epoch", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "_label", weightCol: str | None = None, alpha: float = 1e-3, epochs: int = 12, steps: int = 4, tol: float = 1e-3) -> None:  # noqa: N803
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="_label", alpha=1e-3, epochs=12, steps=4, tol=1e-3)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> SgdModel:
        spark = dataset.sparkSession
        weight = F.col(self.getWeightCol()) if self.isSet(self.weightCol) else F.lit(1.0)
        data = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("long").alias("y"), weight.cast("double").alias("w"))
        data = data.withColumn("h", F.xxhash64("x", "y"))
        blocks = _blocks(data)
        size = data.agg(F.max("y").alias("y"), F.max(F.size("x")).alias("d"), F.sum("w").alias("w")).first()
        classes, width = int(size["y"] or 0) + 1, int(size["d"] or 0)
        model = np.zeros((classes, width + 1))
        if not width:
            return self._copyValues(SgdModel(weights=[0.0] * classes, classes=classes))
        alpha, steps = self.getOrDefault(self.alpha), self.getOrDefault(self.steps)

        def sums(epoch: int, step: int) -> tuple[np.ndarray, float, float]:
            """Gradient, weight and loss of a step's rows at the present weights."""
            held = spark.sparkContext.broadcast(model)

            def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                total, amount, loss, k = np.zeros_like(held.value), 0.0, 0.0, 0
                for batch in batches:
                    for x, y, w, h in zip(batch["x"], batch["y"], batch["w"], batch["h"], strict=True):
                        some = drawn(np.frombuffer(h, np.int64), epoch, step, steps)
                        if some.any():
                            y, w = np.frombuffer(y, np.int64)[some], np.frombuffer(w)[some]
                            x = np.frombuffer(x).reshape(len(some), width)[some]
                            total += gradient(x, y, w, held.value)
                            sign = np.where(y[:, None] == np.arange(classes), 1.0, -1.0)
                            loss += float((w[:, None] * np.maximum(0, 1 - sign * (x @ held.value[:, :-1].T + held.value[:, -1]))).sum())
                            amount += float(w.sum())
                            k += 1
                if k:
                    yield pd.DataFrame({"g": [total.tobytes()], "n": [amount], "l": [loss]})

            def added(rows: pd.DataFrame) -> pd.DataFrame:
                return pd.DataFrame({"g": [np.sum([np.frombuffer(g) for g in rows["g"]], axis=0).tobytes()], "n": [rows["n"].sum()], "l": [rows["l"].sum()]})

            parts = blocks.mapInPandas(own, "g binary, n double, l double")
            n = blocks.rdd.getNumPartitions()
            if n > 64:  # first within groups of tasks
                parts = parts.withColumn("k", F.pmod(F.spark_partition_id(), F.lit(int(n**0.5)))).groupBy("k").applyInPandas(added, "g binary, n double, l double")
            found = parts.collect()  # a few rows of the size of the model
            held.unpersist()
            grad = np.sum([np.frombuffer(r["g"]).reshape(model.shape) for r in found], axis=0) if found else np.zeros_like(model)
            return grad, sum(r["n"] for r in found), sum(r["l"] for r in found)

        t, best = 0, np.inf
        for epoch in range(self.getOrDefault(self.epochs)):
            loss = amount = 0.0
            for step in range(steps):
                grad, n, own_loss = sums(epoch, step)
                if not n:
                    continue
                penalty = alpha * model
                penalty[:, -1] = 0
                model = model - RATE / (1 + t / 10) * (grad / n + penalty)
                loss, amount, t = loss + own_loss, amount + n, t + 1
            mean = loss / max(amount, 1e-300)
            if mean > best - self.getOrDefault(self.tol):
                break
            best = min(best, mean)
        return self._copyValues(SgdModel(weights=model.ravel().tolist(), classes=classes))


class SgdModel(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``rawPrediction`` (a margin a class) and ``prediction``."""

    weights = Param(Params._dummy(), "weights", "a row a class, the intercept last", TypeConverters.toListFloat)
    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, weights: list[float] | None = None, classes: int = 1) -> None:
        super().__init__()
        self._setDefault(featuresCol="features")
        if weights is not None:
            self._set(weights=weights, classes=classes)

    def matrix(self) -> np.ndarray:
        """Weights, a row a class."""
        return np.array(self.getOrDefault(self.weights)).reshape(self.getOrDefault(self.classes), -1)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        model = self.matrix()

        @F.pandas_udf("array<double>")
        def margins(x: pd.Series) -> pd.Series:
            return pd.Series(list(np.stack(x.to_numpy()) @ model[:, :-1].T + model[:, -1])) if len(x) else x

        out = dataset.withColumn("rawPrediction", array_to_vector(margins(vector_to_array(self.getFeaturesCol()))))
        raw = vector_to_array("rawPrediction")
        return out.withColumn("prediction", (F.array_position(raw, F.array_max(raw)) - 1).cast("double"))
