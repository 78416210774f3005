"""A run in stages with a manifest: every stage is a table of its own, and a run that broke off goes on at the first stage that is missing.

The manifest of a stage says which inputs it was made of, its schema, its rows and where they lie. It is written after the rows, and
rows go to a new folder each time, so what a killed stage leaves is never read. A stage whose inputs were made anew is made anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadline import dims
from threadline.functions import text as T
from threadline.operators import distributions, learn, splits

MANIFEST = "stage string, id string, inputs string, columns string, rows long, folder string"


@dataclass(frozen=True)
class Stage:
    """A table by name, made of other stages or sources; ``settings`` are what else its rows rest on."""

    name: str
    needs: tuple[str, ...]
    build: Callable[..., DataFrame]
    settings: dict = field(default_factory=dict)


def read_manifest(spark: SparkSession, folder: str, name: str) -> dict | None:
    """The manifest of a finished stage."""
    try:
        found = spark.read.schema(MANIFEST).json(f"{folder}/{name}/manifest").first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found.asDict() if found else None


def run_stages(spark: SparkSession, folder: str, stages: list[Stage], sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All stages in order, by name; those that stand in the folder and rest on the same inputs are read, not made."""
    frames = dict(sources)
    ids = {name: json.dumps(frame.schema.jsonValue(), sort_keys=True) for name, frame in sources.items()}
    for stage in stages:
        inputs = json.dumps({"needs": {n: ids[n] for n in stage.needs}, "settings": stage.settings}, sort_keys=True)
        held = read_manifest(spark, folder, stage.name)
        if held is None or held["inputs"] != inputs:
            own = uuid.uuid4().hex
            rows = f"{folder}/{stage.name}/rows-{own}"
            stage.build(*[frames[n] for n in stage.needs]).write.parquet(rows)
            made = spark.read.parquet(rows)
            held = {"stage": stage.name, "id": own, "inputs": inputs, "columns": made.schema.simpleString(), "rows": made.count(), "folder": rows}
            spark.createDataFrame([held], MANIFEST).coalesce(1).write.mode("overwrite").json(f"{folder}/{stage.name}/manifest")
        frames[stage.name], ids[stage.name] = spark.read.parquet(held["folder"]), held["id"]
    return frames


def chat_stages(taxonomy: dims.Taxonomy = dims.TAXONOMY, hours: float = 4.0, models: tuple[str, ...] = ("complement_bayes", "multinomial_bayes")) -> list[Stage]:
    """From messages with roles to reports: master, texts, split, measured models, chosen model, predictions, full master, summaries."""
    words = (dims.SLANG, dims.GENERAL_WORDS, dims.PROTECTED)

    def master(messages: DataFrame) -> DataFrame:
        patterns = T.word_pattern(dims.REMOTE_WORDS), T.credential_pattern(dims.CREDENTIAL_WORDS), T.word_pattern(dims.CLOSING_WORDS), T.word_pattern(dims.WAITING_WORDS)
        return distributions.full_master(messages, taxonomy, *patterns, hours)

    def texts(units: DataFrame) -> DataFrame:
        rows = units.select("sub_id", "source_file", F.col("category").alias("label"), F.col("transcript").alias("text"))
        return learn.filled(learn.prepared(rows, "text", *words), "text")

    def measured(dealt: DataFrame) -> DataFrame:
        sides = [dealt.where(c).select("sub_id", "label", "text") for c in ("fold <> 0", "fold = 0")]
        return learn.train_and_evaluate(*sides, "label", {m: learn.models()[m] for m in models})

    def predicted(dealt: DataFrame, best: DataFrame) -> DataFrame:
        model = learn.train(dealt.where("fold <> 0").select("sub_id", "label", "text"), "label", learn.models()[best.first()["model"]])
        return learn.predict(model, dealt.select("sub_id", "text", "label"), "label").select("sub_id", "predicted", (F.col("confidence") * 100).alias("confidence"), F.col("text").alias("normalised"))

    settings = {"categories": taxonomy.names(), "version": taxonomy.version, "hours": hours}
    return [
        Stage("master", ("messages",), master, settings), Stage("texts", ("master",), texts), Stage("split", ("texts",), lambda t: splits.group_folds(t, "source_file", "label")),
        Stage("models", ("split",), measured, {"models": models}), Stage("chosen", ("models",), lambda m: m.orderBy(F.desc("weighted_f1"), "model").limit(1)),
        Stage("predictions", ("split", "chosen"), predicted), Stage("full_master", ("master", "predictions"), lambda m, p: distributions.with_texts(distributions.with_prediction(m, p), p)),
        Stage("summary", ("full_master",), lambda m: distributions.executive_summary(m, "conversation_id", "category")), Stage("categories", ("full_master",), lambda m: distributions.category_report(m, "category")),
        Stage("match", ("full_master",), distributions.match_rate),
    ]
