"""Queries that split, train, score and relabel. Models have no SQL; the splits and sums around them do."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from threadline import dims
from threadline.functions.text import category_or_fallback
from threadline.operators import learn
from threadline.operators.features import checkpoint_folder
from threadline.plans.export_queries import _roles as exports_roles
from threadline.plans.export_queries import parsed
from threadline.plans.frames import read
from threadline.plans.staged import chat_stages, run_stages


def _rows(s, d):
    """Labelled documents, the group being the source; dealt by id, as a small table may be one file and its texts are cut up several times."""
    docs = read(s, d, "documents").where("source is not null").select("doc_id", "text", "source")
    tasks = int(s.conf.get("spark.sql.shuffle.partitions"))
    return docs.repartition(tasks, "doc_id").join(read(s, d, "labels").select("doc_id", F.col("quality").cast("string").alias("label")), "doc_id")


def _split(s, d):
    return learn.group_split(_rows(s, d), "source")


def _scores(s, d):
    """All models fitted on the training side, measured on the test side."""
    rows = learn.filled(_split(s, d), "text")
    train_rows, test_rows = (rows.where(F.col("split") == x).drop("split") for x in ("train", "test"))
    return learn.train_and_evaluate(train_rows, test_rows, "label", learn.models())


def _active(s, d):
    """Status counts of a round of active learning with the rule labeller as the model that is asked."""
    rows = _rows(s, d)
    model = learn.train(learn.filled(rows, "text"), "label", learn.models()["complement_bayes"])
    asked = lambda few: few.select("doc_id", F.when(category_or_fallback(F.col("text"), dims.TAXONOMY) == "PLACE", "1").otherwise("0").alias("new_label"))
    previous = read(s, d, "labels").select("doc_id", F.col("toxic").cast("string").alias("previous_label"))
    return learn.active_learning(rows, "doc_id", "label", model, asked, previous).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def _staged(s, d):
    """The whole run on exports of the events, each stage a table: the summary of its full master."""
    folder = f"{checkpoint_folder(s)}/run-{uuid.uuid4().hex}"
    messages = exports_roles(parsed(s, d))
    return run_stages(s, folder, chat_stages(), {"messages": messages})["summary"]


QUERIES = {
    "staged_run": lambda s, d: _staged(s, d),
    "split_summary": lambda s, d: learn.split_summary(_split(s, d), "label"),
    "split_leaks": lambda s, d: learn.leaking_groups(_split(s, d), "source").unionByName(learn.shared_groups(*(_split(s, d).where(F.col("split") == x) for x in ("train", "test")), "source").select("source", F.lit(2).cast("long").alias("sides"))),
    "split_classes": lambda s, d: learn.class_union(*(_split(s, d).where(F.col("split") == x) for x in ("train", "test")), "label"),
    "class_weights": lambda s, d: learn.balanced_weights(_rows(s, d), "label").groupBy("label", "weight").agg(F.count(F.lit(1)).alias("n")),
    "model_scores": lambda s, d: _scores(s, d),
    "active_learning": lambda s, d: _active(s, d),
}
_SPLIT = "WITH x AS (SELECT d.doc_id, d.source, l.quality::VARCHAR AS label, CASE WHEN ('0x' || substr(md5(d.source), 1, 8))::BIGINT % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM documents d JOIN labels l USING (doc_id) WHERE d.source IS NOT NULL)"
ORACLES = {
    "split_summary": f"{_SPLIT} SELECT label, count(*) AS total, count(*) FILTER (WHERE split = 'train') AS train, count(*) FILTER (WHERE split = 'test') AS test FROM x GROUP BY 1",
    "split_leaks": f"{_SPLIT} SELECT source, count(DISTINCT split) AS sides FROM x GROUP BY 1 HAVING count(DISTINCT split) > 1",
    "split_classes": f"{_SPLIT} SELECT DISTINCT label FROM x",
    "class_weights": f"{_SPLIT}, c AS (SELECT label, count(*) AS n FROM x GROUP BY 1) SELECT label, (SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n) AS weight, n FROM c",
}
