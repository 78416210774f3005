"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share, as the session names it in ``spark.checkpoint.dir`` or ``setCheckpointDir``.

    Only where neither is set and all runs in one process (a test) is it a temporary folder; a cluster without a folder is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a frame to the shared checkpoint folder and go on from the files."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def columns(df: DataFrame) -> list[Column]:
    """All columns of a frame, whatever signs their names have."""
    return [F.col("`{}`".format(c.replace("`", "``"))) for c in df.columns]


def in_tasks(df: DataFrame, rows: int, per_task: int) -> DataFrame:
    """The frame in no more tasks than its number of rows asks for: a small one does not go through all shuffle partitions."""
    return df.coalesce(max(1, -(-rows // per_task)))


def task_count(spark: SparkSession) -> int:
    """Number of shuffle partitions of the session; block and bucket counts follow it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8_bytes(text: str | Column) -> Column:
    """Length of a text in UTF-8 bytes, 0 for null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.octet_length(column), F.lit(0)).cast("long")
