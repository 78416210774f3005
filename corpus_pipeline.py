"""A training corpus from raw documents, in five stages.

Each stage is a function of (spark, docs, sf_dir) that works on all its predecessor kept. ``run`` writes every
stage as Parquet to the shared folder and reads it again for the next.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from threadline.llm.common import shared_folder, table
from threadline.llm.decontaminate import decontaminate_stage
from threadline.llm.language import language_stage
from threadline.llm.mixing import mix_stage
from threadline.llm.near_dedup import near_dedup_stage
from threadline.llm.sharding import shard_stage

STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontaminate_stage),
    ("source_mix", mix_stage),
    ("sharding", shard_stage),
]

#: Language profiles, signatures and checksums have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a data folder."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
