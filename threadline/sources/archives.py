"""Checks of uploaded archives: one row a member, listed inside tasks; the rules are filters and groupings."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BYTES = 100 * 1024 * 1024
MAX_UNPACKED = 500 * 1024 * 1024


def safe_member(name: Column) -> Column:
    """Whether a member stays inside the folder it is unpacked to: no absolute path, drive or parent step."""
    plain = F.replace(name, F.lit("\\"), F.lit("/"))
    return (F.coalesce(name, F.lit("")) == "") | ~(plain.startswith("/") | plain.contains(":") | plain.rlike(r"(^|/)\.\.(/|$)"))


def list_members(files: DataFrame) -> DataFrame:
    """(path, length, member, member_bytes) of (path, length, content) rows; a file that is no archive has one row with a null member."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, length, content in zip(batch["path"], batch["length"], batch["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        members = [(m.filename, m.file_size) for m in archive.infolist()]
                except zipfile.BadZipFile:
                    members = [(None, -1)]
                yield pd.DataFrame([(path, length, n, s) for n, s in members], columns=["path", "length", "member", "member_bytes"])

    return files.select("path", "length", "content").mapInPandas(run, "path string, length long, member string, member_bytes long")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Members of all archives of a folder."""
    return list_members(spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder))


def judge_archives(members: DataFrame, max_bytes: int = MAX_BYTES, max_unpacked: int = MAX_UNPACKED) -> DataFrame:
    """(path, members, unpacked, verdict) per archive: ok, too_large, not_an_archive, unsafe_member, unpacks_too_large or no_text_file, in this order."""
    out = members.groupBy("path").agg(
        F.max("length").alias("length"), F.count("member").alias("members"), F.coalesce(F.sum(F.when(F.col("member").isNotNull(), F.col("member_bytes"))), F.lit(0)).alias("unpacked"),
        F.count_if(F.col("member").isNotNull() & ~safe_member(F.col("member"))).alias("unsafe"), F.count_if(F.lower("member").endswith(".txt")).alias("texts"),
    )
    verdict = F.when(F.col("length") > max_bytes, "too_large").when(F.col("members") == 0, "not_an_archive").when(F.col("unsafe") > 0, "unsafe_member")
    verdict = verdict.when(F.col("unpacked") > max_unpacked, "unpacks_too_large").when(F.col("texts") == 0, "no_text_file").otherwise("ok")
    return out.select("path", "members", "unpacked", verdict.alias("verdict"))
