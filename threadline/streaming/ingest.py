"""Incremental ingest: new files of a folder go once into a table of messages, however often the job is run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructType


def file_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The Parquet files of a path as a stream, with the schema that they have now."""
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def ingested(spark: SparkSession, sink: str, schema: StructType) -> DataFrame:
    """What has been ingested, with ``day`` and the number of the ``batch``; both are folders, so filters on them skip files."""
    return spark.read.schema(StructType([*schema.fields]).add("day", DateType()).add("batch", LongType())).parquet(sink)


def ingest(stream: DataFrame, sink: str, state: str, id_col: str = "event_id", time_col: str = "ts") -> None:
    """Add all that the stream has now and end. A message is its id and time; one that came before is left out, however late.

    Each batch writes a folder of its own, anew if it is repeated after a lost executor, and compares itself with
    earlier batches only, so a run that is broken off and started again neither loses nor doubles rows. The
    comparison reads the id and time of the days that the batch holds. No state is kept in memory.

    Cases: rows without id are all kept; a null time is a day of its own; columns ``day`` and ``batch`` are replaced.
    """
    clean = stream.drop("day", "batch")
    schema = clean.schema

    def add(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("day", F.to_date(time_col))
        named = rows.where(F.col(id_col).isNotNull()).dropDuplicates([id_col, time_col])
        if number:
            old = ingested(batch.sparkSession, sink, schema).where(F.col("batch") < number)
            old = old.select(F.col(id_col).alias("_id"), F.col(time_col).alias("_time"), F.col("day").alias("_day"))
            same = (named[id_col] == old._id) & named[time_col].eqNullSafe(old._time) & named.day.eqNullSafe(old._day)
            named = named.join(old, same, "left_anti")
        named.unionByName(rows.where(F.col(id_col).isNull())).write.mode("overwrite").partitionBy("day").parquet(f"{sink}/batch={number}")

    clean.writeStream.foreachBatch(add).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
