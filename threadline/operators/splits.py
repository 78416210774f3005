"""Folds: whole groups with the class shares of the whole, and single rows dealt evenly within their class."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadline.operators.features import checkpoint_folder

#: Groups that one task deals, about; the next task goes on from the sums of the folds.
GREEDY_GROUPS = 50_000
#: Rows of a class that one task ranks, about.
RANK_ROWS = 50_000


def key_hash(key: str) -> Column:
    """The first 32 bits of the MD5 digest of a key's text form, as a number."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long")


def group_histograms(rows: DataFrame, group: str, label: str) -> tuple[DataFrame, list]:
    """(group, counts) with the number of rows of each class in the order of the class names, and these names. Classes are a dimension."""
    kept = rows.where(F.col(group).isNotNull() & F.col(label).isNotNull())
    names = sorted(r[0] for r in kept.select(label).distinct().collect())
    counts = F.array(*[F.count_if(F.col(label) == n) for n in names]) if names else F.array().cast("array<bigint>")
    return kept.groupBy(group).agg(counts.alias("counts")), names


def greedy_folds(histograms: np.ndarray, folds: int, held: np.ndarray, total: np.ndarray) -> list[int]:
    """A fold for each histogram in turn: where it leaves the class shares of the folds closest together.

    The measure is the standard deviation over folds of a class's share in each, averaged over the classes; of equal ones (within
    rounding) the fold of fewest rows, then the first. ``held`` is what the folds have already.
    """
    held, chosen = held.astype(float), []
    one = np.eye(folds)[:, :, None]
    for h in histograms:
        spread = ((held[None] + one * h) / total).std(axis=1).mean(axis=1).tolist()
        sizes, best = held.sum(axis=1).tolist(), 0
        for k in range(1, folds):
            alike = abs(spread[k] - spread[best]) <= 1e-8 + 1e-5 * abs(spread[best])
            if sizes[k] < sizes[best] if alike else spread[k] < spread[best]:
                best = k
        held[best] += h
        chosen.append(best)
    return chosen


def group_folds(rows: DataFrame, group: str, label: str, folds: int = 5, greedy: int = GREEDY_GROUPS) -> DataFrame:
    """Add ``fold``: whole groups, each fold with about the class shares of the whole. Rows without group or label go.

    All groups are dealt one after the other, largest spread of the histogram first, ties by group. The histograms lie on disk in
    that order, cut into ranges of about ``greedy`` groups; a task deals a range and the next one goes on from the sums of the folds.
    So a task holds a range and the driver the sums, at any number of groups, and nothing but the order of the deal is serial.
    """
    histograms, names = group_histograms(rows, group, label)
    kept = rows.where(F.col(group).isNotNull() & F.col(label).isNotNull())
    if not names:
        return kept.withColumn("fold", F.lit(None).cast("int"))
    n = F.size("counts")
    squares = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x * x)
    plain = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    spark, folder = rows.sparkSession, f"{checkpoint_folder(rows.sparkSession)}/folds-{uuid.uuid4().hex}"
    histograms.withColumn("_spread", n * squares - plain * plain).write.parquet(f"{folder}/made")  # orders as the standard deviation does, in whole numbers
    made = spark.read.parquet(f"{folder}/made")
    sums = made.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("counts")[k]).alias(f"c{k}") for k in range(len(names))]).first()
    order = [F.desc("_spread"), F.col(group)]
    ranges = max(1, -(-sums["n"] // greedy))
    made.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()).write.partitionBy("_range").parquet(f"{folder}/ranges")
    ranked = spark.read.parquet(f"{folder}/ranges")
    held, total = np.zeros((folds, len(names))), np.array(sums[1:], float)
    shape = T.StructType([*ranked.select(group, "counts").schema.fields, T.StructField("_fold", T.IntegerType())])

    def deal(held: np.ndarray) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own = held.copy()
            for batch in batches:
                counts = np.array(batch["counts"].tolist(), float).reshape(-1, len(names))
                chosen = greedy_folds(counts, folds, own, total)
                np.add.at(own, chosen, counts)
                yield batch[[group, "counts"]].assign(_fold=chosen)

        return one

    for k in range(ranges):
        part = ranked.where(F.col("_range") == k).coalesce(1).sortWithinPartitions(*order).select(group, "counts")
        part.mapInPandas(deal(held), shape).write.parquet(f"{folder}/dealt/part={k}")
        own = spark.read.schema(shape).parquet(f"{folder}/dealt/part={k}").groupBy("_fold").agg(*[F.sum(F.col("counts")[i]) for i in range(len(names))]).collect()
        for r in own:
            held[r[0]] += np.array(r[1:], float)
    table = spark.read.schema(shape).parquet(*[f"{folder}/dealt/part={k}" for k in range(ranges)]).select(F.col(group).alias("_g"), F.col("_fold").alias("fold"))
    return kept.join(table, F.col(group) == F.col("_g")).drop("_g")


def stratified_folds(rows: DataFrame, key: str, label: str, folds: int = 5, salt: str = "") -> DataFrame:
    """Add ``fold``: the rows of each class dealt in turn in the order of a hash of the key, so their counts in two folds differ by one at most.

    A rank is the row's place in its range of hashes (a window of bounded size) plus the rows of the ranges before. Rows of equal keys
    are interchangeable; rows without a label are a class.
    """
    ranges = 1 << max(0, (-(-rows.count() // RANK_ROWS) - 1).bit_length())
    hashed = rows.withColumn("_salted", F.concat(F.lit(salt), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    hashed = hashed.withColumn("_hash", key_hash("_salted")).withColumn("_range", F.expr(f"_hash div {2**32 // ranges}"))
    counts = hashed.groupBy(label, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(label).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a class and range
    counts = counts.select(F.col(label).alias("_l"), F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(label, "_range").orderBy("_hash", key)) - 1
    ranked = hashed.withColumn("_place", place).join(counts, F.col(label).eqNullSafe(F.col("_l")) & (F.col("_range") == F.col("_r")))
    return ranked.withColumn("fold", F.pmod(F.col("_place") + F.col("_before"), F.lit(folds)).cast("int")).drop("_salted", "_hash", "_range", "_l", "_r", "_before", "_place")


def fold_shares(dealt: DataFrame, label: str) -> DataFrame:
    """Rows of each class and fold, with their share of the fold."""
    counts = dealt.groupBy("fold", label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("fold")))
