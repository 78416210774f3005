"""Profiles of message tables: counts and shares, lengths, gaps, thresholds, sizes, near-equal names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chat import time_gaps

HOUR_US = 3_600_000_000


def counts_with_share(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Count and share in percent by some keys."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(1))))


def upper_median(rows: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Per key the value at rank n div 2 + 1. Ranks come from a histogram of values, so a task sees distinct values only."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys)
    counts = counts.withColumn("_to", F.sum("_n").over(w.orderBy(value))).withColumn("_all", F.sum("_n").over(w))
    return counts.where((F.col("_to") >= F.expr("_all div 2 + 1")) & (F.col("_to") - F.col("_n") < F.expr("_all div 2 + 1"))).select(*keys, F.col(value).alias("median"))


def length_profile(rows: DataFrame, text: str, key: str, edges: tuple[int, ...] = (10, 50, 100, 500, 2000)) -> DataFrame:
    """Mean, upper median, least and largest length per key, and counts in half-open buckets."""
    sized = rows.select(key, F.length(text).alias("len"))
    bounds = [0, *edges, None]
    buckets = [F.count_if((F.col("len") >= a) & (F.col("len") < b) if b else F.col("len") >= a).alias(f"from_{a}") for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return sized.groupBy(key).agg(F.avg("len").alias("mean_len"), F.min("len").alias("min_len"), F.max("len").alias("max_len"), *buckets).join(upper_median(sized, "len", [key]), key)


def gap_buckets(rows: DataFrame, keys: list[str], order: list[str], hours: tuple[float, ...] = (0.5, 1, 2, 4, 8, 24)) -> DataFrame:
    """Number of non-negative gaps by half-open buckets of hours."""
    gaps = time_gaps(rows, keys, order).where("gap_us >= 0")
    bounds = [0.0, *hours]
    bucket = F.lit(len(bounds) - 1)
    for i in range(len(bounds) - 2, -1, -1):
        bucket = F.when(F.col("gap_us") < int(bounds[i + 1] * HOUR_US), i).otherwise(bucket)
    return gaps.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.min("gap_us").alias("least"), F.max("gap_us").alias("largest"))


def rank_percentiles(values: DataFrame, value: str, percents: tuple[int, ...] = (50, 75, 90, 95, 99)) -> DataFrame:
    """Values at index int(n * p / 100) of the sorted values, clamped; ranks from a histogram of distinct values by range, so nothing is sorted in one task.

    The histogram has a coarse level of at most a few thousand cells, which fixes the first rank of each cell.
    """
    counts = values.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    coarse = counts.withColumn("cell", F.floor(F.col("v") / F.lit(HOUR_US // 60)))
    cells = coarse.groupBy("cell").agg(F.sum("n").alias("cell_n"))
    cells = cells.select("cell", (F.sum("cell_n").over(Window.partitionBy(F.lit(1)).orderBy("cell")) - F.col("cell_n")).alias("first"), F.sum("cell_n").over(Window.partitionBy(F.lit(1))).alias("all"))
    placed = coarse.join(cells, "cell").withColumn("to", F.col("first") + F.sum("n").over(Window.partitionBy("cell").orderBy("v")))
    wanted = F.explode(F.array(*[F.lit(p) for p in percents]))
    placed = placed.withColumn("percent", wanted).withColumn("index", F.least(F.expr("cast(all * percent as bigint) div 100"), F.col("all") - 1))
    return placed.where((F.col("to") > F.col("index")) & (F.col("to") - F.col("n") <= F.col("index"))).select("percent", F.col("v").alias("value"))


def threshold_simulation(rows: DataFrame, keys: list[str], order: list[str], hours: tuple[int, ...] = (1, 2, 3, 4, 6, 8, 12, 24)) -> DataFrame:
    """Sessions and mean size that each threshold would give, in one pass."""
    gaps = time_gaps(rows, keys, order)
    source = F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys])
    one = gaps.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(source).alias("sources"), *[F.count_if(F.col("gap_us") >= h * HOUR_US).alias(f"h{h}") for h in hours])
    pairs = ", ".join(f"{h}, h{h}" for h in hours)
    out = one.select("rows", "sources", F.expr(f"stack({len(hours)}, {pairs}) as (hours, cuts)"))
    return out.select("hours", (F.col("sources") + F.col("cuts")).alias("sessions"), (F.col("rows") * 1.0 / (F.col("sources") + F.col("cuts"))).alias("mean_rows"))


def similar_names(names: DataFrame, column: str, least: int = 3) -> DataFrame:
    """Pairs (short, long) of distinct names, lower-cased and trimmed, of which one stands in the other.

    Every piece of a name that is as long as some name is met with the names themselves, so only true pairs meet and leading letters
    that all names share gather nothing. The lengths in use are at most those up to the longest name, a few rows. Pieces made: the
    letters of the names times the lengths in use.
    """
    distinct = names.select(F.lower(F.trim(column)).alias("name")).where(F.length("name") >= least).distinct()
    lengths = distinct.select(F.length("name").alias("n")).distinct()
    pieces = distinct.join(F.broadcast(lengths), F.length("name") > F.col("n")).select(F.col("name").alias("long"), F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("name") - F.col("n") + 1), lambda i: F.substr(F.col("name"), i, F.col("n"))))).alias("short"))
    return pieces.join(distinct.select(F.col("name").alias("short")), "short").select("short", "long")


def alike_senders(messages: DataFrame, sender: str = "sender", left_out: tuple[str, ...] = ("SYSTEM",)) -> DataFrame:
    """Senders that may be one: (first, second, kind), system senders left out.

    ``contains``: the lower-cased, trimmed first name stands in the second, each by its first spelling. ``spelling``: the second is
    another spelling of the first; every further spelling is met with the first one only, so no pairs within a group are made. Null
    and blank senders take no part.
    """
    spelt = messages.where(F.trim(sender) != "").where(~F.col(sender).isin(*left_out)).select(F.col(sender).alias("spelling"), F.lower(F.trim(sender)).alias("name")).distinct()
    first = spelt.groupBy("name").agg(F.min("spelling").alias("first"))
    other = spelt.join(first, "name").where("spelling <> first").select("first", F.col("spelling").alias("second"), F.lit("spelling").alias("kind"))
    pairs = similar_names(first, "name", 1)
    named = pairs.join(first.select(F.col("name").alias("short"), "first"), "short").join(first.select(F.col("name").alias("long"), F.col("first").alias("second")), "long")
    return other.unionByName(named.select("first", "second", F.lit("contains").alias("kind")))
