"""Mixing sources to target weights by hash-threshold histograms. DataFrame functions only.

Every document has a hash value of 36 bits that depends on its id alone. Per source a target number
of words is set; a source takes whole rounds of all its documents, and for the rest those whose hash
lies below a threshold. The threshold is found by nested histograms: words by (source, upper 12
bits), the bucket in which the budget ends, then only that bucket by its next 12 bits, and again.
No document is sorted, and a histogram has at most 4,096 rows a source.

Cases: a null text has size 0; a null source is a source of its own, last in the order; documents
with equal ids share their fate; a source without words has target 0 and takes nothing; an empty
table gives an empty result. Extra columns are not looked at; clashing names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, columns, cut_lineage, table

LEVEL_BITS = 12
LEVELS = 3
#: Weights by position of the source in code-point order, repeating.
CYCLE = 3
#: A source gives at most so many times its size.
REPEATS = 3
#: Sources up to this number are a table small enough to broadcast (some hundred bytes a row).
BROADCAST_SOURCES = 20_000


def word_count(text: str) -> Column:
    """Number of runs without ASCII white space, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def hash_value(name: str) -> Column:
    """36 bits of the MD5 digest of a value's text form."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")), 1, 9), 16, 10).cast("long")


def source_targets(sized: DataFrame) -> DataFrame:
    """Target words per source from (source, size) rows; the frame has a row a source.

    Shares follow weights until a source would exceed ``REPEATS`` times its size; such sources stop
    there and the others share the excess by weight. With sources in order of capacity per unit of
    weight this is one running sum: the first position at which the level fits decides.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = sources.withColumn("weight", (F.row_number().over(order) - 1) % CYCLE + 1)
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sources = (
        sources.withColumn("_capped", F.coalesce(F.sum("source_size").over(earlier), F.lit(0)) * REPEATS)
        .withColumn("_light", F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
        .withColumn("_all", F.sum("source_size").over(everything))
        .withColumn("_weights", F.sum("weight").over(everything))
        .withColumn("_level", (F.col("_all") - F.col("_capped")).cast("double") / (F.col("_weights") - F.col("_light")))
        .withColumn("_fits", F.col("_level") * F.col("weight") <= F.col("source_size") * REPEATS)
        .withColumn("_place", F.row_number().over(fill))
        .withColumn("_stop", F.min(F.when(F.col("_fits"), F.col("_place"))).over(everything))
        .withColumn("_final", F.min(F.when(F.col("_place") == F.col("_stop"), F.col("_level"))).over(everything))
    )
    target = F.when(F.col("_place") < F.coalesce(F.col("_stop"), F.lit(2**31)), (F.col("source_size") * REPEATS).cast("double")).otherwise(F.col("_final") * F.col("weight"))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    return (
        sources.select("source", "source_size", "weight", target.alias("target"))
        .withColumn("rounds", rounds)
        .withColumn("rest", F.col("target") - (F.col("rounds") * F.col("source_size")).cast("double"))
    )


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source the hash below which documents are taken once more, found by nested histograms."""
    open_ = targets.select(F.col("source").alias("_s"), F.lit(0).cast("long").alias("_prefix"), F.col("rest").alias("_budget"))
    rows = sized.select("source", "size", "hash")
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        if level:  # only the boundary bucket of each source goes on
            rows = by_source(rows, open_, rows.source.eqNullSafe(open_._s) & (F.expr(f"shiftright(hash, {shift + LEVEL_BITS})") == F.col("_prefix")), "left_semi")
        histogram = rows.groupBy("source", F.expr(f"shiftright(hash, {shift})").alias("_bucket")).agg(F.sum("size").alias("_words"))
        running = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        histogram = histogram.withColumn("_before", F.coalesce(F.sum("_words").over(running), F.lit(0)))
        joined = open_.join(histogram, open_._s.eqNullSafe(histogram.source))
        # the last bucket that starts within the budget; documents below it are all taken
        ends = joined.where((F.col("_before") < F.col("_budget")) & (F.col("_words") > 0)).groupBy(F.col("_s").alias("_t")).agg(
            F.max(F.struct("_bucket", "_before", "_words")).alias("_end")
        )
        open_ = open_.join(ends, open_._s.eqNullSafe(ends._t), "left").select(
            "_s", F.coalesce(F.col("_end._bucket"), F.lit(-1)).alias("_prefix"),
            (F.col("_budget") - F.coalesce(F.col("_end._before"), F.lit(0))).alias("_budget"), F.col("_end._words").alias("_words"),
        )
        if level < LEVELS - 1:
            open_ = cut_lineage(open_.drop("_words"))
    # the last bucket is one hash value: take it when that comes closer to the target
    keep = F.when(F.col("_words") - F.col("_budget") <= F.col("_budget"), F.col("_prefix") + 1).otherwise(F.col("_prefix"))
    return open_.select("_s", F.when(F.col("_prefix") < 0, F.lit(0)).otherwise(keep).alias("below"))


def by_source(rows: DataFrame, few: DataFrame, condition: Column, how: str = "inner") -> DataFrame:
    """Join with a frame of a row a source; it is broadcast if it has no more than ``BROADCAST_SOURCES`` rows, so no source's rows meet in one task."""
    small = few.count() <= BROADCAST_SOURCES
    return rows.join(F.broadcast(few) if small else few, condition, how)


def source_plan(sized: DataFrame) -> DataFrame:
    """Per source (``plan_source``): its size, target, rounds and threshold (``below``), from (source, size, hash) rows."""
    targets = cut_lineage(source_targets(sized))
    below = thresholds(sized, targets)
    plan = targets.join(below, targets.source.eqNullSafe(below._s), "left").select(
        F.col("source").alias("plan_source"), "source_size", "target", "rounds", F.coalesce(F.col("below"), F.lit(0)).alias("below")
    )
    return cut_lineage(plan)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents packed in ``row``, with ``source``, ``size`` and ``hash``, and the plan by source."""
    sized = docs.select(F.struct(*columns(docs)).alias("row"), F.col("source").alias("source"), word_count(text_col).alias("size"), hash_value(id_col).alias("hash"))
    return sized, source_plan(cut_lineage(sized.select("source", "size", "hash")))


def taken_copies(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """The documents with ``size``, ``hash``, ``source_size``, ``target`` and ``copies`` (times the mix takes each)."""
    out = by_source(sized, plan, F.col("source").eqNullSafe(F.col("plan_source")))
    copies = F.col("rounds") + F.when(F.col("hash") < F.col("below"), 1).otherwise(0)
    added = ("size", "hash", "source_size", "target")
    kept = [F.col("row").getField(c).alias(c) for c in sized.schema["row"].dataType.names if c not in (*added, "copies")]
    return out.select(*kept, *added, copies.alias("copies"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    sized = cut_lineage(docs.select("doc_id", "source", word_count("text").alias("size"), hash_value("doc_id").alias("hash")))
    out = taken_copies(sized.select(F.struct("doc_id").alias("row"), "source", "size", "hash"), source_plan(sized))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it."""
    sized, plan = mix(docs.select(*DOCUMENT_COLUMNS))
    out = taken_copies(sized, plan).where(F.col("copies") > 0)
    return out.select(*DOCUMENT_COLUMNS, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select(*DOCUMENT_COLUMNS)


OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         CAST('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 9) AS BIGINT) AS h
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sources
), filled AS (
  SELECT *, 3 * coalesce(sum(source_size) OVER w, 0) AS capped, coalesce(sum(weight) OVER w, 0) AS light,
         sum(source_size) OVER () AS everything, sum(weight) OVER () AS weights,
         row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS place
  FROM weighed WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, (everything - capped)::DOUBLE / (weights - light)::DOUBLE AS level FROM filled
), stops AS (
  SELECT min(place) AS stop FROM levels WHERE level * weight <= 3 * source_size
), final AS (
  SELECT level FROM levels, stops WHERE place = stop
), targets AS (
  SELECT source, source_size, CASE WHEN place < coalesce((SELECT stop FROM stops), 2147483648) THEN (3 * source_size)::DOUBLE ELSE (SELECT level FROM final) * weight END AS target FROM levels
), planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS rounds FROM targets
), groups AS (
  SELECT s.source, s.h, sum(s.size)::BIGINT AS words FROM sized s GROUP BY ALL
), running AS (
  SELECT g.source, g.h, g.words, p.target - (p.rounds * p.source_size)::DOUBLE AS rest,
         sum(g.words) OVER (PARTITION BY g.source ORDER BY g.h) AS after
  FROM groups g JOIN planned p ON g.source IS NOT DISTINCT FROM p.source
), chosen AS (
  SELECT source, max(h) + 1 AS below FROM running
  WHERE words > 0 AND rest > after - words AND (after - rest) <= (rest - (after - words)) OR (words > 0 AND after <= rest)
  GROUP BY source
)
SELECT s.doc_id, s.size, p.source_size, p.target,
       (s.size * (p.rounds + CASE WHEN s.h < coalesce(c.below, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
LEFT JOIN chosen c ON s.source IS NOT DISTINCT FROM c.source
"""

QUERIES = {"op9_source_mix": op9_source_mix}
ORACLES = {"op9_source_mix": OP9_SQL}
