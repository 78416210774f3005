"""Hilbert-curve sharding: quantise metadata, sort by curve index, cut the order into runs.

Three dimensions (source, language, size) are quantised to 16 cells each; the commonest sources and languages
have cells of their own. Documents close on the curve share cells in most dimensions, so each shard covers few
cells per dimension and a reader that filters on any of them can skip most shards.

No task sorts the whole table: a histogram over (curve cell, hash prefix) gives every small group
its first global rank, and only ranks inside such a group come from a window. The number of hash
prefixes follows the row count, so a cell that holds a third of all rows is still split.

Cases: null source, language or text count as empty; equal ids are ordered by text checksum and
size, and equal rows are interchangeable; an empty table gives an empty result; extra columns
pass through, and columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, table, utf8_bytes

BITS = 4
DIMENSIONS = 3
#: Rows that one (cell, hash prefix) group should hold at most, on average over a full cell.
GROUP_ROWS = 50_000


def curve_index(point: list[int], bits: int) -> int:
    """Position of a lattice point on the Hilbert curve (transpose form, any number of axes)."""
    axes = list(point)
    n = len(axes)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(n):
            if axes[i] & bit:
                axes[0] ^= low
            else:
                swap = (axes[0] ^ axes[i]) & low
                axes[0] ^= swap
                axes[i] ^= swap
        bit >>= 1
    for i in range(1, n):
        axes[i] ^= axes[i - 1]
    flip = 0
    bit = 1 << (bits - 1)
    while bit > 1:
        if axes[n - 1] & bit:
            flip ^= bit - 1
        bit >>= 1
    axes = [a ^ flip for a in axes]
    index = 0
    for b in range(bits - 1, -1, -1):
        for a in axes:
            index = index << 1 | (a >> b) & 1
    return index


def curve_table(bits: int = BITS) -> list[int]:
    """Curve index of every lattice cell, in row-major order of the three axes."""
    side = 1 << bits
    return [curve_index([x, y, z], bits) for x in range(side) for y in range(side) for z in range(side)]


def value_cells(docs: DataFrame, name: str, side: int) -> Column:
    """Cell of a categorical value: each of the ``side`` / 2 commonest values (ties by value, null as the empty text) has its own; the others share the rest by checksum.

    The commonest are a bounded list in the plan, so no value has to be looked up by a join.
    """
    value = F.coalesce(F.col(name).cast("string"), F.lit(""))
    top = docs.groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "v").limit(side // 2).collect()
    cell = side // 2 + F.crc32(value) % (side - side // 2)
    for k, r in enumerate(top):
        cell = F.when(value == r["v"], k).otherwise(cell)
    return cell.cast("int")


def size_cell(size: Column, side: int) -> Column:
    """Cell of a size: its power of two above 16, the last cell open."""
    return F.least(F.lit(side - 1), F.length(F.bin(size)) - 5).cast("int")


def shard_by_curve(docs: DataFrame, n_shards: int, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add ``size``, ``text_crc32``, ``source_cell``, ``lang_cell``, ``size_cell``, ``curve``, ``shard`` and ``slot``.

    Shard row counts differ by at most one; slots run from 0 without gaps in each shard.
    """
    side = 1 << bits
    rows = docs.count()
    groups = 1
    while groups * GROUP_ROWS < rows:
        groups *= 2
    lattice = F.split(F.lit(" ".join(map(str, curve_table(bits)))), " ")
    placed = (
        docs.withColumn("size", utf8_bytes(text_col) + 16)
        .withColumn("text_crc32", F.crc32(F.coalesce(F.col(text_col), F.lit(""))))
        .withColumn("source_cell", value_cells(docs, "source", side))
        .withColumn("lang_cell", value_cells(docs, "lang", side))
        .withColumn("size_cell", size_cell(F.col("size"), side))
        .withColumn("curve", F.element_at(lattice, (F.col("source_cell") * side + F.col("lang_cell")) * side + F.col("size_cell") + 1).cast("int"))
        .withColumn("_tie", F.coalesce(F.crc32(F.col(id_col).cast("string")), F.col("text_crc32")))  # null ids spread by their text
        .withColumn("_group", F.pmod(F.col("_tie"), F.lit(groups)).cast("int"))
    )
    # Both windows below see a histogram of bounded size: cells of the lattice, groups of a cell.
    counts = placed.groupBy("curve", "_group").agg(F.count(F.lit(1)).alias("_n"))
    cells = counts.groupBy("curve").agg(F.sum("_n").alias("_cell_n"))
    before = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("curve", F.coalesce(F.sum("_cell_n").over(before), F.lit(0)).alias("_cell_first"))
    inside = Window.partitionBy("curve").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.withColumn("_group_first", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(cells, "curve")
    firsts = firsts.select(F.col("curve").alias("_c"), F.col("_group").alias("_g"), (F.col("_cell_first") + F.col("_group_first")).alias("_first"))
    order = Window.partitionBy("curve", "_group").orderBy("_tie", F.col(id_col).asc_nulls_first(), "text_crc32", "size")
    ranked = placed.withColumn("_rank", F.row_number().over(order) - 1).join(firsts, (F.col("curve") == F.col("_c")) & (F.col("_group") == F.col("_g")))
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_first"))
    ranked = ranked.withColumn("shard", F.expr(f"cast((_rank * {n_shards}) div {max(rows, 1)} as int)"))
    # first rank of shard s is ceil(s * rows / n_shards)
    ranked = ranked.withColumn("slot", F.expr(f"_rank - (cast(shard as bigint) * {rows} + {n_shards - 1}) div {n_shards}"))
    return ranked.drop("_tie", "_group", "_rank", "_c", "_g", "_first")


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards along the curve; only narrow columns are shuffled."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = shard_by_curve(docs, 40)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "curve", "source_cell", "lang_cell", "size_cell",
    )


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents with their shard and slot."""
    return shard_by_curve(docs.select(*DOCUMENT_COLUMNS), 40).select(*DOCUMENT_COLUMNS, "shard", "slot", "curve")


QUERIES = {"op3_hilbert_shards": op3_hilbert_shards}
ORACLES: dict[str, str] = {}
