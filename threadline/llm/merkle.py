"""Merkle manifest of a dataset: per partition a tree of 8-ary runs over its leaves, a tree over the partitions, a proof per row.

Nested-struct rollup. Rows are ranked by partition and id; the octal digits of a rank say where its leaf stands. Inside a
block of 8^3 leaves the digits are grouped away one after the other (digit 0, then 1, then 2), each time nesting the child
structs in their parent, so a block ends as one row that holds its small tree. One ``transform`` and ``explode`` then emit
every leaf with its siblings, without a join. The roots of the blocks are ranked already, so they go through the same rollup,
block by block, until each partition has one node; the partitions' roots go through it once more. What a block learns from
above (its own path to the root) is one row a block.

A path is an array of (before, after), one entry a level that really is a level: the hex digests left and right of the node
in its run. Folding a digest with it gives the root; its digests in order are the proof.

Ranks need no window over a partition: rows are range-partitioned by (partition, id), the place in a task is a row number,
and the counts of the tasks give the offsets. A partition that holds most rows is so spread over many tasks.

Cases: null values hash as ``-``; a null partition is one, and comes first; null ids come first; equal ids go by their digest,
and equal rows are interchangeable, each having a leaf of its own; an empty text is no null; an empty table gives an empty result;
other columns than those named are not read, whatever their names. Only a row with an id is ever tampered with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut_lineage, table, task_count

FANOUT = 8
#: Levels that are nested in one row: a block has FANOUT ** LEVELS nodes.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha(value: Column) -> Column:
    """Lowercase hex SHA-256 of a string."""
    return F.sha2(value.cast("binary"), 256)


def field_form(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    """Digest of the fields of a row in their order."""
    return sha(F.concat(*[field_form(v) for v in values]))


def ranked(rows: DataFrame, group: str, order: list[Column]) -> tuple[DataFrame, int]:
    """Add ``rank`` (from 0 within the group, in the order) and ``n`` (rows of the group), and the largest n (0 without rows). The order is written once, as ranks rest on it."""
    spark = rows.sparkSession
    keys = [F.col(group).asc_nulls_first(), *order, F.col("_row").asc()]  # the last spreads copies of one row
    placed = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(task_count(spark), *keys).sortWithinPartitions(*keys)
    placed = cut_lineage(placed.drop("_row").withColumn("_at", F.monotonically_increasing_id()).withColumn("_task", F.shiftright("_at", 33)))
    parts = placed.groupBy(group, "_task").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_low"))  # a row a group and task
    own = Window.partitionBy(group)
    earlier = own.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col(group).alias("_g"), F.col("_task").alias("_t"), (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_low")).alias("_shift"), F.sum("_n").over(own).alias("n"))
    out = placed.join(parts, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_task") == F.col("_t")))
    return out.withColumn("rank", F.col("_at") + F.col("_shift")).drop("_at", "_task", "_g", "_t", "_shift"), parts.agg(F.max("n")).first()[0] or 0


def nest(nodes: DataFrame, group: str, payload: list[str]) -> DataFrame:
    """Blocks of nodes (group, rank, n, hash, payload): (group, block, n, hash, tree). Level k of the tree is an array of (at, hash, below)."""
    size = FANOUT**LEVELS
    parts = max(task_count(nodes.sparkSession), 1)
    rows = nodes.withColumn("block", F.expr(f"rank div {size}")).repartition(parts, group, "block")  # the groupings below need no other exchange
    digit = lambda k: F.pmod(F.expr(f"rank div {FANOUT**k}"), F.lit(FANOUT)).cast("int")
    rows = rows.select(group, "block", "n", *[digit(k).alias(f"d{k}") for k in range(LEVELS)], "hash", F.struct(*payload).alias("below"))
    for k in range(LEVELS):
        above = [f"d{j}" for j in range(k + 1, LEVELS)]
        run = F.array_sort(F.collect_list(F.struct(F.col(f"d{k}").alias("at"), "hash", "below")))
        rows = rows.groupBy(group, "block", "n", *above).agg(run.alias("below"))
        joined = F.array_join(F.transform("below", lambda x: x["hash"]), "")
        # a level is one only while several nodes remain
        rows = rows.withColumn("hash", F.when(F.col("n") > FANOUT**k, sha(joined)).otherwise(F.col("below")[0]["hash"]))
    return rows.withColumnRenamed("below", "tree")


def step(run: Column, at: Column, n: Column, level: int) -> Column:
    """Path entry of a node in its run, as an array: empty where the level is none."""
    side = lambda keep: F.array_join(F.transform(F.filter(run, keep), lambda x: x["hash"]), "")
    entry = F.struct(side(lambda x: x["at"] < at).alias("before"), side(lambda x: x["at"] > at).alias("after"))
    return F.when(n > FANOUT**level, F.array(entry)).otherwise(F.array().cast("array<struct<before:string,after:string>>"))


def unnest(blocks: DataFrame, keep: list[str]) -> DataFrame:
    """One row a node: ``hash``, the fields of ``below`` and ``path``, the node's path in its block followed by the block's own (column ``up``)."""
    rows = blocks.select(*keep, "n", F.col("tree").alias("below"), F.col("up").alias("path"))
    for level in reversed(range(LEVELS)):
        nodes = F.transform("below", lambda x: F.struct(x["hash"].alias("hash"), x["below"].alias("below"), step(F.col("below"), x["at"], F.col("n"), level).alias("own")))  # noqa: B023
        rows = rows.select(*keep, "n", "path", F.explode(nodes).alias("_x")).select(*keep, "n", "_x.hash", "_x.below", F.concat("_x.own", "path").alias("path"))
    return rows.select(*keep, "hash", "below.*", "path")


def fold(digest: Column, path: Column) -> Column:
    """The digest at the end of a path."""
    return F.aggregate(path, digest, lambda h, p: sha(F.concat(p["before"], h, p["after"])))


def proof(path: Column) -> Column:
    """All sibling digests of a path, from the leaf up, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), "")


def subtree_paths(nodes: DataFrame, group: str, payload: list[str], n_most: int) -> tuple[DataFrame, DataFrame]:
    """Of nodes (group, rank, n, hash, payload), the largest group having ``n_most``: (group, hash) of each group's root, and the nodes
    (group, hash, payload, path) with their path to it."""
    blocks = cut_lineage(nest(nodes, group, payload))
    no_path = F.array().cast("array<struct<before:string,after:string>>")
    if n_most <= FANOUT**LEVELS:
        roots, up = blocks.select(group, "hash"), None
        lower = blocks.withColumn("up", no_path)
    else:
        left = -(-n_most // FANOUT**LEVELS)
        over = blocks.select(group, F.col("block").alias("rank"), F.expr(f"(n + {FANOUT**LEVELS - 1}) div {FANOUT**LEVELS}").alias("n"), "hash")
        roots, up = subtree_paths(over.withColumn("_b", F.col("rank")), group, ["_b"], left)
        up = up.select(F.col(group).alias("_g"), "_b", F.col("path").alias("up"))
        lower = blocks.join(up, (F.col("block") == F.col("_b")) & F.col(group).eqNullSafe(F.col("_g"))).drop("_g", "_b")
    return roots, unnest(lower, [group])


def manifest(leaves: DataFrame, group: str, id_col: str, payload: list[str]) -> DataFrame:
    """Rows (group, hash, payload; the id among it) with ``subroot``, ``root`` and ``path``: the leaves by id within their group, the groups' roots by group."""
    rows, n_most = ranked(leaves, group, [F.col(id_col).asc_nulls_first(), F.col("hash").asc()])
    if not n_most:
        none = "cast(null as array<struct<before:string,after:string>>)"
        return leaves.where("false").selectExpr(group, "hash", *payload, f"{none} as path", "hash as subroot", "hash as root")
    roots, nodes = subtree_paths(rows, group, payload, n_most)
    tops, many = ranked(roots.withColumn("_all", F.lit(0)).withColumn("_name", F.col(group)), "_all", [F.col("_name").asc_nulls_first()])
    top, over = subtree_paths(tops, "_all", ["_name"], many)
    known = over.join(top.select("_all", F.col("hash").alias("root")), "_all").select("_name", F.col("hash").alias("subroot"), F.col("path").alias("_over"), "root")
    spread = nodes.join(F.broadcast(known), F.col(group).eqNullSafe(F.col("_name"))) if many <= FANOUT**LEVELS else nodes.join(known, F.col(group).eqNullSafe(F.col("_name")))
    return spread.withColumn("path", F.concat("path", "_over")).drop("_name", "_over")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the root again from a copy of it whose text may have been tampered with."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    drawn = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.when(F.col("text").rlike("[A-Z]"), F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    other = F.when(drawn, leaf_digest([*[F.col(c) for c in FIELDS[:-1]], lowered]))
    leaves = docs.select("doc_id", "lang", leaf_digest([F.col(c) for c in FIELDS]).alias("hash"), other.alias("other"))
    rows = manifest(leaves, "lang", "doc_id", ["doc_id", "other"])
    folded = rows.withColumn("folded_root", fold(F.coalesce("other", "hash"), F.col("path")))
    return folded.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", sha(proof(F.col("path"))).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql(levels: int = 6, over: int = 2) -> str:
    """The same by one pair of steps a level, for up to 8^levels documents a language and 8^over languages."""
    form = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    crc = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    parts = [
        f"base AS (SELECT doc_id, lang, sha256({' || '.join(form(c) for c in FIELDS)}) AS leaf, sha256({' || '.join(form(c) for c in FIELDS[:-1])} || {form(lowered)}) AS low, coalesce({crc} % 3 = 0, false) AS drawn FROM documents)",
        "l0 AS (SELECT doc_id, leaf, CASE WHEN drawn THEN low ELSE leaf END AS fold, '' AS proof, lang AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM base)",
        "t0 AS (SELECT g, i, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM l0)",
    ]
    def climb(leaves: str, tree: str, k: int) -> list[str]:
        return [
            f"r{tree}{k} AS (SELECT g, i // {FANOUT} AS j, any_value(n) AS n, list(struct_pack(i := i, h := h) ORDER BY i) AS run FROM {tree}{k} GROUP BY g, j)",
            f"{tree}{k + 1} AS (SELECT g, j AS i, CASE WHEN n > 1 THEN sha256(list_aggregate(list_transform(run, lambda x: x.h), 'string_agg', '')) ELSE run[1].h END AS h, (n + {FANOUT - 1}) // {FANOUT} AS n FROM r{tree}{k})",
            f"{leaves}{k + 1} AS (SELECT l.* EXCLUDE (i, fold, proof), l.i // {FANOUT} AS i, CASE WHEN n > 1 THEN sha256(list_aggregate(list_transform(run, lambda x: CASE WHEN x.i = l.i THEN fold ELSE x.h END), 'string_agg', '')) ELSE fold END AS fold,"
            f" proof || coalesce(list_aggregate(list_transform(list_filter(run, lambda x: x.i <> l.i), lambda x: x.h), 'string_agg', ''), '') AS proof FROM {leaves}{k} l JOIN r{tree}{k} r ON l.g IS NOT DISTINCT FROM r.g AND l.i // {FANOUT} = r.j)",
        ]
    for k in range(levels):
        parts += climb("l", "t", k)
    parts += [
        f"u0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, h, count(*) OVER () AS n, g AS lang FROM t{levels})",
        f"m0 AS (SELECT l.doc_id, l.leaf, u.h AS subroot, l.fold, l.proof, 0 AS g, u.i FROM l{levels} l JOIN u0 u ON l.g IS NOT DISTINCT FROM u.lang)",
    ]
    for k in range(over):
        parts += climb("m", "u", k)
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, u.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = u.h AS verified FROM m{over} m JOIN u{over} u USING (g)"


QUERIES = {"op13_merkle_manifest": op13_merkle_manifest}
ORACLES = {"op13_merkle_manifest": _sql()}
