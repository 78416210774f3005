"""Approximate nearest neighbours by learned partitions.

Fit, on a bounded sample: the neighbour graph of the sample is split into balanced parts (recursive
bisection along the graph's second eigenvector, found by power iteration), and a softmax
classifier learns the part of a vector. Index: every vector goes to its most probable part; equal
vectors are one entry with their smallest ids. Search: a query is routed to its most probable parts,
until they hold the probe share of all entries, and all vectors there are scored exactly, in double
precision. The probe share is set by measurement: some vectors of the sample are searched in the sample
by brute force, and the smallest share that finds ``RECALL`` of their neighbours is used. It is small
where vectors gather in groups and large where they do not. The work is dealt by (part, slice), where the number of slices of a part
follows its size; each slice keeps its best, and the bests of a query are merged.

Where a part has many queries these are sliced too, so a task compares a bounded number of queries with a bounded
number of entries. Vectors meet those of their own length only, each length with a router of its own.

Cases: vectors that are null or zero, or hold null or non-finite components, take no part; copies of a vector are all candidates (only the k + 1 smallest
ids of a copy group can be among the k nearest, and those are kept); fewer candidates than k give all of them;
an empty table gives an empty result; extra columns are not looked at. Null ids take no part.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut_lineage, table

K = 20
#: Vectors to fit on, at most.
SAMPLE = 6000
NEIGHBOURS = 12
#: Entries of a part, about; the number of parts follows the number of entries up to what the bounded sample can teach.
PART_ROWS = 200
MAX_PARTS = 32
#: Recall that the probe share has to reach on the sample, and the number of vectors it is measured with.
RECALL = 0.95
CALIBRATION = 400
SLICE_ROWS = 20_000
#: Queries that one task compares, about.
QUERY_ROWS = 20_000
#: Rows of equal vectors that one window task may hold, about.
COPY_ROWS = 50_000


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest by inner product of unit vectors, for each row of a sample."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for s in range(0, len(x), 1024):
        score = x[s : s + 1024] @ x.T
        score[np.arange(len(score)), np.arange(s, s + len(score))] = -np.inf
        out[s : s + 1024] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(near: np.ndarray, parts: int) -> np.ndarray:
    """Part of each vertex: recursive bisection of the neighbour graph into halves of equal size."""
    n, k = near.shape
    part = np.zeros(n, np.int64)
    edge_a, edge_b = np.repeat(np.arange(n), k), near.ravel()
    groups = 1
    while groups < parts:
        inside = part[edge_a] == part[edge_b]
        a, b = edge_a[inside], edge_b[inside]
        degree = np.maximum(np.bincount(a, minlength=n) + np.bincount(b, minlength=n), 1)
        value = np.random.default_rng(groups).standard_normal(n)
        for _ in range(60):  # lazy random walk; subtract each part's mean, so the second eigenvector is left
            value = 0.5 * value + 0.5 * (np.bincount(a, value[b], n) + np.bincount(b, value[a], n)) / degree
            weight = np.bincount(part, degree, groups)
            value -= (np.bincount(part, value * degree, groups) / weight)[part]
            norm = np.sqrt(np.bincount(part, value * value, groups))
            value /= np.maximum(norm, 1e-300)[part]
        order = np.lexsort((value, part))
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        size = np.bincount(part, minlength=groups)
        first = np.cumsum(size) - size
        part = part * 2 + (rank - first[part] >= (size[part] + 1) // 2)
        groups *= 2
    return part


def softmax_classifier(x: np.ndarray, part: np.ndarray, parts: int, steps: int = 300) -> np.ndarray:
    """Weights (dimensions + 1, parts) of a softmax regression, by gradient steps with momentum."""
    design = np.hstack([x * np.sqrt(x.shape[1]), np.ones((len(x), 1))])
    truth = np.zeros((len(x), parts))
    truth[np.arange(len(x)), part] = 1
    w = np.zeros((design.shape[1], parts))
    speed = np.zeros_like(w)
    for _ in range(steps):
        score = design @ w
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        speed = 0.9 * speed - 0.5 * (design.T @ (p - truth) / len(x) + 1e-4 * w)
        w += speed
    return w


class Router:
    """Part probabilities of vectors."""

    def __init__(self, sample: np.ndarray, parts: int) -> None:
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        self.parts = parts
        self.w = np.zeros((sample.shape[1] + 1, 1))
        if parts > 1:
            self.w = softmax_classifier(unit, balanced_parts(neighbour_graph(unit, NEIGHBOURS), parts), parts)

    def probe_share(self, sample: np.ndarray, k: int, recall: float = RECALL) -> float:
        """Smallest share of the sample, in probed parts, that finds ``recall`` of the k nearest."""
        n = len(sample)
        if self.parts == 1 or n <= k + 1:
            return 1.0
        home = np.argmax(self.scores(sample), axis=1)
        sizes = np.bincount(home, minlength=self.parts)
        asked = np.linspace(0, n - 1, min(CALIBRATION, n)).astype(np.int64)
        score = sample[asked] @ sample.T
        score[np.arange(len(asked)), asked] = -np.inf
        near = np.argpartition(-score, k - 1, axis=1)[:, :k]
        order = np.argsort(-self.scores(sample[asked]), axis=1, kind="stable")
        place = np.argsort(order, axis=1)  # rank of each part for each query
        before = np.cumsum(sizes[order], axis=1) - sizes[order]
        needed = np.take_along_axis(before, np.take_along_axis(place, home[near], axis=1), axis=1) / n
        return float(np.quantile(needed, recall)) + 1.0 / n

    def scores(self, x: np.ndarray) -> np.ndarray:
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        return (unit * np.sqrt(x.shape[1])) @ self.w[:-1] + self.w[-1]


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the vectors that take part, v in double precision."""
    out = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("id is not null and v is not null")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    out = out.where(~bad & F.exists("v", lambda c: c != 0))
    return out


def search(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", part_rows: int = PART_ROWS) -> DataFrame:
    """The k nearest found for each query row, by inner product: query_id, rank, vec_id, score."""
    rows, asked = usable(vectors, id_col, vec_col), usable(queries, id_col, vec_col).dropDuplicates(["id"])
    lengths = sorted(r[0] for r in asked.select(F.size("v")).distinct().collect())  # dimensions, of which a table has few
    if not lengths:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = [search_length(rows.where(F.size("v") == d), asked.where(F.size("v") == d), k, part_rows) for d in lengths]
    return reduce(DataFrame.unionByName, found)


def search_length(rows: DataFrame, asked: DataFrame, k: int, part_rows: int) -> DataFrame:
    """``search`` among (id, v) rows of one length."""
    spark = rows.sparkSession
    # copies of a vector: none but the k + 1 smallest ids can be among the k nearest of a query
    rows = cut_lineage(rows.withColumn("h", F.xxhash64("v")))
    held = Window.partitionBy("h", "s").orderBy("id")
    copies = rows.withColumn("s", F.pmod(F.xxhash64("id"), F.lit(1 + rows.count() // COPY_ROWS)))
    copies = copies.withColumn("r", F.row_number().over(held)).where(F.col("r") <= k + 1)
    entries = copies.groupBy("h", "v").agg(F.slice(F.array_sort(F.collect_list("id")), 1, k + 1).alias("ids"))
    entries = cut_lineage(entries.withColumn("n", F.size("ids")))
    n_entries = entries.count()
    if not n_entries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    parts = 1
    while parts < MAX_PARTS and parts * part_rows < n_entries:
        parts *= 2
    draw = F.pmod(F.xxhash64("h", F.lit("fit")), F.lit(1_000_000)) / 1e6
    drawn = entries.where(draw < min(1.0, SAMPLE / n_entries)).orderBy("h", "ids").limit(2 * SAMPLE).select("v").collect()
    sample = np.array([r["v"] for r in drawn]) if drawn else np.array([entries.first()["v"]])
    parts = min(parts, 1 << (len(sample) // 20).bit_length() >> 1) or 1
    fitted = Router(sample, parts)
    share = fitted.probe_share(sample, k)
    router = spark.sparkContext.broadcast(fitted)

    @F.pandas_udf("int")
    def home(v: pd.Series) -> pd.Series:
        return pd.Series(np.argmax(router.value.scores(np.stack(v.to_numpy())), axis=1).astype(np.int32))

    placed = cut_lineage(entries.withColumn("part", home("v")))
    sizes = np.zeros(parts, np.int64)
    held_ids = np.zeros(parts, np.int64)
    for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("m")).collect():
        sizes[r["part"]], held_ids[r["part"]] = r["n"], r["m"]
    slices = np.maximum(1, -(-sizes // SLICE_ROWS))
    enough = max(share * n_entries, 1)

    @F.pandas_udf("array<struct<part int, slice int>>")
    def route(v: pd.Series) -> pd.Series:
        order = np.argsort(-router.value.scores(np.stack(v.to_numpy())), axis=1, kind="stable")
        reached = np.cumsum(sizes[order], axis=1)
        found = np.cumsum(held_ids[order], axis=1)
        before = np.hstack([np.zeros((len(order), 1)), reached[:, :-1]])
        before_ids = np.hstack([np.zeros((len(order), 1)), found[:, :-1]])
        wanted = (before <= enough) | (before_ids < k + 1)
        return pd.Series([[{"part": int(p), "slice": s} for p in o[w] if sizes[p] for s in range(int(slices[p]))] for o, w in zip(order, wanted, strict=True)])

    asked = cut_lineage(asked)
    query_slices = max(1, -(-asked.count() // QUERY_ROWS))
    asked = asked.withColumn("at", F.explode(route("v"))).select("id", "v", "at.part", "at.slice", F.pmod(F.xxhash64("id"), F.lit(query_slices)).alias("share"))
    n_slices = F.element_at(F.array(*[F.lit(int(s)) for s in slices]), F.col("part") + 1)
    cut = placed.withColumn("slice", F.pmod(F.xxhash64("h", F.lit("slice")), n_slices).cast("int"))

    def rank(query: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(query) and len(own):
            matrix, ids = np.stack(own["v"].to_numpy()), own["ids"].to_numpy()
            many = own["n"].to_numpy()
            flat = np.concatenate([np.asarray(i, np.int64) for i in ids])
            first = np.cumsum(many) - many
            asked_ids, asked_v = query["id"].to_numpy(), np.stack(query["v"].to_numpy())
            for s in range(0, len(asked_ids), 64):
                rough = asked_v[s : s + 64] @ matrix.T  # picks the entries; the measure itself is summed below
                slack = 1e-9 * (1 + np.abs(rough).max())
                for q, v, about in zip(asked_ids[s : s + 64], asked_v[s : s + 64], rough, strict=True):
                    near = np.arange(len(about))
                    if len(about) > k + 1:
                        least = np.partition(about, len(about) - k - 1)[len(about) - k - 1]
                        near = np.flatnonzero(about >= least - slack)
                    score = np.repeat((matrix[near] * v).sum(axis=1), many[near])
                    own_ids = np.concatenate([flat[first[e] : first[e] + many[e]] for e in near])
                    score, own_ids = score[own_ids != q], own_ids[own_ids != q]
                    best = np.lexsort((own_ids, -score))[:k]
                    out["query_id"] += [q] * len(best)
                    out["vec_id"] += own_ids[best].tolist()
                    out["score"] += score[best].tolist()
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    shares = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_slices - 1).cast("long"))).alias("share")
    cut = cut.select("part", "slice", "v", "ids", "n", shares)
    best = asked.groupBy("part", "slice", "share").cogroup(cut.groupBy("part", "slice", "share")).applyInPandas(rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors, vectors.where("vec_id % 20 = 0"))


QUERIES = {"op10_learned_partitions": op10_learned_partitions}
ORACLES: dict[str, str] = {}
