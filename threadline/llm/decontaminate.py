"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a few consecutive tokens that ignores some positions. Seeds of the
benchmark items and of the documents meet by hash; around a meeting the item is laid over the
document at that offset, and the overlap is real if some window of ``WINDOW`` tokens agrees in at least
``AGREE`` of them. The masks are chosen so that every such window with up to two substitutions holds
a seed that none of them touches, so nothing within the limit is missed.

Items of fewer tokens than a window must agree whole, in the same share; those of 8 tokens or more get one
more mask, so that again no placement of the substitutions is missed. Items of fewer tokens than
``WHOLE_BELOW`` must occur whole and unchanged: their mask is all their tokens.

The benchmark goes to the tasks in blocks of about ``BLOCK_BYTES`` of text (an item is never cut), which is checked
before one is sent; a larger benchmark takes several passes over the documents, one after the other, each with one
block, whose result is written before the next is sent. So what the driver and a task hold does not grow.

Cases: null and empty texts match nothing, null ids take no part; repeated documents are each judged (ids decide
pairs); repeated items match under each id; long texts are handled whole; an empty table on either side gives no
pair; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, cut_lineage, table
from .tokens import WORD, mixed, pieces

#: 1: the token counts, 0: it is ignored. Together they cover all pairs of substitutions in 13 tokens.
MASKS = ("111011", "1011011", "110111")
#: For items of fewer tokens than a window: with the others it covers all substitutions allowed in 8 to 12 tokens.
SHORT_MASK = "1100101"
WINDOW = 13
AGREE = 0.8
WHOLE_BELOW = 8
BLOCK_BYTES = 8_000_000
#: Meetings of seeds that are handled at once.
HITS = 1_000_000


def seed_hashes(ids: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the mask laid on every position; 0 where it meets an unknown token (id 0) or the end."""
    span = len(mask)
    n = max(len(ids) - span + 1, 0)
    out, known = np.zeros(n, np.uint64), np.ones(n, bool)
    with np.errstate(over="ignore"):
        for k, used in enumerate(mask):
            if used == "1":
                part = ids[k : k + n]
                known &= part > 0
                out = out * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64)
    return np.where(known, mixed(out) | np.uint64(1), np.uint64(0))


class SeedIndex:
    """Token numbers and sorted seeds of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str | None]]) -> None:
        tokens = [(i, WORD.findall((t or "").lower())) for i, t in items]
        tokens = [(i, t) for i, t in tokens if t]
        self.items = np.array([i for i, _ in tokens], np.int64)
        self.vocabulary: dict[str, int] = {}
        for _, own in tokens:
            for t in own:
                self.vocabulary.setdefault(t, len(self.vocabulary) + 1)
        encoded = [np.array([self.vocabulary[t] for t in own], np.int64) for _, own in tokens]
        self.lengths = np.array([len(e) for e in encoded], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.concatenate([*encoded, np.empty(0, np.int64)])
        groups = [(mask, self.lengths >= WHOLE_BELOW) for mask in MASKS]
        groups += [(SHORT_MASK, (self.lengths >= WHOLE_BELOW) & (self.lengths < WINDOW))]
        groups += [("1" * n, self.lengths == n) for n in range(1, WHOLE_BELOW)]
        self.seeds = []
        for mask, some in groups:
            if not some.any():
                continue
            own = np.flatnonzero(some)
            h = [seed_hashes(encoded[k], mask) for k in own]
            item = np.repeat(own, [len(x) for x in h])
            offset = np.concatenate([np.arange(len(x)) for x in h]).astype(np.int64)
            value = np.concatenate(h)
            order = np.argsort(value, kind="stable")
            small = np.zeros(1 << 16, bool)
            small[(value & np.uint64(0xFFFF)).astype(np.int64)] = True
            self.seeds.append((mask, value[order], item[order], offset[order], small))

    def find(self, ids: np.ndarray, owner: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """Overlaps in a run of documents: (document, item, matching tokens, share of the best window, place in the document)."""
        hits = []
        for mask, value, item, offset, small in self.seeds:
            h = seed_hashes(ids, mask)
            at = np.flatnonzero(small[(h & np.uint64(0xFFFF)).astype(np.int64)] & (h > 0))
            at = at[owner[at] == owner[at + len(mask) - 1]]
            low = np.searchsorted(value, h[at], "left")
            n = np.searchsorted(value, h[at], "right") - low
            # a token that repeats in both texts makes many meetings on few diagonals, so they are reduced as they come
            cuts = np.searchsorted(np.cumsum(n), np.arange(HITS, int(n.sum()) + HITS, HITS), "left") + 1
            for s, e in zip([0, *cuts[:-1]][: len(cuts)], cuts, strict=True):
                m = n[s:e]
                row = np.repeat(low[s:e], m) + np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
                place = np.repeat(at[s:e], m)
                hits.append(np.unique(np.stack([owner[place], item[row], place - offset[row]]), axis=1))
        hits = np.unique(np.concatenate([np.empty((3, 0), np.int64), *hits], axis=1), axis=1)  # an item on a diagonal once
        found: list[tuple[np.ndarray, ...]] = []
        for s in range(0, hits.shape[1], 20_000):
            doc, item, start = hits[:, s : s + 20_000]
            width = int(self.lengths[item].max()) if len(item) else 0
            if not width:
                continue
            column = np.arange(width)
            place = start[:, None] + column
            inside = (column < self.lengths[item][:, None]) & (place >= first[doc][:, None]) & (place < (first + count)[doc][:, None])
            theirs = self.flat[np.minimum(self.starts[item][:, None] + column, len(self.flat) - 1)]
            same = inside & (ids[np.clip(place, 0, len(ids) - 1)] == theirs)
            run = np.concatenate([np.zeros((len(doc), 1), np.int64), np.cumsum(same, axis=1)], axis=1)
            window = np.minimum(WINDOW, self.lengths[item])
            stop = np.minimum(column[None, :] + window[:, None], width)
            fits = column[None, :] + window[:, None] <= self.lengths[item][:, None]
            agree = np.where(fits, np.take_along_axis(run, stop, axis=1) - run[:, :-1], 0).max(axis=1)
            good = agree >= np.where(window < WHOLE_BELOW, window, np.ceil(AGREE * window - 1e-9))
            found.append((doc[good], item[good], same.sum(axis=1)[good], (agree / window)[good], (start - first[doc])[good]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else tuple(np.empty(0, np.int64) for _ in range(5))


def item_blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int, str | None]]]:
    """The benchmark in blocks of bounded size, dealt by the id's hash."""
    narrow = items.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    total = narrow.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = 1 + 2 * total // block_bytes  # twice as many, since a hash deals unevenly
    for b in range(blocks):
        rows = narrow.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b).collect()
        if rows:
            yield sorted((r["i"], r["t"]) for r in rows if r["t"])


def overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per (id, item_id) with a real overlap: matching tokens and best window share of the best diagonal, and its place."""
    narrow = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    spark = docs.sparkSession

    def passed(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index = shared.value
            number = index.vocabulary.get
            for batch in batches:
                texts, ids = batch["t"].tolist(), batch["i"].to_numpy()
                for a, b in pieces(texts):
                    tokens = [[number(t, 0) for t in WORD.findall(x.lower())] for x in texts[a:b]]
                    count = np.array([len(t) for t in tokens], np.int64)
                    flat = np.fromiter((n for t in tokens for n in t), np.int64, int(count.sum()))
                    owner = np.repeat(np.arange(b - a), count)
                    doc, item, matched, share, place = index.find(flat, owner, np.cumsum(count) - count, count)
                    yield pd.DataFrame({"id": ids[a:b][doc], "item_id": index.items[item], "tokens": matched, "share": share.astype(float), "place": place})

        return narrow.mapInPandas(run, "id long, item_id long, tokens long, share double, place long")

    passes: list[DataFrame] = []
    blocks = item_blocks(items, item_col, item_text_col, block_bytes)
    block, following = next(blocks, None), None
    while block is not None:
        following = next(blocks, None)
        shared = spark.sparkContext.broadcast(SeedIndex(block))
        if passes or following is not None:  # one of several blocks: its result is written and the block let go
            passes.append(cut_lineage(passed(shared)))
            shared.unpersist()
        else:
            passes.append(passed(shared))
        block = following
    if not passes:
        return spark.createDataFrame([], "id long, item_id long, tokens long, share double, place long")
    every = reduce(DataFrame.unionByName, passes)
    best = every.groupBy("id", "item_id").agg(F.max(F.struct("share", "tokens", (-F.col("place")).alias("p"))).alias("b"))
    return best.select("id", "item_id", F.col("b.tokens").alias("tokens"), F.col("b.share").alias("share"), (-F.col("b.p")).alias("place"))


def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All (document, benchmark item) pairs with an overlap."""
    found = overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents without any benchmark overlap; null texts and null ids stay."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    hit = overlaps(docs, table(spark, sf_dir, "benchmark")).select(F.col("id").alias("_hit")).distinct()
    return docs.join(hit, F.col("doc_id") == F.col("_hit"), "left_anti")


QUERIES = {"op5_spaced_seeds": op5_spaced_seeds}
ORACLES: dict[str, str] = {}
