"""Near-duplicate documents by BagMinHash signatures on multisets of five-word shingles.

A document is a bag of shingles with counts. Each (shingle, level block) owns a Poisson process in
time whose points carry a register and a level; blocks double in width, (0,1], (1,2], (2,4], ... so
a count needs few of them, and in the last block only points at or below the count stay. The
earliest point of each register is the signature. Two registers agree with a probability of exactly
the weighted Jaccard similarity, sum of minima over sum of maxima. Processes are followed only until
they pass the time by which all registers are filled, so a document costs its number of shingles plus
a constant.

Signatures are cut into bands; documents with an equal band are candidates. Documents with equal bags are one
class, and only its smallest id goes on. Verified links (exact weighted Jaccard of at least the limit, on whole
texts) join documents to components. In a bucket of up to ``SMALL`` documents all pairs are verified. In a larger
one a member first meets a hub, the member that meets most others (one hub a document, over all its buckets); in
further rounds a document whose bucket still holds other components meets one member drawn for it. At last all
documents of large buckets with more than one component are compared across components wherever a prefix
filter, which is exact, lets them reach the limit. So no candidate link between components is left out, and
neither a large family of copies nor one of looser variants makes all its pairs. A hub's text goes to as many
tasks as its number of partners asks for, once each.

Cases: texts without any word take no part and are classes of their own; so are null ids, which
stay as they are; of several texts under one id the one with the largest hash counts; repeated rows are equal
bags; texts under five words have one shingle; an empty table gives an empty result; extra columns pass through
``keep_one``, whatever their names, and are not looked at otherwise but to choose between rows of one id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, columns, cut_lineage, in_tasks, table
from .tokens import bags, mixed, pieces

SHINGLE = 5
LIMIT = 0.8
BANDS = 32
ROWS = 6
#: Buckets of up to so many documents make all their pairs.
SMALL = 3
#: Rounds in which documents that are still apart meet a drawn member of a bucket before the prefix filter.
SPREAD_ROUNDS = 2
#: Partners of a hub that one task compares, about.
HUB_SLICE = 256
#: Ratio of the shortest and longest bags of a length class of the prefix filter.
LENGTH_STEP = 1.05
#: Narrow rows, and pairs to verify, that one task handles, about; smaller frames take fewer tasks.
TASK_ROWS = 100_000
TASK_PAIRS = 2000


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from 64-bit values."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def bag_minhash(owner: np.ndarray, h: np.ndarray, count: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """Signatures (n_docs x m) of 64-bit values; rows of documents without shingles are zero."""
    with np.errstate(over="ignore"):
        top = np.ceil(np.log2(count)).astype(np.int64)  # last block of each count: (2^(b-1), 2^b]
        blocks = top + 1
        elem = np.repeat(np.arange(len(h)), blocks)
        block = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        high = np.left_shift(1, block).astype(np.float64)
        low = np.where(block == 0, 0.0, high / 2)
        weight = count[elem].astype(np.float64)
        doc = owner[elem]
        seed = mixed(h[elem] ^ (block.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        total = np.bincount(owner, weights=count, minlength=n_docs)
        best = np.full(n_docs * m, np.inf)
        mark = np.zeros(n_docs * m, np.uint64)
        horizon = np.where(total > 0, m * (np.log(m) + 2.0) / np.maximum(total, 1), 0.0)
        time = np.zeros(len(seed))
        step = np.zeros(len(seed), np.uint64)
        pending = np.arange(len(seed))
        while len(pending):
            live = pending
            while len(live):
                ahead_of = min(64, max(1, 50_000 // len(live)))  # points drawn at once: many where few processes are left
                x = mixed(seed[live][:, None] + (step[live][:, None] + np.arange(ahead_of, dtype=np.uint64)) * np.uint64(0xA0761D6478BD642F))
                at = -np.log(_uniform(x)) / (high[live] - low[live])[:, None]
                at[:, 0] += time[live]
                np.cumsum(at, axis=1, out=at)
                ok = at <= horizon[doc[live]][:, None]
                drawn = ok.sum(axis=1)
                some = np.flatnonzero(drawn)
                time[live[some]] = at[some, drawn[some] - 1]
                step[live] += drawn.astype(np.uint64)
                own, x, at = np.repeat(live, drawn), x[ok], at[ok]
                live = live[drawn == ahead_of]
                y = mixed(x ^ np.uint64(0x5851F42D4C957F2D))
                level = low[own] + _uniform(mixed(y)) * (high[own] - low[own])
                inside = np.flatnonzero(level <= weight[own])
                own, x, y, at = own[inside], x[inside], y[inside], at[inside]
                slot = doc[own] * m + (y % np.uint64(m)).astype(np.int64)
                value = mixed(x ^ seed[own])
                np.minimum.at(best, slot, at)
                won = at == best[slot]
                mark[slot[won]] = value[won]
            # a register without a point needs a later horizon; points go on where they stopped
            empty = np.isinf(best).reshape(n_docs, m).any(axis=1) & (total > 0)
            horizon[empty] *= 2
            pending = np.flatnonzero(empty[doc])
        return mark.reshape(n_docs, m)


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per document: id, tag (hash of the text), key_1, key_2 (digest of the bag), words (bag size), bands (hash of each band)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids, tags = batch["t"].tolist(), batch["i"].to_numpy(), batch["g"].to_numpy()
            for a, b in pieces(texts):
                n = b - a
                owner, h, count = bags(texts[a:b], SHINGLE)
                size = np.bincount(owner, weights=count, minlength=n).astype(np.int64)
                keys = np.zeros((2, n), np.uint64)
                with np.errstate(over="ignore"):
                    for k in range(2):
                        term = mixed(mixed(h ^ np.uint64(0x1234567 + k)) + count.astype(np.uint64))
                        np.add.at(keys[k], owner, term)
                    mark = bag_minhash(owner, h, count, n, BANDS * ROWS).reshape(n, BANDS, ROWS)
                    band = np.zeros((n, BANDS), np.uint64)
                    for r in range(ROWS):
                        band = mixed(band ^ mark[:, :, r])
                has = np.flatnonzero(size > 0)
                if not len(has):
                    continue
                yield pd.DataFrame({
                    "id": ids[a:b][has], "tag": tags[a:b][has], "key_1": keys[0][has].view(np.int64), "key_2": keys[1][has].view(np.int64),
                    "words": size[has], "bands": list(band[has].view(np.int64)),
                })

    narrow = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("g"))
    return narrow.mapInPandas(run, "id long, tag long, key_1 long, key_2 long, words long, bands array<long>")


def verified(pairs: DataFrame, texts: DataFrame, limit: float) -> DataFrame:
    """Those (a, b) whose whole texts have a weighted Jaccard similarity of at least the limit; ``a`` may stand in many pairs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            left, right = batch["ta"].tolist(), batch["tb"].tolist()
            ids = batch[["a", "b"]].to_numpy()
            for s, e in pieces([x + y for x, y in zip(left, right, strict=True)]):
                n = e - s
                hubs, first, hub = np.unique(ids[s:e, 0], return_index=True, return_inverse=True)  # a hub's bag is made once
                owner, h, count = bags([left[s + k] for k in first] + right[s:e], SHINGLE)
                size = np.bincount(owner, minlength=len(hubs) + n)
                start = np.cumsum(size) - size
                each = np.concatenate([hub, np.arange(len(hubs), len(hubs) + n)])  # bags of all pairs, both sides
                at = np.repeat(start[each] - np.cumsum(size[each]) + size[each], size[each]) + np.arange(int(size[each].sum()))
                pair, h, count = np.repeat(np.tile(np.arange(n), 2), size[each]), h[at], count[at]
                order = np.lexsort((h, pair))
                pair, h, count = pair[order], h[order], count[order]
                both = np.flatnonzero((h[1:] == h[:-1]) & (pair[1:] == pair[:-1]))
                common = np.bincount(pair[both], weights=np.minimum(count[both], count[both + 1]), minlength=n)
                total = np.bincount(pair, weights=count, minlength=n)
                good = common >= limit * (total - common) - 1e-9
                yield pd.DataFrame(ids[s:e][good], columns=["a", "b"])

    n = pairs.count()
    loads = in_tasks(pairs.groupBy("a").agg((F.floor(F.count(F.lit(1)) / HUB_SLICE) + 1).alias("slices")), n, TASK_ROWS)
    dealt = in_tasks(pairs.join(loads, "a"), n, TASK_ROWS).join(texts.select(F.col("id").alias("b"), F.col("t").alias("tb")), "b")
    dealt = dealt.select("a", "b", "tb", F.pmod(F.xxhash64("b"), F.col("slices")).alias("slice"))
    hubs = loads.join(texts.select(F.col("id").alias("a"), F.col("t").alias("ta")), "a").select("a", "ta", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
    dealt, hubs = in_tasks(dealt, n, TASK_PAIRS), in_tasks(hubs, n, TASK_PAIRS)
    return in_tasks(dealt.join(hubs, ["a", "slice"]), n, TASK_PAIRS).select("a", "b", "ta", "tb").mapInPandas(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of all ids in some edges (a, b); the component is the smallest id in it.

    Every round moves each vertex to the least of its neighbours and contracts the edges. Least is by
    id in the first and every other round, which takes a star around its smallest id at once, and by a random
    priority in between, so a long chain shrinks by a constant factor. Rounds are cut by checkpoints.
    """
    n, moves, turn = edges.count(), [], 0
    small = lambda df: in_tasks(df, 2 * n, TASK_ROWS)
    rest = small(edges.select("a", "b"))
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct((F.xxhash64(F.col(c), F.lit(turn)) if turn % 2 else F.lit(0).cast("long")).alias("p"), F.col(c).alias("v"))  # noqa: B023, E731
        move = small(small(both).groupBy("a").agg(F.min(rank("b")).alias("n")).select("a", F.least(rank("a"), F.col("n")).getField("v").alias("to")))
        moves.append(move)
        to = move.select(F.col("a").alias("x"), "to")
        rest = small(rest.join(to, rest.a == to.x)).select(F.col("to").alias("a"), "b")
        rest = small(rest.join(to, rest.b == to.x)).select("a", F.col("to").alias("b"))
        rest = small(cut_lineage(small(rest.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())))
        turn += 1
    if not moves:
        return edges.select(F.col("a").alias("id"), F.col("a").alias("component"))
    found = moves[0].select(F.col("a").alias("id"), F.col("to").alias("root"))
    for move in moves[1:]:
        step = move.select(F.col("a").alias("x"), "to")
        found = small(found.join(step, found.root == step.x, "left").select("id", F.coalesce("to", "root").alias("root")))
    least = small(found.groupBy("root").agg(F.min("id").alias("component")))
    return small(cut_lineage(small(found.join(least, "root").select("id", "component"))))


def prefix_candidates(open_: DataFrame, texts: DataFrame, limit: float) -> DataFrame:
    """Pairs of rows (id, words, part) of different parts that can reach the limit, by the prefix filter.

    The members of a bag, each repeat on its own, are put in one order, rare ones first. Two bags that reach the limit
    share one of their first ``n - ceil(limit * n) + 1`` members, whatever the order is. A text with more members of
    its own than that meets nothing, so a family of copies that are not close enough makes no pairs.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts_, ids = batch["t"].tolist(), batch["id"].to_numpy()
            for a, b in pieces(texts_):
                owner, h, count = bags(texts_[a:b], SHINGLE)
                at = np.repeat(np.arange(len(h)), count)
                repeat = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
                with np.errstate(over="ignore"):
                    member = mixed(h[at] + mixed(repeat.astype(np.uint64)))
                yield pd.DataFrame({"id": ids[a:b][owner[at]], "member": member.view(np.int64)})

    members = cut_lineage(texts.join(open_.select("id"), "id", "left_semi").select("id", "t").mapInPandas(run, "id long, member long"))
    rarity = members.groupBy("member").agg(F.count(F.lit(1)).alias("df"))
    ranked = members.join(rarity, "member").withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy("df", "member")))
    common = limit / (1 + limit)  # of the members of both bags, so many must be shared
    up = lambda c: F.ceil(c - 1e-6)
    kept = open_.join(ranked.where((F.col("df") > 1)), "id").where(F.col("place") <= F.col("words") - up(F.col("words") * limit) + 1).select("id", "words", "part", "member", "place")
    length_class = lambda c: F.floor(F.log(c) / float(np.log(LENGTH_STEP)))
    # the shorter bag of a pair: its partner has no fewer members
    short = kept.where(F.col("place") <= F.col("words") - up(F.col("words") * (2 * common)) + 1).withColumn("class", length_class(F.col("words")))
    # the longer one, for each class of lengths that a partner can have; few places suffice for a class near its own
    longer = kept.select(F.col("id").alias("id_2"), F.col("words").alias("words_2"), F.col("part").alias("part_2"), "member", F.col("place").alias("place_2"))
    longer = longer.withColumn("class", F.explode(F.sequence(length_class(up(F.col("words_2") * limit)), length_class(F.col("words_2")))))
    least = F.greatest(F.lit(1.0), F.floor(F.pow(F.lit(LENGTH_STEP), F.col("class")) - 1e-6))
    longer = longer.where(F.col("place_2") <= F.col("words_2") - up((least + F.col("words_2")) * common) + 1)
    # at the first member in common, what follows in either bag must still suffice
    left = F.least(F.col("words") - F.col("place"), F.col("words_2") - F.col("place_2")) + 1
    enough = left >= up((F.col("words") + F.col("words_2")) * common)
    ordered = (F.col("words") < F.col("words_2")) | ((F.col("words") == F.col("words_2")) & (F.col("id") < F.col("id_2")))
    return short.join(longer, ["member", "class"]).where((F.col("part") != F.col("part_2")) & ordered & enough)


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """One row per distinct non-null id with words: (id, copy_of, class_id).

    ``copy_of`` is the smallest id with an equal bag, ``class_id`` the smallest id of the component.
    """
    every = cut_lineage(signatures(docs, id_col, text_col))
    signed = every.groupBy("id").agg(F.max(F.struct("tag", "key_1", "key_2", "words", "bands")).alias("s")).select("id", "s.*")
    exact = signed.groupBy("key_1", "key_2").agg(F.min(F.struct("id", "tag", "words", "bands")).alias("first"))
    reps = cut_lineage(exact.select("key_1", "key_2", "first.*"))
    rows = reps.select("id", "words", F.posexplode("bands").alias("band", "value"))
    # hash values of different bands may not meet, so the band is part of the key
    rows = rows.select("id", "words", F.xxhash64("band", "value").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = cut_lineage(rows.join(shared, "bucket"))
    n_met = met.count()
    met = in_tasks(met, n_met, TASK_ROWS)
    needed = met.select("id").distinct().join(reps.select("id", "tag"), "id").withColumnsRenamed({"id": "_id", "tag": "_tag"})
    plain = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    own = plain.join(needed, F.col("id") == F.col("_id")).where(F.xxhash64("t") == F.col("_tag"))
    texts = cut_lineage(own.select("id", "t").dropDuplicates(["id"]))
    close = (F.col("words") >= F.col("words_2") * limit) & (F.col("words_2") >= F.col("words") * limit)
    # small buckets: all pairs
    group = F.array_sort(F.collect_list(F.struct("id", "words")))
    few = met.where(F.col("n") <= SMALL).groupBy("bucket").agg(group.alias("g"))
    few = few.select(F.posexplode("g").alias("k", "x"), "g").select("x.id", "x.words", F.explode(F.slice("g", F.col("k") + 2, SMALL)).alias("y"))
    few = few.select("id", "words", F.col("y.id").alias("id_2"), F.col("y.words").alias("words_2")).where(close).select(F.col("id").alias("a"), F.col("id_2").alias("b"))
    # large buckets: the hub is the member that meets most others over all its buckets; of a family of edited copies
    # that is the text they were made from, which is close to all of them while they are not to each other
    large = met.where(F.col("n") > SMALL).select("bucket", "id", "words", "n")
    narrow = lambda df: in_tasks(df, n_met, TASK_ROWS)
    degrees = narrow(large.groupBy("id").agg(F.sum("n").alias("degree")))
    weight = F.struct("degree", (-F.col("id")).alias("minus"), "words")
    hubs = narrow(narrow(large.join(degrees, "id")).groupBy("bucket").agg(F.max(weight).alias("hub")))
    star = narrow(large.join(hubs, "bucket")).groupBy("id", "words").agg(F.max("hub").alias("hub"))
    star = star.select("id", "words", (-F.col("hub.minus")).alias("id_2"), F.col("hub.words").alias("words_2")).where((F.col("id") != F.col("id_2")) & close)
    pairs = narrow(cut_lineage(narrow(narrow(few.unionByName(star.select(F.col("id_2").alias("a"), F.col("id").alias("b")))).distinct())))
    found = components(cut_lineage(verified(pairs, texts, limit)))
    parts = cut_lineage(narrow(large.select("id").distinct()).join(found, "id", "full").select("id", F.coalesce("component", "id").alias("component")))
    parts = narrow(parts)
    tested = pairs.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
    for turn in range(SPREAD_ROUNDS + 1):
        placed = narrow(large.join(parts, "id").select("bucket", "id", "words", F.col("component").alias("part")))
        drawn = F.min(F.struct(F.xxhash64("id", "bucket", F.lit(turn)).alias("at"), "id", "words", "part")).alias("hub")
        mixed_buckets = placed.groupBy("bucket").agg(F.min("part").alias("p"), F.max("part").alias("q"), drawn).where("p < q").select("bucket", "hub")
        mixed_buckets = narrow(cut_lineage(narrow(mixed_buckets)))
        if mixed_buckets.isEmpty():
            break
        if turn == SPREAD_ROUNDS:
            open_ = narrow(placed.join(mixed_buckets.select("bucket"), "bucket", "left_semi").select("id", "words", "part"))
            open_ = narrow(cut_lineage(narrow(open_.distinct())))
            across = prefix_candidates(open_, texts, limit).select(F.col("id").alias("b"), F.col("id_2").alias("a"))
        else:  # documents meet one member drawn for a bucket of theirs
            hub = mixed_buckets.select("bucket", F.col("hub.id").alias("id_2"), F.col("hub.words").alias("words_2"), F.col("hub.part").alias("part_2"))
            across = narrow(placed.join(hub, "bucket").where((F.col("part") != F.col("part_2")) & close))
            across = across.groupBy("id").agg(F.max(F.struct(F.xxhash64("id", "bucket", F.lit(turn)), "id_2")).alias("m")).select(F.col("id").alias("b"), F.col("m.id_2").alias("a"))
        across = narrow(across).groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(F.min("a").alias("a"))
        pairs = narrow(cut_lineage(narrow(across.join(narrow(tested), ["x", "y"], "left_anti").select("x", "y", "a"))))
        tested = tested.unionByName(pairs.select("x", "y"))
        more = verified(pairs.select("a", (F.col("x") + F.col("y") - F.col("a")).alias("b")), texts, limit)
        named = lambda side: parts.select(F.col("id").alias(side), F.col("component").alias(f"part_{side}"))  # noqa: E731, B023
        more = narrow(narrow(more.join(named("a"), "a")).join(named("b"), "b").select(F.col("part_a").alias("a"), F.col("part_b").alias("b")))
        more = cut_lineage(narrow(more.distinct()))
        if not more.isEmpty():
            joined = components(more).select(F.col("id").alias("component"), F.col("component").alias("whole"))
            parts = narrow(cut_lineage(narrow(parts.join(joined, "component", "left").select("id", F.coalesce("whole", "component").alias("component")))))
    known = reps.select("key_1", "key_2", F.col("id").alias("copy_of")).join(parts.withColumnRenamed("id", "copy_of"), "copy_of", "left")
    known = known.select("key_1", "key_2", "copy_of", F.coalesce("component", "copy_of").alias("class_id"))
    return signed.select("id", "key_1", "key_2").join(known, ["key_1", "key_2"]).select("id", "copy_of", "class_id")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with its class; a class holds all documents linked by similarity of at least 0.8."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    classes = near_classes(docs)
    out = docs.select("doc_id").join(classes, F.col("doc_id") == F.col("id"), "left")
    return out.select("doc_id", F.coalesce("copy_of", "doc_id").alias("copy_of"), F.coalesce("class_id", "doc_id").alias("class_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the smallest id of each class, once each; rows with a null id stay.

    Of several rows with one id the row of the text that counted stays; of rows that differ only in other columns, the one of the largest hash.
    """
    others = near_classes(docs, id_col, text_col).where("id <> class_id").select(F.col("id").alias("same"), F.lit(True).alias("gone"))
    order = F.struct(F.xxhash64(F.col(text_col)).alias("t"), F.xxhash64(*columns(docs)).alias("all"))
    rows = docs.select(F.struct(*columns(docs)).alias("row"), F.col(id_col).alias("id"), F.when(F.col(text_col).isNotNull(), order).alias("pick"))  # a null text counts least
    several = rows.where("id is not null").groupBy(F.col("id").alias("same")).agg(F.count(F.lit(1)).alias("n"), F.max("pick").alias("best")).where("n > 1")
    marks = others.join(several, "same", "full")  # narrow, so that the rows themselves are dealt once
    kept = rows.join(marks, F.col("id") == F.col("same"), "left").where(F.col("gone").isNull())
    one = Window.partitionBy("id").orderBy(F.desc(F.col("pick").eqNullSafe(F.col("best"))))
    return kept.withColumn("at", F.row_number().over(one)).where(F.col("n").isNull() | (F.col("at") == 1)).select("row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each near-duplicate class."""
    return keep_one(docs.select(*DOCUMENT_COLUMNS))


QUERIES = {"op1_near_dedup": op1_near_dedup}
ORACLES: dict[str, str] = {}
