"""Alignment of the tokens of two tokenizers by byte offsets, and how usual each link is in the whole corpus.

Lockstep merging: the texts of a batch are lanes of one NumPy state vector (a pointer into the A tokens, one into the B
tokens). In each step every lane compares the byte ends of its two tokens; equal ends are a link and a cut, and the pointer
of the smaller end (or both) goes on. Lanes that are done leave the vector. A text of more than ``LANE_BYTES`` is several
lanes, which start at the first token ending in their byte range, so the number of steps does not grow with the longest text.

A link is a pair of token occurrences whose byte ranges end together; the cuts split a text into groups. One pass of the
texts writes per row its numbers, its groups' digest and its distinct id pairs (packed, sorted by code) to the shared folder.
Pairs are then counted over all rows. The commonest ``FREQUENT`` pairs, a bounded table, go to all tasks and are looked up
where the rows are; what is left, the rare pairs, is joined by a shuffle, so no common pair gathers its documents in a task.

Cases: a text that is null or empty, or whose tokens do not give back its bytes, has no tokens; special tokens in a text are
plain text; repeated ids stay rows of their own; an empty table gives an empty result; columns that are not named are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from functools import cache
from itertools import chain, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, shared_folder, table
from .tokens import pieces

TOKENIZERS = "/opt/tokenizers"
LANE_BYTES = 1024
#: Pairs that are looked up in the tasks: 20 bytes each in the tasks. All others are joined.
FREQUENT = 400_000
#: Runs of one kind of sign from this length on go to the slower encoder of the same vocabulary, whose splitting does not go back.
LONG_RUN = re.compile(r"\s{5000}")

#: Some words from a space up to before another (the last with the spaces after it), or all that is left where spaces go on.
SPACED = re.compile(r".{1,250}[^ ]+(?: +\Z)?|.+", re.DOTALL)
#: The pattern that splits text before the merges of a rank file (a fixed value of the public vocabulary).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable bytes are themselves, the others follow from 256 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """A byte-level vocabulary: encodes by its rank file where one stands beside it, else by the file itself."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        letters = byte_letters()
        self.bytes = [b""] * (max(self.slow.get_vocab().values()) + 1)
        for name, k in vocabulary.items():
            self.bytes[k] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        self.fast = self.ranks(re.sub(r"\.json$", ".tiktoken", path), vocabulary)

    def ranks(self, path: str, vocabulary: dict[str, int]) -> object | None:
        """The encoder of the rank file, if it holds the same tokens under the same ids."""
        import tiktoken

        try:
            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        except FileNotFoundError:
            return None
        same = all(k < len(self.bytes) and self.bytes[k] == b for b, k in ranks.items()) and len(ranks) >= len(vocabulary) - 1
        return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}) if same else None

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of the texts, each with a space before it."""
        out = []
        for t in texts:
            if self.fast is None or LONG_RUN.search(t):
                out.append(np.array(self.slow.encode(" " + t, add_special_tokens=False).ids, np.int64))
            else:
                out.append(self.fast.encode_to_numpy(" " + t, disallowed_special=()).astype(np.int64))
        return out


class Pieces:
    """A sentence-piece vocabulary with byte fallback; it adds the space before a text itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.crossing = any(re.search("[^▁]▁", n) for n in names)
        self.bytes = [bytes([int(n[3:5], 16)]) if self.model.is_byte(k) else n.replace("▁", " ").encode() for k, n in enumerate(names)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of the texts. Where no piece goes on after a space, a text may be cut before spaces, and short strings are faster."""
        if self.crossing:
            return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]
        parts = [SPACED.findall(" " + t) for t in texts]
        ids = iter(self.model.encode([p[1:] for own in parts for p in own], num_threads=1))
        return [np.array(list(chain.from_iterable(islice(ids, len(own)))), np.int64) for own in parts]


@cache
def encoder(path: str) -> ByteLevel | Pieces:
    """The encoder of a vocabulary file, once a worker."""
    return ByteLevel(path) if path.endswith(".json") else Pieces(path)


def merge(ends_a: np.ndarray, first_a: np.ndarray, ends_b: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the A and B tokens that end where one of the other side ends.

    ``ends`` are byte ends within a text, text after text; ``first`` has the place of each text's first token and the number of all.
    """
    cut_a, cut_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    filled = first_a[1:] > first_a[:-1]
    last = np.where(filled, ends_a[np.maximum(first_a[1:], 1) - 1], 0) if len(ends_a) else np.zeros(len(filled), np.int64)
    lanes = -(-last // LANE_BYTES)
    text = np.repeat(np.arange(len(lanes)), lanes)
    low = (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * LANE_BYTES

    def spans(ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First token and end of each lane: the tokens ending in its (low, low + LANE_BYTES]."""
        width = np.int64(last.max(initial=0) + LANE_BYTES + 1)
        key = np.repeat(np.arange(len(first) - 1), np.diff(first)) * width + ends
        at = text * width + low
        return np.searchsorted(key, at, "right"), np.searchsorted(key, at + LANE_BYTES, "right")

    a, stop_a = spans(ends_a, first_a)
    b, stop_b = spans(ends_b, first_b)
    while True:
        live = (a < stop_a) & (b < stop_b)  # with one side at its end no further ends are equal
        if not live.all():
            a, b, stop_a, stop_b = a[live], b[live], stop_a[live], stop_b[live]
        if not len(a):
            return cut_a, cut_b
        x, y = ends_a[a], ends_b[b]
        same = x == y
        cut_a[a[same]] = True
        cut_b[b[same]] = True
        a = a + (x <= y)
        b = b + (y <= x)


@cache
def digits(n: int) -> np.ndarray:
    """The decimal digits of the numbers below n as signs, zero bytes after them."""
    return np.array([str(k) for k in range(n)], dtype=f"S{len(str(n - 1))}").view(np.uint8).reshape(n, -1)


def group_text(ids_a: np.ndarray, cut_a: np.ndarray, first_a: np.ndarray, ids_b: np.ndarray, cut_b: np.ndarray, first_b: np.ndarray) -> list[bytes]:
    """``a1,a2|b1;a3|b2`` of each text: ids in decimal, groups in order."""
    n, total = len(first_a) - 1, len(ids_a) + len(ids_b)
    if not total:
        return [b""] * n
    sides = []
    for ids, cut, other, own in ((ids_a, cut_a, cut_b, "a"), (ids_b, cut_b, cut_a, "b")):
        group = np.cumsum(cut) - cut  # over the whole batch: the last tokens of a text end together
        upto = np.flatnonzero(other) + 1  # tokens of the other side up to the end of a group
        before = np.concatenate([[0], upto])[group] if own == "a" else upto[group]
        sides.append((np.arange(len(ids)) + before, ids, np.where(cut, ord("|") if own == "a" else ord(";"), ord(","))))
    value, sign = np.empty(total, np.int64), np.empty(total, np.uint8)
    for place, ids, mark in sides:
        value[place], sign[place] = ids, mark
    known = digits(1 << int(value.max()).bit_length())
    signs = np.concatenate([known[value], sign[:, None]], axis=1)  # zero bytes are no signs
    width = np.count_nonzero(known, axis=1) + 1
    stops = np.concatenate([[0], np.cumsum(width[value])])[first_a + first_b]
    out = signs[signs > 0]
    return [out[s : max(s, e - 1)].tobytes() for s, e in zip(stops[:-1], stops[1:], strict=True)]


def tokenised(texts: list[str | None], one: ByteLevel | Pieces, other: ByteLevel | Pieces) -> tuple[tuple, tuple]:
    """(ids, byte ends in the text, first) of both sides; a text whose tokens do not give it back has none on either."""
    given = [t or "" for t in texts]
    sides = [[ids if t else ids[:0] for t, ids in zip(given, e.encode(given), strict=True)] for e in (one, other)]
    for i, t in enumerate(given):
        if t:
            whole = b" " + t.encode()
            if any(b"".join(map(e.bytes.__getitem__, ids[i].tolist())) != whole for e, ids in zip((other, one), sides[::-1], strict=True)):
                sides[0][i] = sides[1][i] = np.empty(0, np.int64)
    out = []
    for e, side in zip((one, other), sides, strict=True):
        ids, first = np.concatenate([np.empty(0, np.int64), *side]), np.concatenate([[0], np.cumsum([len(x) for x in side])]).astype(np.int64)
        size = np.array([len(b) for b in e.bytes], np.int64)[ids]
        total = np.cumsum(size)
        base = np.concatenate([[0], total])[first[:-1]]
        out.append((ids, total - np.repeat(base, np.diff(first)), first))
    return out[0], out[1]


def packed(values: np.ndarray) -> bytes:
    """Ascending codes as differences, which the files compress well."""
    return np.diff(values, prepend=0).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """The codes again."""
    return np.cumsum(np.frombuffer(data, np.int64))


def aligned(texts: list[str | None], one: ByteLevel | Pieces, other: ByteLevel | Pieces) -> pd.DataFrame:
    """Per text n_a, n_b, n_groups, n_links, groups_sha256, and its distinct pairs: codes (A id times the size of B, plus B id) and how often each."""
    (ids_a, ends_a, first_a), (ids_b, ends_b, first_b) = tokenised(texts, one, other)
    cut_a, cut_b = merge(ends_a, first_a, ends_b, first_b)
    groups = group_text(ids_a, cut_a, first_a, ids_b, cut_b, first_b)
    cuts = np.diff(np.concatenate([[0], np.cumsum(cut_a)])[first_a])
    code = ids_a[cut_a] * len(other.bytes) + ids_b[cut_b]  # the k-th cut of A is the k-th of B
    stops = np.concatenate([[0], np.cumsum(cuts)])
    pairs, times = [], []
    for s, e in zip(stops[:-1], stops[1:], strict=True):
        own, n = np.unique(code[s:e], return_counts=True)
        pairs.append(packed(own))
        times.append(n.astype(np.int32).tobytes())
    return pd.DataFrame({"n_a": np.diff(first_a), "n_b": np.diff(first_b), "n_groups": cuts, "n_links": cuts, "groups_sha256": [hashlib.sha256(g).hexdigest() if g else "" for g in groups], "pairs": pairs, "times": times})


FACTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: _row (its number), id, the facts of the text, pairs and times, written once to the shared folder."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one, other = encoder(path_a), encoder(path_b)
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch["text"]]
            for s, e in pieces(texts):
                yield pd.concat([batch[["_row", "id"]].iloc[s:e].reset_index(drop=True), aligned(texts[s:e], one, other)], axis=1)

    folder = f"{shared_folder(spark)}/alignment-{uuid.uuid4().hex}"
    rows.mapInPandas(run, f"_row long, id long, {FACTS}, pairs binary, times binary").write.option("compression", "zstd").parquet(folder)
    return spark.read.parquet(folder)


def pair_counts(aligned_rows: DataFrame, size_b: int) -> DataFrame:
    """(pair, b, n, best): how many links hold an id pair, and whether no other A id has more with its B id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                codes = np.concatenate([unpacked(x) for x in batch["pairs"]])
                own, at = np.unique(codes, return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([np.frombuffer(x, np.int32) for x in batch["times"]]), minlength=len(own))
                yield pd.DataFrame({"pair": own, "n": n.astype(np.int64)})

    sums = aligned_rows.select("pairs", "times").mapInPandas(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    sums = sums.withColumn("b", F.pmod("pair", F.lit(size_b)))
    most = sums.groupBy("b").agg(F.max("n").alias("most"))
    return sums.join(most, "b").select("pair", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def link_sums(aligned_rows: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """Rows with ``n_best`` (links that are the corpus-wide best of their B id) and ``count_sum`` (of all links), from pair counts of the same rows.

    Sums are of the links, so a pair that a text holds twice counts twice.
    """
    spark = aligned_rows.sparkSession
    known = counts.select("pair", "n", "best").orderBy(F.desc("n"), "pair").limit(frequent).toPandas().sort_values("pair")  # no more rows than the parameter
    sent = spark.sparkContext.broadcast((known["pair"].to_numpy(np.int64), known["n"].to_numpy(np.int64), known["best"].to_numpy(bool)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, n, best = sent.value
        for batch in batches:
            codes = [unpacked(x) for x in batch["pairs"]]
            stops = np.concatenate([[0], np.cumsum([len(c) for c in codes])]).astype(np.int64)
            code = np.concatenate([np.empty(0, np.int64), *codes])
            times = np.concatenate([np.empty(0, np.int32), *(np.frombuffer(x, np.int32) for x in batch["times"])]).astype(np.int64)
            at = np.minimum(np.searchsorted(own, code), max(len(own) - 1, 0))
            hit = own[at] == code if len(own) else np.zeros(len(code), bool)
            at = np.where(hit, at, 0)
            over = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[stops])  # noqa: B023, E731
            out = batch.drop(columns=["pairs", "times"])
            out["n_best"] = over(np.where(hit, times * best[at], 0) if len(own) else times * 0)
            out["count_sum"] = over(np.where(hit, times * n[at], 0) if len(own) else times * 0)
            rest = [np.flatnonzero(~hit[s:e]) + s for s, e in zip(stops[:-1], stops[1:], strict=True)]
            out["rare"] = [[{"pair": int(code[k]), "times": int(times[k])} for k in r] for r in rest]
            yield out

    looked = aligned_rows.mapInPandas(run, f"_row long, id long, {FACTS}, n_best long, count_sum long, rare array<struct<pair:long,times:long>>")
    each = looked.select("*", F.explode_outer("rare").alias("_x")).drop("rare")
    # a row without rare pairs gets a pair of its own that none has, so such rows do not meet in one task
    each = each.withColumn("_pair", F.coalesce("_x.pair", -1 - F.col("_row")))
    rare = each.join(counts.select(F.col("pair").alias("_pair"), "n", "best"), "_pair", "left")
    facts = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    times = F.coalesce("_x.times", F.lit(0))
    sums = rare.groupBy("_row").agg(*[F.first(c).alias(c) for c in facts], F.sum(F.when(F.col("best"), times).otherwise(0)).alias("_best"), F.sum(times * F.coalesce("n", F.lit(0))).alias("_sum"))
    return sums.select(*facts[:6], (F.col("n_best") + F.col("_best")).alias("n_best"), (F.col("count_sum") + F.col("_sum")).alias("count_sum"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, a byte-level vocabulary against one of sentence pieces."""
    path_a, path_b = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
    rows = align(table(spark, sf_dir, "documents").select("doc_id", "text"), path_a, path_b)
    counts = cut_lineage(pair_counts(rows, len(encoder(path_b).bytes)))
    return link_sums(rows, counts).select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {"op12_token_alignment": op12_token_alignment}
ORACLES: dict[str, str] = {}
