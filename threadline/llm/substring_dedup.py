"""Repeated substrings across documents by prefix-free parsing and suffix sorting.

Rolling hashes of ``GRAM`` bytes cut each text into phrases: a place is a trigger if its hash is the least
among some ``LENGTH``-byte window around it, so every string of ``LENGTH`` bytes holds a trigger and
equal strings hold it at the same offset. A phrase is taken with what lies around its trigger within
reach of such a window, so phrases overlap and no string falls between two of them.

Documents are dealt into blocks. (1) Every block sends its distinct trigger hashes, dealt by hash, and
hears which of them other blocks hold too. (2) Only phrases at such shared triggers form the dictionary;
each block sends a distinct phrase once with the smallest document id in which the block has it (the
parse). (3) In each hash range the suffixes of the dictionary's phrases are sorted by prefix doubling up to
``LENGTH`` bytes; suffixes of equal rank are equal strings, and the smallest id over all phrases with that
rank is where the string first occurs in the corpus. (4) Blocks hear the first documents of their phrases'
suffixes and mark, in each document, the strings that a smaller id has too.

A short string in very many documents, with other neighbours in each, gives a distinct phrase per document at one
trigger. In (1) blocks also say how many phrases they have at a trigger that is frequent there; where all blocks
together may have more than ``HOT_PHRASES``, the phrases are not sorted but cut into their strings of ``LENGTH``
bytes, which are dealt by their own hash. Equal strings of a block are one row with the least and largest id, whatever
their phrases, and strings that differ go to different tasks, so a range does not grow with the documents at a trigger.

What is shuffled is the texts once, eight bytes a trigger, and the shared phrases. A phrase that very many
documents hold is one row a block. Comparison is of bytes; hashes only choose what is compared, apart from
the 64-bit digest that names a phrase or a string within a block.

Cases: null texts are empty; a null id takes no part and keeps all; documents with equal ids are not smaller
than each other; texts under ``LENGTH`` bytes keep all; equal texts: all but the smallest id go entirely;
an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, task_count
from .tokens import mixed

LENGTH = 50
GRAM = 24
REACH = LENGTH - GRAM  # bytes before and after a trigger that a window with it can hold
WIDTH = LENGTH + REACH  # bytes of a phrase
#: Text that a block of documents should hold, about.
BLOCK_BYTES = 8_000_000
PIECE_BYTES = 1_000_000
#: More phrases than this at one trigger, over all blocks, are compared string by string.
HOT_PHRASES = 20_000
#: Blocks count the phrases of triggers that stand in so many places of theirs.
FREQUENT = 16
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, at least n of each."""
    if not _powers or len(_powers[0][0]) < n:
        with np.errstate(over="ignore"):
            size = max(n, PIECE_BYTES + 100_000)
            step = np.full(size, np.uint64(_BASE))
            back = np.full(size, np.uint64(pow(_BASE, -1, 2**64)))
            step[0] = back[0] = 1
            _powers[0] = np.cumprod(step), np.cumprod(back)
    return _powers[0]


def sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Minimum or maximum of every run of ``width`` entries, by doubling."""
    size = 1
    out = x
    while size * 2 <= width:
        out = pick(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return pick(out[:-rest], out[rest:]) if rest else out


class Piece:
    """Some documents in one buffer, with zero bytes around each, and their triggers."""

    def __init__(self, texts: list[bytes]) -> None:
        gap = b"\0" * LENGTH
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.buffer = np.frombuffer(gap + b"".join(x for t in texts for x in (t, gap)), np.uint8)
        self.starts = np.cumsum(self.sizes + LENGTH) - self.sizes
        n = len(self.buffer)
        step, back = powers(n + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum((self.buffer.astype(np.uint64) + np.uint64(1)) * step[:n], out=total[1:])
            grams = mixed((total[GRAM:] - total[:-GRAM]) * back[: n - GRAM + 1]) | np.uint64(1)
        least = sliding(grams, LENGTH - GRAM + 1, np.minimum)
        outside = np.ones(len(least), bool)  # windows that are not inside one document
        for s, size in zip(self.starts, self.sizes, strict=True):
            outside[s : s + max(size - LENGTH + 1, 0)] = False
        least[outside] = 0
        span = LENGTH - GRAM + 1
        around = sliding(np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)]), span, np.maximum)
        self.at = np.flatnonzero(around[: len(grams)] == grams)
        self.key = grams[self.at]
        self.doc = np.searchsorted(self.starts, self.at, "right") - 1

    def phrases(self, some: np.ndarray) -> np.ndarray:
        """Rows of WIDTH bytes and two more, which say how much of the phrase lies in the document, before and after the trigger."""
        at, doc = self.at[some], self.doc[some]
        out = np.zeros((len(at), WIDTH + 4), np.uint8)
        out[:, :WIDTH] = self.buffer[at[:, None] + np.arange(-REACH, LENGTH)]
        out[:, WIDTH] = np.minimum(at - self.starts[doc], REACH)
        out[:, WIDTH + 1] = np.minimum(self.starts[doc] + self.sizes[doc] - at, LENGTH)
        return out


def digests(rows: np.ndarray) -> np.ndarray:
    """64-bit digest of each phrase row."""
    parts = np.ascontiguousarray(rows).view(np.uint64)
    out = np.zeros(len(rows), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(parts.shape[1]):
            out = mixed(out ^ parts[:, k])
    return out


def pieces(block: pd.DataFrame) -> Iterator[tuple[np.ndarray, Piece]]:
    """The documents of a block in pieces of bounded size: row numbers and the piece."""
    start = size = 0
    texts = block["t"].tolist()
    for i, t in enumerate(texts):
        size += len(t) + LENGTH
        if size >= PIECE_BYTES or i == len(texts) - 1:
            yield np.arange(start, i + 1), Piece(texts[start : i + 1])
            start, size = i + 1, 0


def shared_within(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Keys that stand in two documents or more."""
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    return np.unique(key[1:][(key[1:] == key[:-1]) & (doc[1:] != doc[:-1])])


def suffix_classes(rows: np.ndarray) -> np.ndarray:
    """Rank of the LENGTH bytes from each of the first REACH + 1 places of each row, by prefix doubling.

    Ranks are places in the sorted order of all such suffixes; equal ranks are equal strings.
    """
    n = len(rows)
    size = 1
    rank = rows[:, :WIDTH].astype(np.int64)
    while size * 2 <= LENGTH:
        pair = rank[:, : rank.shape[1] - size] * (int(rank.max()) + 1) + rank[:, size:]
        if size >= 4:  # pairs of up to eight bytes fit as they are
            pair = np.unique(pair, return_inverse=True)[1].reshape(n, -1)
        else:
            pair = rank[:, : rank.shape[1] - size] * (256**size) + rank[:, size:]
        rank, size = pair, size * 2
    rest = LENGTH - size
    if rest:
        pair = rank[:, : rank.shape[1] - rest] * (int(rank.max()) + 1) + rank[:, rest:]
        rank = np.unique(pair, return_inverse=True)[1].reshape(n, -1)
    return rank[:, : REACH + 1]


def first_documents(rows: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each phrase and place, the smallest id whose phrase holds that string; the largest value where no string fits."""
    rank = suffix_classes(rows)
    place = np.arange(REACH + 1)
    fits = (place >= REACH - rows[:, WIDTH].astype(np.int64)[:, None]) & (place <= REACH - LENGTH + rows[:, WIDTH + 1].astype(np.int64)[:, None])
    none = np.iinfo(np.int64).max
    least = np.full(int(rank.max()) + 1, none)
    np.minimum.at(least, rank[fits], np.broadcast_to(docs[:, None], rank.shape)[fits])
    return np.where(fits, least[rank], none)


def fitting(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The strings of LENGTH bytes in some phrases: phrase, place, bytes."""
    place = np.arange(REACH + 1)
    fits = (place >= REACH - rows[:, WIDTH].astype(np.int64)[:, None]) & (place <= REACH - LENGTH + rows[:, WIDTH + 1].astype(np.int64)[:, None])
    entry, at = np.nonzero(fits)
    return entry, at, rows[entry[:, None], at[:, None] + np.arange(LENGTH)]


def strings(rows: np.ndarray, key: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct strings at each trigger key: name (their hash), key, bytes, first and last document. Phrases are taken in parts, as they hold up to REACH + 1 strings each."""
    parts = []
    for s in range(0, len(rows), 20_000):
        entry, _, text = fitting(rows[s : s + 20_000])
        parts.append(folded(string_hashes(text), key[s + entry], text, first[s + entry], last[s + entry]))
    return folded(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def folded(name: np.ndarray, key: np.ndarray, text: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One row a (name, key), with the least first and the largest last document."""
    if not len(name):
        return name, key, text, first, last
    order = np.lexsort((key, name))
    name, key = name[order], key[order]
    at = np.flatnonzero(np.append(True, (name[1:] != name[:-1]) | (key[1:] != key[:-1])))
    return name[at], key[at], text[order[at]], np.minimum.reduceat(first[order], at), np.maximum.reduceat(last[order], at)


def string_hashes(texts: np.ndarray) -> np.ndarray:
    """64-bit hash of each string of LENGTH bytes."""
    wide = np.zeros((len(texts), -(-LENGTH // 8) * 8), np.uint8)
    wide[:, :LENGTH] = texts
    return digests(wide)


def packed(values: np.ndarray) -> bytes:
    """Bytes of an array, compressed: phrases are text and shuffle much smaller this way."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpacked(data: bytes, dtype: type) -> np.ndarray:
    """The array of ``packed``."""
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, hot_phrases: int = HOT_PHRASES) -> DataFrame:
    """Per document: id, ``n_bytes``, ``spans`` (starts and ends of the removed runs, in turn) and ``kept`` (the bytes left)."""
    return spans_and_sizes(docs, id_col, text_col, block_bytes, hot_phrases)[0]


def spans_and_sizes(docs: DataFrame, id_col: str, text_col: str, block_bytes: int, hot_phrases: int) -> tuple[DataFrame, DataFrame]:
    """``repeated_spans``, and what is dealt out for it: a row per range and block, with the number of phrases or strings."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("i"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("t"))
    total = base.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_blocks = max(task_count(spark), -(-int(total) // block_bytes))
    frequent = min(FREQUENT, hot_phrases)
    n_buckets = 4 * n_blocks  # the suffix sort needs many times the memory of its phrases
    blocks = base.where("i is not null").select(F.pmod(F.xxhash64("i"), F.lit(n_blocks)).cast("int").alias("block"), "i", "t")

    def dealt(key: np.ndarray) -> np.ndarray:
        return ((key >> np.uint64(33)) % np.uint64(n_buckets)).astype(np.int32)

    def phrase_counts(keys: np.ndarray, places: np.ndarray, own: Iterator[Piece]) -> np.ndarray:
        """At most so many distinct phrases has the block at each key; exact where the key is frequent."""
        counts = np.minimum(places, frequent).astype(np.int32)
        many = keys[places > frequent]
        if not len(many):
            return counts
        seen = []
        for p in own:
            some = np.flatnonzero(many[np.minimum(np.searchsorted(many, p.key), len(many) - 1)] == p.key)
            for s in range(0, len(some), 50_000):
                part = some[s : s + 50_000]
                seen.append(np.unique(np.stack([p.key[part], digests(p.phrases(part))], axis=1), axis=0))
        key, n = np.unique(np.unique(np.concatenate(seen), axis=0)[:, 0], return_counts=True)
        counts[np.searchsorted(keys, key)] = n
        return counts

    def triggers(block: pd.DataFrame) -> pd.DataFrame:
        keys, places = np.unique(np.concatenate([p.key for _, p in pieces(block)]), return_counts=True)
        if not len(keys):
            return pd.DataFrame({"bucket": [], "block": [], "keys": [], "counts": []})
        counts = phrase_counts(keys, places, (p for _, p in pieces(block)))
        bucket = dealt(keys)
        order = np.argsort(bucket, kind="stable")
        keys, bucket, counts = keys[order], bucket[order], counts[order]
        at = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(at[1:], len(keys))
        return pd.DataFrame({"bucket": bucket[at], "block": np.full(len(at), block["block"].iloc[0], np.int32), "keys": [keys[s:e].tobytes() for s, e in zip(at, ends, strict=True)], "counts": [packed(counts[s:e]) for s, e in zip(at, ends, strict=True)]})

    def meeting(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(k, np.uint64) for k in rows["keys"]]
        keys = np.concatenate(parts)
        row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        counts = np.concatenate([unpacked(c, np.int32) for c in rows["counts"]])[twice]
        row, keys = row[twice], keys[twice]
        _, number = np.unique(keys, return_inverse=True)
        hot = np.bincount(number, counts)[number] > hot_phrases
        own = np.unique(row)
        ends = np.searchsorted(row, own, "right")
        starts = np.searchsorted(row, own, "left")
        return pd.DataFrame({"block": rows["block"].to_numpy()[own], "keys": [keys[s:e].tobytes() for s, e in zip(starts, ends, strict=True)], "hot": [keys[s:e][hot[s:e]].tobytes() for s, e in zip(starts, ends, strict=True)]})

    def dictionary(block: pd.DataFrame, heard: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "block", "phrases", "first", "last", "keys", "n"]
        if not len(block):
            return pd.DataFrame({c: [] for c in columns})
        ids = block["i"].to_numpy()
        own = [(ids[rows], p) for rows, p in pieces(block)]
        inside = shared_within(np.concatenate([p.key for _, p in own]), np.concatenate([i[p.doc] for i, p in own]))
        wanted = np.unique(np.concatenate([inside, *(np.frombuffer(k, np.uint64) for k in heard["keys"])]))
        if not len(wanted):
            return pd.DataFrame({c: [] for c in columns})
        found = []
        for i, p in own:
            near = np.minimum(np.searchsorted(wanted, p.key), len(wanted) - 1)
            some = np.flatnonzero(wanted[near] == p.key)
            rows = p.phrases(some)
            found.append((digests(rows), p.key[some], i[p.doc[some]], rows))
        digest, key, doc, rows = (np.concatenate(x) for x in zip(*found, strict=True))
        if not len(digest):
            return pd.DataFrame({c: [] for c in columns})
        order = np.lexsort((doc, digest))
        digest, key, doc, rows = digest[order], key[order], doc[order], rows[order]
        at = np.flatnonzero(np.append(True, digest[1:] != digest[:-1]))
        last = doc[np.append(at[1:], len(doc)) - 1]
        key, doc, rows = key[at], doc[at], rows[at]
        met = np.unique(np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(k, np.uint64) for k in heard["keys"])]))
        hot = np.isin(key, np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(k, np.uint64) for k in heard["hot"])]))
        _, number, n = np.unique(key, return_inverse=True, return_counts=True)
        hot |= (n[number] > hot_phrases) & ~np.isin(key, met)  # no other block has the key
        out = ranges(dealt(key[~hot]), block["block"].iloc[0], rows[~hot], doc[~hot], last[~hot])
        if hot.any():
            name, own_key, text, doc, last = strings(rows[hot], key[hot], doc[hot], last[hot])
            out = pd.concat([out, ranges(n_buckets + dealt(name), block["block"].iloc[0], text, doc, last, own_key)])
        return out

    def ranges(bucket: np.ndarray, block: int, rows: np.ndarray, doc: np.ndarray, last: np.ndarray, key: np.ndarray | None = None) -> pd.DataFrame:
        order = np.argsort(bucket, kind="stable")
        bucket, doc, last, rows = bucket[order], doc[order], last[order], rows[order]
        at = np.flatnonzero(np.diff(bucket, prepend=-1))
        cuts = list(zip(at, np.append(at[1:], len(bucket))[: len(at)], strict=True))
        return pd.DataFrame({
            "bucket": bucket[at], "block": np.full(len(at), block, np.int32), "phrases": [packed(rows[s:e]) for s, e in cuts],
            "first": [packed(doc[s:e]) for s, e in cuts], "last": [packed(last[s:e]) for s, e in cuts],
            "keys": [None if key is None else packed(key[order][s:e]) for s, e in cuts], "n": np.array([e - s for s, e in cuts], np.int64),
        })

    def equal_strings(sent: pd.DataFrame) -> pd.DataFrame:
        """Answers for strings of frequent triggers: their names, first documents and the triggers at which the block has them."""
        parts = [unpacked(x, np.uint8).reshape(-1, LENGTH) for x in sent["phrases"]]
        text = np.concatenate(parts)
        sender = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        first, last = (np.concatenate([unpacked(x, np.int64) for x in sent[c]]) for c in ("first", "last"))
        key = np.concatenate([unpacked(x, np.uint64) for x in sent["keys"]])
        _, number = np.unique(np.ascontiguousarray(text).view(np.dtype((np.void, LENGTH))).ravel(), return_inverse=True)
        number = number.ravel()
        least = np.full(int(number.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, number, first)
        useful = least[number] < last
        name = string_hashes(text)
        out = {"block": [], "digest": [], "place": [], "doc": [], "keys": []}
        for s in np.unique(sender[useful]):
            own = useful & (sender == s)
            out["block"].append(sent["block"].iloc[s])
            out["digest"].append(name[own].tobytes())
            out["place"].append(b"")
            out["doc"].append(least[number[own]].tobytes())
            out["keys"].append(np.unique(key[own]).tobytes())
        return pd.DataFrame(out)

    def sorted_suffixes(sent: pd.DataFrame) -> pd.DataFrame:
        if sent["bucket"].iloc[0] >= n_buckets:
            return equal_strings(sent)
        parts = [unpacked(x, np.uint8).reshape(-1, WIDTH + 4) for x in sent["phrases"]]
        rows = np.concatenate(parts)
        sender = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        first = np.concatenate([unpacked(x, np.int64) for x in sent["first"]])
        last = np.concatenate([unpacked(x, np.int64) for x in sent["last"]])
        digest = digests(rows)
        # the dictionary holds a phrase once; its exact bytes decide, so rows are compared where digests meet
        _, where, number = np.unique(rows.view(np.dtype((np.void, WIDTH + 4))).ravel(), return_index=True, return_inverse=True)
        number = number.ravel()
        least = np.full(len(where), np.iinfo(np.int64).max)
        np.minimum.at(least, number, first)
        firsts = first_documents(rows[where], least)[number]
        start = np.ones(firsts.shape, bool)
        start[:, 1:] = firsts[:, 1:] != firsts[:, :-1]
        useful = start & ((firsts < last[:, None]) | np.concatenate([np.zeros((len(firsts), 1), bool), firsts[:, :-1] < last[:, None]], axis=1))
        entry, place = np.nonzero(useful)
        out = {"block": [], "digest": [], "place": [], "doc": [], "keys": []}
        own, cut = np.unique(sender[entry], return_index=True)
        for s, a, b in zip(own, cut, np.append(cut[1:], len(entry))[: len(own)], strict=True):
            out["block"].append(sent["block"].iloc[s])
            out["digest"].append(digest[entry[a:b]].tobytes())
            out["place"].append(place[a:b].astype(np.uint8).tobytes())
            out["doc"].append(firsts[entry[a:b], place[a:b]].tobytes())
            out["keys"].append(None)
        return pd.DataFrame(out)

    def marked(block: pd.DataFrame, heard: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"i": [], "n_bytes": [], "spans": [], "kept": []}
        named, heard = heard[heard["keys"].notna()], heard[heard["keys"].isna()]
        hot, name, earliest = (np.concatenate([np.empty(0, t), *(np.frombuffer(x, t) for x in named[c])]) for c, t in (("keys", np.uint64), ("digest", np.uint64), ("doc", np.int64)))
        order = np.argsort(name)
        hot, name, earliest = np.unique(hot), name[order], earliest[order]
        digest = np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(x, np.uint64) for x in heard["digest"])])
        place = np.concatenate([np.empty(0, np.uint8), *(np.frombuffer(x, np.uint8) for x in heard["place"])]).astype(np.int64)
        first = np.concatenate([np.empty(0, np.int64), *(np.frombuffer(x, np.int64) for x in heard["doc"])])
        order = np.lexsort((first, place, digest))
        digest, place, first = digest[order], place[order], first[order]
        # a run of places lasts until the phrase's next run
        stop = np.append(place[1:], 0)
        stop[np.append(digest[1:] != digest[:-1], True)[: len(stop)]] = REACH + 1
        for rows, p in pieces(block) if len(block) else ():
            ids = block["i"].to_numpy()[rows]
            gone = np.zeros(len(p.buffer) + 1, np.int64)
            if len(digest):
                every = np.concatenate([digests(p.phrases(np.arange(s, min(s + 50_000, len(p.at))))) for s in range(0, len(p.at), 50_000)] or [np.empty(0, np.uint64)])
                low = np.searchsorted(digest, every, "left")
                n = np.searchsorted(digest, every, "right") - low
                trigger = np.repeat(np.arange(len(every)), n)
                run = np.repeat(low, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                earlier = first[run] < ids[p.doc[trigger]]
                trigger, run = trigger[earlier], run[earlier]
                begin = p.at[trigger] - REACH + place[run]
                end = p.at[trigger] - REACH + stop[run] - 1 + LENGTH
                np.add.at(gone, begin, 1)
                np.add.at(gone, end, -1)
            held = np.flatnonzero(np.isin(p.key, hot)) if len(name) else hot[:0]
            for s in range(0, len(held), 20_000):
                some = held[s : s + 20_000]
                entry, at, text = fitting(p.phrases(some))
                own = string_hashes(text)
                near = np.minimum(np.searchsorted(name, own), len(name) - 1)
                take = (name[near] == own) & (earliest[near] < ids[p.doc[some[entry]]])
                begin = p.at[some[entry]][take] - REACH + at[take]
                np.add.at(gone, begin, 1)
                np.add.at(gone, begin + LENGTH, -1)
            removed = np.cumsum(gone)[:-1] > 0
            for k, (i, s, size) in enumerate(zip(ids, p.starts, p.sizes, strict=True)):
                own = removed[s : s + size]
                edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                out["i"].append(i)
                out["n_bytes"].append(size)
                out["spans"].append(edges.tolist())
                out["kept"].append(p.buffer[s : s + size][~own].tobytes())
        return pd.DataFrame(out)

    sent = blocks.groupBy("block").applyInPandas(triggers, "bucket int, block int, keys binary, counts binary")
    heard = sent.groupBy("bucket").applyInPandas(meeting, "block int, keys binary, hot binary")
    phrases = blocks.groupBy("block").cogroup(heard.groupBy("block")).applyInPandas(dictionary, "bucket int, block int, phrases binary, first binary, last binary, keys binary, n long")
    firsts = phrases.groupBy("bucket").applyInPandas(sorted_suffixes, "block int, digest binary, place binary, doc binary, keys binary")
    result = blocks.groupBy("block").cogroup(firsts.groupBy("block")).applyInPandas(marked, "i long, n_bytes long, spans array<long>, kept binary")
    without_id = base.where("i is null").select("i", F.octet_length("t").cast("long").alias("n_bytes"), F.array().cast("array<long>").alias("spans"), F.col("t").alias("kept"))
    return result.unionByName(without_id).withColumnRenamed("i", id_col), phrases.select("bucket", "block", "n")


def op2_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removed bytes and runs of every document, with the digest of what is left."""
    out = repeated_spans(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"), (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op2_repeated_substrings": op2_repeated_substrings}
ORACLES: dict[str, str] = {}
