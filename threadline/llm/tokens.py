"""Words and word shingles of texts, in NumPy, for use inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd

WORD = re.compile(r"\w+")
#: Texts are handled in pieces of about so many characters, so that arrays stay small.
PIECE_CHARS = 1_000_000
_MIX_1 = np.uint64(0x9E3779B97F4A7C15)
_MIX_2 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_3 = np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        x = x + _MIX_1
        x = (x ^ (x >> np.uint64(30))) * _MIX_2
        x = (x ^ (x >> np.uint64(27))) * _MIX_3
        return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[str]:
    """Lower-case words; a text without any, but with other signs, yields its blank-separated pieces."""
    if not text:
        return []
    lowered = text.lower()
    return WORD.findall(lowered) or lowered.split()


def pieces(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Slices of a list of texts of about ``PIECE_CHARS`` characters each."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= PIECE_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def shingles(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all word n-grams of some texts, and the index of the text of each.

    A text of fewer than n words has one shingle of all its words; one without words has none.
    """
    tokens = [words(t) for t in texts]
    counts = np.array([len(t) for t in tokens], dtype=np.int64)
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    flat = np.empty(total, dtype=object)
    flat[:] = [w for t in tokens for w in t]
    h = pd.util.hash_array(flat, categorize=False)
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.cumsum(counts) - counts
    place = np.arange(total) - first[owner]
    out = np.zeros(total, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            shifted = np.zeros(total, np.uint64)
            shifted[: max(total - k, 0)] = h[k:]
            inside = place + k < counts[owner]
            out = (out + np.where(inside, shifted, np.uint64(k))) * _MIX_2 + np.uint64(1)
            out ^= out >> np.uint64(29)
    starts = (place + n <= counts[owner]) | (place == 0)
    return mixed(out[starts]), owner[starts]


def bags(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles with their multiplicity: (text index, hash, count), ordered by text and hash."""
    h, owner = shingles(texts, n)
    if not len(h):
        return owner, h, np.empty(0, np.int64)
    h = h.copy()
    ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
    for s, e in zip(ends - np.diff(ends, prepend=0), ends, strict=True):
        h[s:e].sort()  # the shingles of a text stand together
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], h[at], np.diff(np.append(at, len(h)))
