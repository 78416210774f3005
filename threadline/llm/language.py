"""Language identification by rank-order n-gram profiles and the out-of-place distance.

A profile is the ranking of the commonest n-grams (one to three letters, with word bounds) of a
language. A document gets the same ranking from its whole text; the distance to a language is the sum
over the document's ranked n-grams of the difference in rank, or of the profile length for an n-gram
that the profile lacks. The nearest language wins, ties by name.

Profiles of the query come from a bounded sample: of each language the documents whose id hash falls below
``sample / count``, so about ``sample`` of them at any size of the table. The counts by language go to the driver
(a row a language, as the profiles do), so the sample is a filter and no text is dealt by its language.

The pipeline stage learns from all documents. It keeps one if its distance to the nearest profile, as a share of the largest possible,
is not beyond a limit: halfway between what all but one in a hundred of the documents learned from reach and 1, which is the distance
of a text that shares no n-gram with any language.

Cases: null texts and texts without a letter are ``und`` with score 0, as is every text when nothing
was learned; null languages are not learned from; repeated rows are scored alike; extra columns are
not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, columns, shared_folder, table

PROFILE = 400
SAMPLE = 2000
NON_LETTER = re.compile(r"[\W\d_]+")
#: Code points that are word signs but neither letters nor decimal digits, such as fractions and circled numbers.
NUMBERS = np.array([c for c in range(0x110000) if chr(c).isalnum() and not chr(c).isalpha() and not chr(c).isdecimal()])
_IS_NUMBER = np.zeros(0x110000, bool)
_IS_NUMBER[NUMBERS] = True
_EDGE = ord("_")


def held_out(id_col: str, modulus: int, rest: int) -> Column:
    """Whether the checksum of the id as text has this remainder; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % modulus) == rest


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text as 63-bit keys, with counts."""
    letters = NON_LETTER.sub("_", (text or "").lower())
    if not letters.isascii() and _IS_NUMBER[np.frombuffer(letters.encode("utf-32-le", "replace"), np.uint32)].any():
        letters = "_".join(x for x in "".join("_" if _IS_NUMBER[ord(c)] else c for c in letters).split("_") if x)
    letters = letters.strip("_")
    if not letters:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    c = np.frombuffer(f"_{letters}_".encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    one = c[c != _EDGE]
    two = c[:-1] | c[1:] << 21
    three = (two[:-1] | c[2:] << 42)[c[1:-1] != _EDGE]
    return np.unique(np.concatenate([one, two, three]), return_counts=True)


def ranked(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The commonest keys, most frequent first, ties by key."""
    if len(keys) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        few = counts >= least
        keys, counts = keys[few], counts[few]
    return keys[np.lexsort((keys, -counts))][:size]


class Profiles:
    """Ranks of all profile n-grams for all languages, as one matrix."""

    def __init__(self, rankings: dict[str, list[int]], size: int = PROFILE) -> None:
        self.size = size
        self.names = sorted(rankings)
        self.keys = np.array(sorted({k for r in rankings.values() for k in r}), np.int64)
        self.ranks = np.full((len(self.keys) + 1, len(self.names)), -1, np.int32)  # -1: not in the profile
        for j, name in enumerate(self.names):
            grams = np.array(rankings[name], np.int64)
            self.ranks[np.searchsorted(self.keys, grams), j] = np.arange(len(grams))

    def distances(self, text: str | None) -> tuple[np.ndarray, int]:
        """Out-of-place distance to each language, and the largest that is possible (0: no letter)."""
        grams = ranked(*gram_counts(text), self.size)
        if not len(grams) or not self.names:
            return np.empty(0), 0
        at = np.searchsorted(self.keys, grams)
        known = (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == grams)
        ranks = self.ranks[np.where(known, at, len(self.keys))]
        return np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(grams))[:, None])).sum(axis=0), self.size * len(grams)

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """Language, score (share of the two nearest distances that the second holds) and nearest distance as a share of the largest."""
        away, most = self.distances(text)
        if not most:
            return "und", 0.0, 1.0
        best = int(np.argmin(away))
        near = float(away[best]) / most
        if len(away) == 1:
            return self.names[best], 1.0 - near, near
        second = float(np.partition(away, 1)[1])
        both = second + float(away[best])
        return self.names[best], second / both if both else 1.0, near


def drawn(docs: DataFrame, lang_col: str, id_col: str, sample: int) -> DataFrame:
    """About ``sample`` documents of each non-null language, by the hash of the id."""
    labelled = docs.where(F.col(lang_col).isNotNull())
    counts = labelled.groupBy(F.col(lang_col).alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row a language
    if not counts:
        return labelled
    share = F.create_map(*[x for r in counts for x in (F.lit(r["l"]), F.lit(float(sample) / r["n"]))])
    return labelled.where(F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1_000_000)) / 1e6 < F.try_element_at(share, F.col(lang_col)))


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample: int | None = SAMPLE, size: int = PROFILE) -> Profiles:
    """Profiles of all non-null languages of some documents; without ``sample`` from every one of them."""
    chosen = docs.where(F.col(lang_col).isNotNull()) if sample is None else drawn(docs, lang_col, id_col, sample)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[str, dict[int, int]] = defaultdict(lambda: defaultdict(int))
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                own = found[lang]
                for k, n in zip(*(x.tolist() for x in gram_counts(text)), strict=True):
                    own[k] += n
            for lang, own in found.items():
                yield pd.DataFrame({"lang": lang, "gram": list(own), "n": list(own.values())})

    grams = chosen.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInPandas(count, "lang string, gram long, n long")
    grams = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = grams.withColumn("r", F.row_number().over(order)).where(F.col("r") <= size).select("lang", "gram", "r")
    rankings: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for lang, gram, r in top.collect():  # profile length times languages
        rankings[lang].append((r, gram))
    return Profiles({lang: [g for _, g in sorted(rs)] for lang, rs in rankings.items()}, size)


def identify(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``distance`` (to the nearest profile, 0 to 1); columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    @F.pandas_udf("lang_pred string, score double, distance double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        own = shared.value
        return pd.DataFrame([own.judge(t) for t in texts], columns=["lang_pred", "score", "distance"])

    # the documents are packed, so no column of theirs meets one of ours; a text is judged once, whatever is asked of the result
    once = judge.asNondeterministic()
    packed = docs.select(F.struct(*columns(docs)).alias("row"), once(F.col(text_col)).alias("judged"))
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("lang_pred", "score", "distance")]
    return packed.select(*kept, "judged.*")


def distance_limit(judged: DataFrame) -> float:
    """Distance beyond which a text is in no learned language, from all of the judged documents that the profiles come from.

    The distance that 99 in 100 reach is exact: counts by ten-thousandth show in which of these it lies, and its distances, few in
    number, which it is.
    """
    judged = judged.where("lang_pred <> 'und'").withColumn("_bin", F.floor(F.col("distance") * 10_000).cast("int"))
    bins = sorted(tuple(r) for r in judged.groupBy("_bin").agg(F.count(F.lit(1)).alias("n")).collect())
    if not bins:
        return 1.0
    wanted = -(-99 * sum(n for _, n in bins) // 100)
    for place, n in bins:
        if wanted <= n:
            break
        wanted -= n
    own = judged.where(F.col("_bin") == place).groupBy("distance").agg(F.count(F.lit(1)).alias("n")).orderBy("distance")
    for usual, n in own.collect():
        if wanted <= n:
            break
        wanted -= n
    return (1.0 + usual) / 2


def op8_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned without the held-out quarter."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out("doc_id", 4, 2))
    profiles = learn(docs.where(~F.col("held_out")))
    return identify(docs.select("doc_id", "text", "held_out"), profiles).select("doc_id", "held_out", "lang_pred", "score")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents in a language; texts without a letter and those far from every profile go.

    Where nothing could be learned only texts without a letter go. Null texts have no language; ids may be null or repeated.
    """
    docs = docs.select(*DOCUMENT_COLUMNS)
    profiles = learn(docs.where(~held_out("doc_id", 4, 2)), sample=None)
    if not profiles.names:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    folder = f"{shared_folder(spark)}/judged-{uuid.uuid4().hex}"
    identify(docs, profiles).write.parquet(folder)  # a text is judged once, for the limit and for the result
    judged = spark.read.parquet(folder)
    limit = distance_limit(judged.where(~held_out("doc_id", 4, 2) & F.col("lang").isNotNull()))
    return judged.where((F.col("lang_pred") != "und") & (F.col("distance") <= limit)).select(*DOCUMENT_COLUMNS)


QUERIES = {"op8_language_profiles": op8_language_profiles}
ORACLES: dict[str, str] = {}
