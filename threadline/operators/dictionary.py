"""Token normalisation by dictionary tables of any size.

The cascade is decided once a distinct token, by two joins with the dictionary (the token, and the token with long runs of one
letter reduced), and the answers are written back to the places of the tokens. Common tokens are where rows would meet: the
``FREQUENT`` commonest ones, a bounded table, go to all tasks with their answer. Only the places of other tokens, each of few
places, are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadline.functions.text import reduce_elongated
from threadline.operators.features import gram_totals, materialised, written

#: Distinct tokens that go to all tasks with their answer.
FREQUENT = 100_000


def dictionary(domain: DataFrame, general: DataFrame, protected: DataFrame) -> DataFrame:
    """(word, domain, general, protected) of (word, replacement) tables and a (word) table: one row a word, of several replacements the least.

    Protected words have no entry in the other two, as the cascade never asks for it.
    """
    parts = [
        domain.select("word", F.col("replacement").alias("domain"), F.lit(None).cast("string").alias("general"), F.lit(False).alias("protected")),
        general.select("word", F.lit(None).cast("string").alias("domain"), F.col("replacement").alias("general"), F.lit(False).alias("protected")),
        protected.select("word", F.lit(None).cast("string").alias("domain"), F.lit(None).cast("string").alias("general"), F.lit(True).alias("protected")),
    ]
    words = parts[0].unionByName(parts[1]).unionByName(parts[2]).where("word is not null").groupBy("word").agg(F.min("domain").alias("domain"), F.min("general").alias("general"), F.max("protected").alias("protected"))
    return words.select("word", *[F.when(~F.col("protected"), F.col(c)).alias(c) for c in ("domain", "general")], "protected")


def answers(words: DataFrame, table: DataFrame) -> DataFrame:
    """Add ``new`` to distinct (token) rows: the token if protected; its domain word; its reduced form if that is protected; domain,
    then general word of the reduced form; general word of the token; the reduced form."""
    named = lambda p: table.select(F.col("word").alias(f"{p}_word"), *[F.col(c).alias(f"{p}_{c}") for c in ("domain", "general", "protected")])
    both = words.withColumn("short", reduce_elongated(F.col("token")))
    both = both.join(named("t"), F.col("token") == F.col("t_word"), "left").join(named("s"), F.col("short") == F.col("s_word"), "left")
    new = F.coalesce(F.when(F.col("t_protected"), F.col("token")), F.col("t_domain"), F.when(F.col("s_protected"), F.col("short")), F.col("s_domain"), F.col("s_general"), F.col("t_general"), F.col("short"))
    return both.select(*words.columns, new.alias("new"))


def normalised_by_table(rows: DataFrame, id_col: str, cleaned: str, table: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """(id, normalised, changed): the tokens of each cleaned text normalised, and how many of them changed; both null for a null text.

    Ids are unique, ``table`` is a ``dictionary``, and ``rows`` are read twice, so they should be written. Texts are normalised where they
    lie; only places of tokens that are not among the common ones are dealt, and only texts with such places are met with the answers.
    """
    words = gram_totals(rows, F.col(cleaned), (1,)).select(F.col("term").alias("token"), "n")
    known = materialised(answers(words, table))
    common = known.orderBy(F.desc("n"), "token").limit(frequent).select("token", "new")
    held = rows.sparkSession.sparkContext.broadcast(dict(map(tuple, common.collect())))  # no more rows than the parameter

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = held.value
        for batch in batches:
            out = []
            for text in batch["_c"]:
                if text is None:
                    out.append((None, None, [], []))
                    continue
                own = [t for t in text.split(" ") if t]
                new = [answer.get(t) for t in own]
                places = [k for k, n in enumerate(new) if n is None]
                changed = sum(n is not None and n != t for n, t in zip(new, own, strict=True))
                out.append((" ".join(t if n is None else n for n, t in zip(new, own, strict=True)), changed, places, [own[k] for k in places]))
            made = pd.DataFrame(out, columns=["normalised", "_here", "places", "tokens"])
            made["_here"] = made["_here"].astype("Int64")
            yield pd.concat([batch[[id_col]].reset_index(drop=True), made], axis=1)

    shape = f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, normalised string, _here long, places array<int>, tokens array<string>"
    here = rows.select(id_col, F.col(cleaned).alias("_c")).mapInPandas(apply, shape)
    if known.count() <= frequent:
        return here.select(id_col, "normalised", F.col("_here").alias("changed"))
    here = written(here)
    rare = known.join(common.select("token"), "token", "left_anti").select("token", "new")
    away = here.select(F.col(id_col).alias("_id"), F.explode(F.arrays_zip("places", "tokens")).alias("p")).select("_id", F.col("p.places").alias("place"), F.col("p.tokens").alias("token")).join(rare, "token")
    away = away.groupBy("_id").agg(F.map_from_entries(F.collect_list(F.struct("place", "new"))).alias("_new"), F.count_if(F.col("new") != F.col("token")).alias("_more"))
    open_ = here.where(F.size("places") > 0).join(away, F.col(id_col) == F.col("_id"))
    text = F.array_join(F.transform(F.split("normalised", " "), lambda t, k: F.coalesce(F.try_element_at("_new", k), t)), " ")
    done = here.where(F.size("places") == 0).select(id_col, "normalised", F.col("_here").alias("changed"))
    return done.unionByName(open_.select(id_col, text.alias("normalised"), (F.col("_here") + F.col("_more")).alias("changed")))


def coverage(normalised: DataFrame) -> DataFrame:
    """One row: words changed, texts with a change, and their percentage of all texts."""
    some = F.count_if(F.col("changed") > 0)
    return normalised.agg(F.sum("changed").alias("words_changed"), some.alias("texts_changed"), (some * 100.0 / F.count(F.lit(1))).alias("percent"))
