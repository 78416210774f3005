"""Many patterns in many lines: which names stand in which line, as substrings.

A trie automaton with failure links finds all names in one pass over a line, whatever words the names share. The names are cut
into shards of bounded size and the lines into parts; every part meets every shard in a task of its own, where the shard's
automaton is built once. So a task holds one shard and one part, and no word that many names or lines share gathers rows.
The work is lines times shards; a shard takes a hundred thousand names, so most tables have one.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names of an automaton.
SHARD_NAMES = 100_000
#: Lines that meet an automaton at once.
PART_LINES = 200_000


def names_in_lines(lines: DataFrame, line_id: str, line: str, names: DataFrame, name: str, shard_names: int = SHARD_NAMES, part_lines: int = PART_LINES) -> DataFrame:
    """(line id, name) for every distinct name that is a substring of a line, once a line row. Null or empty names and null lines take no part."""
    wanted = names.select(F.col(name).alias("_name")).where("_name <> ''").distinct()
    shards = max(1, -(-wanted.count() // shard_names))
    text = lines.select(F.col(line_id).alias("_id"), F.col(line).alias("_line")).where("_line is not null")
    parts = max(1, -(-text.count() // part_lines))
    dealt_lines = text.select("_id", "_line", F.pmod(F.xxhash64("_id", "_line"), F.lit(parts)).alias("_part"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_shard"))
    dealt_names = wanted.select("_name", F.pmod(F.xxhash64("_name"), F.lit(shards)).cast("int").alias("_shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("_part"))
    kind = lines.schema[line_id].dataType.simpleString()

    def found(own_lines: pd.DataFrame, own_names: pd.DataFrame) -> pd.DataFrame:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for n in own_names["_name"]:
            automaton.add_word(n, n)
        automaton.make_automaton()
        out: list[tuple] = []
        if len(automaton):
            for i, t in zip(own_lines["_id"], own_lines["_line"], strict=True):
                out += [(i, n) for n in {n for _, n in automaton.iter(t)}]
        return pd.DataFrame(out, columns=["id", "name"]).astype({"id": own_lines["_id"].dtype})

    pairs = dealt_lines.groupBy("_part", "_shard").cogroup(dealt_names.groupBy("_part", "_shard")).applyInPandas(found, f"id {kind}, name string")
    return pairs.select(F.col("id").alias(line_id), F.col("name").alias(name))
