"""Ordered scans over long sources, spread over tasks.

A window over a source puts the whole source in one task. Here a source is cut into slices that follow its order (a day, a
number of lines, a byte range of a file). What a row needs from earlier rows is put together from two parts: a window over
the rows of its slice, and what the slice carries in. Carries are summaries of slices (a sum, the last or first value that is
not null), one row a slice, and composed in order by a window over those summaries alone. A source of half the table is so
spread over as many tasks as it has slices, and rows are exchanged once: windows, summaries and carries all go by (source, slice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadline.dims import Taxonomy
from threadline.functions.text import first_category, letters_suffix
from threadline.operators.chat import micros

SLICE = "_slice"


def carried(rows: DataFrame, keys: list[str], order: list[str], last: dict[str, Column] | None = None, sums: dict[str, Column] | None = None, first: dict[str, Column] | None = None) -> DataFrame:
    """Rows (with a column ``_slice`` that never falls in the order) and, by name: ``last`` the last value that is not null before the row,
    ``sums`` the sum up to and with the row, ``first`` the first value that is not null in the whole source."""
    last, sums, first = last or {}, sums or {}, first or {}
    given = {f"_v{k}": c for k, c in enumerate([*last.values(), *sums.values(), *first.values()])}
    held = dict(zip([*last, *sums, *first], given, strict=True))
    rows = rows.withColumns(given)
    place = F.struct(*order)
    aggregates = [F.max_by(held[n], F.when(F.col(held[n]).isNotNull(), place)).alias(f"_c_{n}") for n in last]
    aggregates += [F.sum(held[n]).alias(f"_c_{n}") for n in sums]
    aggregates += [F.min_by(held[n], F.when(F.col(held[n]).isNotNull(), place)).alias(f"_c_{n}") for n in first]
    slices = rows.groupBy(*keys, SLICE).agg(*aggregates)
    source = Window.partitionBy(*keys).orderBy(SLICE)
    before, whole = source.rowsBetween(Window.unboundedPreceding, -1), source.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carries = [F.last(f"_c_{n}", ignorenulls=True).over(before).alias(f"_in_{n}") for n in last]
    carries += [F.coalesce(F.sum(f"_c_{n}").over(before), F.lit(0)).alias(f"_in_{n}") for n in sums]
    carries += [F.first(f"_c_{n}", ignorenulls=True).over(whole).alias(f"_in_{n}") for n in first]
    composed = slices.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(SLICE).alias("_s"), *carries)
    own = Window.partitionBy(*keys, SLICE).orderBy(*order)
    ahead, upto = own.rowsBetween(Window.unboundedPreceding, -1), own.rowsBetween(Window.unboundedPreceding, 0)
    local = {f"_l_{n}": F.last(held[n], ignorenulls=True).over(ahead) for n in last} | {f"_l_{n}": F.sum(held[n]).over(upto) for n in sums}
    rows = rows.withColumns(local) if local else rows
    on = F.col(SLICE).eqNullSafe(F.col("_s"))
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = rows.join(composed, on)
    out = out.withColumns({n: F.coalesce(f"_l_{n}", f"_in_{n}") for n in last} | {n: F.coalesce(F.col(f"_l_{n}"), F.lit(0)) + F.col(f"_in_{n}") for n in sums} | {n: F.col(f"_in_{n}") for n in first})
    return out.drop("_s", *given, *[f"_k{i}" for i in range(len(keys))], *[f"_l_{n}" for n in held], *[f"_in_{n}" for n in held])


def sessions_by_slice(rows: DataFrame, keys: list[str], order: list[str], time_slice: Column, hours: float = 4.0, ts: str = "ts", counts: Column | None = None) -> DataFrame:
    """``chat.sessionise`` with the rows of a source spread over slices; ``time_slice`` must not fall in the order (null counts as the least)."""
    counts = F.lit(True) if counts is None else counts
    cut = carried(rows.withColumn(SLICE, time_slice), keys, order, last={"_prev": F.when(counts, F.col(ts))})
    starts = counts & (micros(F.col(ts), F.col("_prev")) >= int(hours * 3_600_000_000))
    out = carried(cut.withColumn("_starts", F.when(starts, 1).otherwise(0)), keys, order, sums={"session_no": F.col("_starts")})
    return out.withColumn("session_no", (F.col("session_no") + 1).cast("long")).drop("_prev", "_starts", SLICE)


def topics_by_slice(rows: DataFrame, keys: list[str], order: list[str], place_slice: Column, taxonomy: Taxonomy, role: str = "role", text: str = "text") -> DataFrame:
    """``chat.split_topics`` with the rows of a source spread over slices.

    The category of a segment is the one that began it, so it is the last one named up to the row; before the first, the first.
    """
    own = F.when(F.col(role) == "CLIENT", first_category(F.col(text), taxonomy))
    seen = rows.withColumn(SLICE, place_slice).withColumn("_own", own)
    held = carried(seen, keys, order, last={"_held": F.col("_own")}, first={"_first": F.col("_own")})
    out = carried(held.withColumn("_cut", F.when(F.col("_own") != F.col("_held"), 1).otherwise(0)), keys, order, sums={"segment": F.col("_cut")})
    out = out.withColumn("segment", F.col("segment").cast("long")).withColumn("category", F.coalesce("_own", "_held", "_first", F.lit(taxonomy.fallback)))
    return out.withColumn("suffix", letters_suffix(F.col("segment"))).drop("_own", "_held", "_first", "_cut", SLICE)
