"""Reporting: counts, rates, breakdowns, series, top lists and pages on a master table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadline.functions.text import remote_rate


def handling_counts(handling: str = "handling") -> list[Column]:
    """Aggregates: total, remote, non_remote, unknown."""
    h = F.col(handling)
    return [F.count(F.lit(1)).alias("total"), F.count_if(h == "REMOTE").alias("remote"), F.count_if(h == "NON_REMOTE").alias("non_remote"), F.count_if(h.isNull() | ~h.isin("REMOTE", "NON_REMOTE")).alias("unknown")]


def top_value(rows: DataFrame, keys: list[str], value: str, name: str = "top_category") -> DataFrame:
    """Commonest value per key, ties by name; two small aggregations, no window."""
    counts = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v")))
    return counts.where(F.col(value).isNotNull()).groupBy(*keys).agg(best.alias("_b")).select(*keys, F.col("_b.v").alias(name), (-F.col("_b.n")).alias(f"{name}_count"))


def breakdown(rows: DataFrame, key: str, handling: str = "handling", share: bool = False) -> DataFrame:
    """Counts and remote rate by a key, with its share of all rows if asked."""
    out = rows.groupBy(key).agg(*handling_counts(handling)).withColumn("rate", remote_rate(F.col("remote"), F.col("non_remote")))
    if share:  # the window sees one row a key
        out = out.withColumn("share", F.col("total") * 100.0 / F.sum("total").over(Window.partitionBy(F.lit(1))))
    return out


def overview(rows: DataFrame, conversation: str, category: str, ts: str, handling: str = "handling") -> DataFrame:
    """One row of totals with rate, top category and period."""
    one = rows.agg(*handling_counts(handling), F.countDistinct(conversation).alias("conversations"), F.min(F.to_date(ts)).cast("string").alias("first_day"), F.max(F.to_date(ts)).cast("string").alias("last_day"))
    top = top_value(rows.withColumn("_k", F.lit(1)), ["_k"], category)
    return one.withColumn("_k", F.lit(1)).join(top, "_k", "left").withColumn("rate", remote_rate(F.col("remote"), F.col("non_remote"))).drop("_k")


def time_series(rows: DataFrame, period: str, category: str, ts: str, handling: str = "handling") -> DataFrame:
    """Counts, rate and top category by day, week (Monday), month or year; rows without a time stay out."""
    shape = {"day": "yyyy-MM-dd", "week": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}[period]
    timed = rows.where(F.col(ts).isNotNull()).withColumn("period", F.date_format(F.date_trunc(period, F.col(ts).cast("timestamp")), shape))
    counts = timed.groupBy("period").agg(*handling_counts(handling)).withColumn("rate", remote_rate(F.col("remote"), F.col("non_remote")))
    return counts.join(top_value(timed, ["period"], category), "period", "left")


def period_change(series: DataFrame) -> DataFrame:
    """Each period with the one before and the relative change; a series has a row a period."""
    w = Window.partitionBy(F.lit(1)).orderBy("period")
    return series.select("period", "total", F.lag("total").over(w).alias("previous")).withColumn("change", F.try_divide((F.col("total") - F.col("previous")) * 1.0, F.col("previous")))


def concentration(totals: DataFrame, total: str = "total", key: str = "customer") -> DataFrame:
    """Mean per customer, shares of the top 10 and 25 and number of customers with one row; from one row a customer."""
    best = totals.orderBy(F.desc(total), key).limit(25).select(F.col(total).alias("n"), F.row_number().over(Window.orderBy(F.desc(total), key)).alias("r"))  # 25 rows
    tops = best.agg(F.sum(F.when(F.col("r") <= 10, F.col("n"))).alias("t10"), F.sum("n").alias("t25"))
    one = totals.agg(F.sum(total).alias("all"), F.count(F.lit(1)).alias("k"), F.count_if(F.col(total) == 1).alias("single")).crossJoin(tops)
    return one.select((F.col("all") * 1.0 / F.col("k")).alias("mean_rows"), (F.col("t10") * 100.0 / F.col("all")).alias("top10_share"), (F.col("t25") * 100.0 / F.col("all")).alias("top25_share"), "single")


def in_range(rows: DataFrame, ts: str, start: str | None, end: str | None) -> DataFrame:
    """Rows of an inclusive range of days; a start after the end is an error, and without bounds all rows stay."""
    if start and end and start > end:
        raise ValueError("start lies after end")
    if start:
        rows = rows.where(F.col(ts) >= F.lit(start).cast("date").cast("timestamp_ntz"))
    return rows.where(F.col(ts) < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")) if end else rows


def matching(rows: DataFrame, query: str | None = None, columns: tuple[str, ...] = (), **equal: object) -> DataFrame:
    """Rows that hold a text (literally, any case) in one of some columns and equal all given values."""
    if query:
        rows = rows.where(reduce(lambda a, b: a | b, [F.lower(F.coalesce(F.col(c), F.lit(""))).contains(query.lower()) for c in columns]))
    for column, value in equal.items():
        rows = rows.where(F.col(column) == F.lit(value))
    return rows


def matching_any(rows: DataFrame, query: str | None = None, columns: tuple[str, ...] = (), **any_of: tuple[object, tuple[str, ...]]) -> DataFrame:
    """Rows that hold a text in one of some columns and, for each named filter (value, columns), have the value in one of its columns.

    Texts are compared without blanks around the value; a filter whose name ends in ``_upper`` compares upper case. A null value filters nothing.
    """
    rows = matching(rows, query, columns)
    for name, (value, own) in any_of.items():
        if value is not None:
            upper = name.endswith("_upper")
            wanted = str(value).strip().upper() if upper else str(value).strip()
            rows = rows.where(reduce(lambda a, b: a | b, [F.coalesce((F.upper(c) if upper else F.col(c)) == wanted, F.lit(False)) for c in own]))
    return rows


def page(rows: DataFrame, order: list, number: int = 1, size: int = 50) -> DataFrame:
    """A page of at most 200 rows in a stated order; a top-k of offset plus size, not a full sort."""
    if number < 1 or not 1 <= size <= 200:
        raise ValueError("page from 1, size from 1 to 200")
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def page_with_totals(rows: DataFrame, order: list, number: int = 1, size: int = 50) -> DataFrame:
    """A page with ``total`` rows and ``pages`` of all; the count is one row."""
    totals = rows.agg(F.count(F.lit(1)).alias("total")).withColumn("pages", F.ceil(F.col("total") / size))
    return page(rows, order, number, size).crossJoin(F.broadcast(totals))


def zero_filled(categories: DataFrame, counts: DataFrame, key: str = "category") -> DataFrame:
    """A breakdown with a zero row for every category it lacks."""
    return categories.join(counts, key, "left").fillna(0)


def shares(counts: DataFrame) -> DataFrame:
    """Handling counts unpivoted to (handling, n, share)."""
    return counts.select("total", F.expr("stack(3, 'REMOTE', remote, 'NON_REMOTE', non_remote, 'UNKNOWN', unknown) as (handling, n)")).select("handling", "n", F.coalesce(F.try_divide(F.col("n") * 100.0, F.col("total")), F.lit(0.0)).alias("share"))


def class_metrics(rows: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class over the union of labels; 0 for an empty denominator. Rows are reduced to the confusion counts first."""
    cells = rows.groupBy(F.col(label).cast("string").alias("l"), F.col(predicted).cast("string").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = cells.select(F.col("l").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("guesses"), F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("hits")).unionByName(
        cells.select(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("guesses"), F.lit(0).cast("long").alias("hits"))
    )
    out = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "guesses", "hits")])
    zero = lambda a, b: F.coalesce(F.try_divide(F.col(a) * 1.0, F.col(b)), F.lit(0.0))
    out = out.withColumn("precision", zero("hits", "guesses")).withColumn("recall", zero("hits", "support"))
    return out.withColumn("f1", F.coalesce(F.try_divide(F.col("hits") * 2.0, F.col("support") + F.col("guesses")), F.lit(0.0))).drop("guesses", "hits")


def summary_metrics(per_class: DataFrame) -> DataFrame:
    """Macro and weighted averages of per-class metrics."""
    parts = [F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")] + [(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")]
    return per_class.agg(*parts)


def report_view(rows: DataFrame, counts: tuple[str, ...] = (), percents: tuple[str, ...] = ()) -> DataFrame:
    """A report as it is shown: counts with separators of thousands, percents with one place and a sign, nulls as a dash. Other columns stay as they are."""
    shown = {c: F.format_number(F.col(c), 0) for c in counts} | {c: F.concat(F.format_number(F.col(c), 1), F.lit("%")) for c in percents}
    return rows.withColumns({c: F.coalesce(v, F.lit("-")) for c, v in shown.items()})
