"""Distributions of messages and conversations, and the full master row of a unit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadline.dims import Taxonomy
from threadline.functions.text import ATTACHED_MARK, OMITTED_MARKS, display_name, letters_suffix
from threadline.operators.chat import response_marks, response_of, response_sums, sessionise, split_topics, time_gaps, transcript

MINUTE_US = 60_000_000
# Lower bounds of the gap buckets in minutes, and of the size classes of conversations.
GAP_MINUTES = (0, 1, 5, 15, 30, 60, 120, 360, 720, 1440, 4320, 10080, 43200)
SIZE_CLASSES = ((1, 1), (2, 5), (6, 10), (11, 20), (21, 50), (51, None))


def period_span(rows: DataFrame, ts: str) -> DataFrame:
    """First and last time, distinct days and months."""
    return rows.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.countDistinct(F.to_date(ts)).alias("days"), F.countDistinct(F.trunc(F.to_date(ts), "month")).alias("months"))


def media_by_sender(messages: DataFrame) -> DataFrame:
    """Media messages per sender: with and without a file, and whether there is text beside the mark."""
    bare = F.col("text")
    for mark in (*OMITTED_MARKS, ATTACHED_MARK):
        bare = F.replace(bare, F.lit(mark), F.lit(""))
    beside = F.trim(F.replace(bare, F.when(F.col("file_name") != "", F.col("file_name")).otherwise(F.lit("\u0000")), F.lit(""))) != ""
    return messages.groupBy("sender").agg(
        F.count_if("has_media").alias("media"), F.count_if(F.col("file_name") != "").alias("with_file"), F.count_if(F.col("has_media") & (F.col("file_name") == "")).alias("without_file"),
        F.count_if(F.col("has_media") & beside).alias("media_and_text"), F.count_if(F.col("has_media") & ~beside).alias("media_only"),
    )


def role_conflicts(messages: DataFrame) -> DataFrame:
    """Senders with more than one role."""
    return messages.groupBy("sender").agg(F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"), F.countDistinct("role").alias("n")).where("n > 1")


def bucket_of(value: Column, bounds: tuple[int, ...]) -> Column:
    """Index of the half-open bucket of a value that is not below the first bound."""
    out = F.lit(len(bounds) - 1)
    for i in range(len(bounds) - 2, -1, -1):
        out = F.when(value < bounds[i + 1], i).otherwise(out)
    return out


def gap_distribution(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per source and bucket of minutes the number of gaps that are not negative, with the source's least, largest and mean gap in minutes."""
    gaps = time_gaps(rows, keys, order).where("gap_us >= 0").withColumn("minutes", F.col("gap_us") / MINUTE_US)
    whole = gaps.groupBy(*keys).agg(F.min("minutes").alias("least"), F.max("minutes").alias("largest"), F.avg("minutes").alias("mean"))
    return gaps.groupBy(*keys, bucket_of(F.col("minutes"), GAP_MINUTES).alias("bucket")).agg(F.count(F.lit(1)).alias("n")).join(whole, keys)


def size_distribution(conversations: DataFrame, size: str) -> DataFrame:
    """One row: conversations by closed size classes, singletons, least and largest."""
    n = F.col(size)
    classes = [F.count_if((n >= a) & (n <= b) if b else n >= a).alias(f"from_{a}") for a, b in SIZE_CLASSES]
    return conversations.agg(F.count(F.lit(1)).alias("conversations"), F.min(n).alias("least"), F.max(n).alias("largest"), *classes)


def label_distribution(messages: DataFrame, labels: DataFrame, key: str, label: str, source: str) -> DataFrame:
    """A label of conversations counted by conversation, by message and by source: (level, source, label, n)."""
    joined = messages.join(labels.select(key, label), key)
    units = joined.groupBy(key, label).agg(F.count(F.lit(1)).alias("n"), F.min(source).alias("s"))
    whole = F.lit(None).cast("string")
    each = units.select(F.explode(F.array(
        F.struct(F.lit("conversation").alias("level"), whole.alias("source"), F.lit(1).cast("long").alias("n")), F.struct(F.lit("message").alias("level"), whole.alias("source"), F.col("n")),
        F.struct(F.lit("source").alias("level"), F.col("s").cast("string").alias("source"), F.lit(1).cast("long").alias("n")),
    )).alias("x"), F.col(label).alias("label"))
    return each.groupBy("x.level", "x.source", "label").agg(F.sum("x.n").alias("n"))


def full_master(messages: DataFrame, taxonomy: Taxonomy, remote: str, credentials: str, closing: str, waiting: str, hours: float = 4.0) -> DataFrame:
    """One row per one-topic unit of (source_file, msg_no, ts, role, text, has_media) rows: period, counts, media, credentials, labels and transcript.

    Windows, units and the labels of conversations all lie within a file, so messages are dealt by file once and read once: a unit
    adds up its share of what its conversation is judged by, and a window over the units of a conversation adds up these sums.
    """
    rows = sessionise(messages, ["source_file"], ["msg_no"], hours, counts=F.col("role") != "SYSTEM")
    lowered = F.lower(F.coalesce(F.col("text"), F.lit("")))
    keys = ["source_file", "session_no"]
    rows = split_topics(rows, keys, ["msg_no"], taxonomy).withColumns({"_cred": lowered.rlike(credentials), "_tool": lowered.rlike(remote)})
    rows = response_marks(rows, keys, "msg_no", closing, waiting)
    units = rows.groupBy(*keys, "segment", "category").agg(
        F.min_by("ts", "msg_no").alias("start_ts"), F.max_by("ts", "msg_no").alias("end_ts"), F.count(F.lit(1)).alias("total_messages"), F.count_if(F.col("role") == "CLIENT").alias("client_messages"),
        F.count_if(F.col("role") == "ADMIN").alias("admin_messages"), F.bool_or("has_media").alias("has_media"), F.bool_or("_cred").alias("has_credentials"), F.bool_or(F.col("_cred") | F.col("_tool")).alias("_handled"),
        *[c.alias(n) for n, c in response_sums().items()], transcript("msg_no", "ts", "role", "text").alias("transcript"),
    )
    whole = Window.partitionBy(*keys)
    sums = [F.max("_client"), F.sum("_admins"), F.max("_last"), F.bool_and("_brief"), F.bool_or("_open")]
    response = response_of(*[c.over(whole) for c in sums])
    handling = F.when(F.bool_or("_handled").over(whole), "REMOTE").otherwise("NON_REMOTE")
    conversation = F.concat(F.regexp_replace("source_file", r"\.[^.]*$", ""), F.format_string("_conv_%03d", "session_no"))
    out = units.withColumns({"response": response, "handling": handling, "conversation_id": conversation})
    return out.select(F.concat_ws("_", "conversation_id", letters_suffix(F.col("segment"))).alias("sub_id"), "conversation_id", "source_file", "start_ts", "end_ts", "total_messages", "client_messages", "admin_messages", "has_media", "has_credentials", "response", "handling", "category", "transcript")


def with_prediction(master: DataFrame, scored: DataFrame) -> DataFrame:
    """Add ``predicted``, ``confidence`` and ``match`` from (sub_id, predicted, confidence) rows."""
    out = master.join(scored.select("sub_id", "predicted", "confidence"), "sub_id", "left")
    return out.withColumn("match", F.when(F.col("category") == F.col("predicted"), "MATCH").otherwise("DIFFER"))


def with_texts(master: DataFrame, texts: DataFrame) -> DataFrame:
    """Add ``normalised`` from (sub_id, normalised) rows, empty where a unit has none."""
    return master.join(texts.select("sub_id", "normalised"), "sub_id", "left").withColumn("normalised", F.coalesce("normalised", F.lit("")))


def with_customer(master: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add ``customer`` from (source_filename, customer_name) rows: the name, or Unknown with the source."""
    names = mapping.groupBy(F.col("source_filename").alias("_f")).agg(F.min("customer_name").alias("_name"))
    return master.join(names, F.col("source_file") == F.col("_f"), "left").withColumn("customer", display_name(F.col("_name"), F.col("source_file"))).drop("_f", "_name")


def match_rate(rows: DataFrame, category: str = "category") -> DataFrame:
    """(category, total, matched, percent) of rows with a ``match``; a null category is all of them."""
    n, same = F.count(F.lit(1)), F.count_if(F.col("match") == "MATCH")
    each = rows.groupBy(F.col(category).alias("category")).agg(n.alias("total"), same.alias("matched"))
    whole = each.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.coalesce(F.sum("matched"), F.lit(0)).alias("matched")).select(F.lit(None).cast("string").alias("category"), "total", "matched")
    return each.unionByName(whole).withColumn("percent", F.coalesce(F.try_divide(F.col("matched") * 100.0, F.col("total")), F.lit(0.0)))


def executive_summary(rows: DataFrame, key: str, category: str) -> DataFrame:
    """Eight figures as (metric, value, percent); what is not remote is the rest of all here."""
    one = rows.agg(
        F.count(F.lit(1)).alias("units"), F.countDistinct(key).alias("conversations"), F.count_if(F.col("response") == "RESPONSE").alias("responded"), F.count_if(F.col("handling") == "REMOTE").alias("remote"),
        F.count_if("has_media").alias("media"), F.count_if("has_credentials").alias("credentials"),
    )
    names = [("units", "units"), ("conversations", "conversations"), ("responded", "responded"), ("not_responded", "units - responded"), ("remote", "remote"), ("not_remote", "units - remote"), ("with_media", "media"), ("with_credentials", "credentials")]
    stacked = ", ".join(f"'{n}', cast({e} as bigint)" for n, e in names)
    return one.selectExpr("units", f"stack({len(names)}, {stacked}) as (metric, value)").select("metric", "value", F.coalesce(F.try_divide(F.col("value") * 100.0, F.col("units")), F.lit(0.0)).alias("percent"))


def category_report(rows: DataFrame, category: str) -> DataFrame:
    """Per category: units, remote with percent, the rest, responded and not, mean messages."""
    remote, responded = F.count_if(F.col("handling") == "REMOTE"), F.count_if(F.col("response") == "RESPONSE")
    n = F.count(F.lit(1))
    return rows.groupBy(category).agg(n.alias("total"), remote.alias("remote"), (remote * 100.0 / n).alias("remote_percent"), (n - remote).alias("not_remote"), responded.alias("responded"), (n - responded).alias("not_responded"), F.avg("total_messages").alias("mean_messages"))


def series_kpis(series: DataFrame) -> DataFrame:
    """Total, mean per period and the peak period, the first of equals."""
    best = F.min(F.struct((-F.col("total")).alias("n"), F.col("period").alias("p")))
    return series.agg(F.sum("total").alias("total"), F.avg("total").alias("mean"), best.getField("p").alias("peak"), (-best.getField("n")).alias("peak_total"))


def highest_rate(breakdown: DataFrame, category: str, least_share: float = 3.0, left_out: str = "UNKNOWN_UNCLASSIFIED") -> DataFrame:
    """The category of the highest remote rate among those with a share of at least ``least_share`` percent; ties by name."""
    return breakdown.where((F.col(category) != left_out) & (F.col("share") >= least_share)).orderBy(F.desc("rate"), category).limit(1).select(category, "rate", "total")


def top_with_width(totals: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The k largest totals with their share of the largest one."""
    top = totals.orderBy(F.desc("total"), key).limit(k)
    return top.crossJoin(F.broadcast(top.agg(F.max("total").alias("_most")))).select(key, "total", (F.col("total") * 1.0 / F.col("_most")).alias("width"))
