"""From messages to labelled conversations: roles, gaps, sessions, topics, responses, handling.

Every rule that follows file order takes an order key; windows end in a unique key and are partitioned by
the source, so a table needs one exchange for all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadline.dims import Taxonomy
from threadline.functions.text import category_or_fallback, first_category, letters_suffix


def assign_roles(messages: DataFrame, roles: dict[str, str], sender: str = "sender") -> DataFrame:
    """Add ``role``; unmapped senders are UNKNOWN. The map is a parameter, so it becomes a literal rather than a join."""
    known = F.create_map(*[F.lit(x) for kv in roles.items() for x in kv]) if roles else None
    role = F.try_element_at(known, F.col(sender)) if roles else F.lit(None).cast("string")
    return messages.withColumn("role", F.coalesce(role, F.lit("UNKNOWN")))


def assign_roles_from(messages: DataFrame, role_table: DataFrame, sender: str = "sender") -> DataFrame:
    """Add ``role`` from a (sender, role) table of any size; Spark broadcasts it when it is small."""
    table = role_table.select(F.col("sender").alias("_sender"), F.col("role").alias("_role")).dropDuplicates(["_sender"])
    return messages.join(table, F.col(sender) == F.col("_sender"), "left").withColumn("role", F.coalesce("_role", F.lit("UNKNOWN"))).drop("_sender", "_role")


def unmapped_senders(messages: DataFrame, role_table: DataFrame, sender: str = "sender") -> DataFrame:
    """Senders without a role."""
    return messages.select(F.col(sender).alias("sender")).where("sender is not null").distinct().join(role_table.select("sender"), "sender", "left_anti")


def micros(later: Column, earlier: Column) -> Column:
    """Microseconds between two local timestamps."""
    return F.timestamp_diff("MICROSECOND", earlier, later)


def earlier_rows(keys: list[str], order: list[str]) -> tuple:
    """Windows over the rows before the current one, and up to it."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)


def time_gaps(rows: DataFrame, keys: list[str], order: list[str], ts: str = "ts") -> DataFrame:
    """Add ``gap_us`` to the previous row with a time."""
    before, _ = earlier_rows(keys, order)
    return rows.withColumn("gap_us", micros(F.col(ts), F.last(ts, ignorenulls=True).over(before)))


def sessionise(rows: DataFrame, keys: list[str], order: list[str], hours: float = 4.0, ts: str = "ts", counts: Column | None = None) -> DataFrame:
    """Add ``session_no`` from 1: a row of the counted kind starts a new session when ``hours`` or more have passed since the last one.

    ``counts`` says which rows move the clock (all by default); the others stay in the session around them.
    """
    counts = F.lit(True) if counts is None else counts
    before, upto = earlier_rows(keys, order)
    out = rows.withColumn("_prev", F.last(F.when(counts, F.col(ts)), ignorenulls=True).over(before))
    starts = counts & (micros(F.col(ts), F.col("_prev")) >= int(hours * 3_600_000_000))
    out = out.withColumn("_starts", F.when(starts, 1).otherwise(0))
    return out.withColumn("session_no", (F.lit(1) + F.sum("_starts").over(upto)).cast("long")).drop("_prev", "_starts")


def split_topics(rows: DataFrame, keys: list[str], order: list[str], taxonomy: Taxonomy, role: str = "role", text: str = "text") -> DataFrame:
    """Add ``segment`` and ``category``: a client row with a category other than the current one starts a segment."""
    before, upto = earlier_rows(keys, order)
    out = rows.withColumn("_own", F.when(F.col(role) == "CLIENT", first_category(F.col(text), taxonomy)))
    out = out.withColumn("_held", F.last("_own", ignorenulls=True).over(before))
    out = out.withColumn("_cut", F.when(F.col("_own") != F.col("_held"), 1).otherwise(0))
    out = out.withColumn("segment", F.sum("_cut").over(upto).cast("long"))
    label = F.max("_own").over(Window.partitionBy(*keys, "segment"))
    return out.withColumn("category", F.coalesce(label, F.lit(taxonomy.fallback))).withColumn("suffix", letters_suffix(F.col("segment"))).drop("_own", "_held", "_cut")


def response_marks(rows: DataFrame, keys: list[str], position: str, closing: str, waiting: str, role: str = "role", text: str = "text", short: int = 30) -> DataFrame:
    """Add what ``response_sums`` adds up; a window over the conversation says where its last client row is."""
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    out = rows.withColumns({
        "_p": F.col(position), "_r": F.col(role), "_closing": lowered.rlike(closing), "_asks": lowered.contains("?"), "_waits": lowered.rlike(waiting), "_short": F.length(F.trim(lowered)) <= short,
    })
    return out.withColumn("_client", F.max(F.when(F.col("_r") == "CLIENT", F.col("_p"))).over(Window.partitionBy(*keys)))


def response_sums() -> dict[str, Column]:
    """Aggregates of ``response_marks`` over a conversation or a part of it."""
    after = F.col("_p") > F.col("_client")
    return {
        "_client": F.max("_client"), "_admins": F.count_if(F.col("_r") == "ADMIN"), "_last": F.max(F.struct("_p", "_r", (F.col("_closing") & ~F.col("_asks") & ~F.col("_waits")).alias("closed"))),
        "_brief": F.coalesce(F.bool_and(F.when(after, F.col("_short") | F.col("_closing"))), F.lit(True)), "_open": F.coalesce(F.bool_or(F.when(after, F.col("_asks") | F.col("_waits"))), F.lit(False)),
    }


def response_of(client: Column, admins: Column, last: Column, brief: Column, is_open: Column) -> Column:
    """The ordered rule on the sums of a whole conversation."""
    yes = (admins == 0) | (last["_r"] == "CLIENT") | last["closed"] | (brief & ~is_open)
    return F.when(client.isNull(), "NO_RESPONSE").when(yes, "RESPONSE").otherwise("NO_RESPONSE")


def response_labels(rows: DataFrame, key: str, position: str, closing: str, waiting: str, role: str = "role", text: str = "text", short: int = 30) -> DataFrame:
    """Per conversation whether the client responded, by the ordered rule.

    No client row: no. No admin row: yes. Last row by the client: yes. Last row a closing word that neither asks nor waits: yes.
    All rows after the client's last are short or closing, and none asks or waits: yes. Else no.
    """
    marks = response_marks(rows.select(key, position, role, text), [key], position, closing, waiting, role, text, short)
    groups = marks.groupBy(key).agg(*[c.alias(n) for n, c in response_sums().items()])
    return groups.select(key, response_of(*[F.col(c) for c in response_sums()]).alias("response"))


def handling_labels(rows: DataFrame, key: str, remote: str, credentials: str, text: str = "text") -> DataFrame:
    """Per conversation REMOTE when any row names a remote tool or credentials, with the number of credential rows."""
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    hit, cred = lowered.rlike(remote), lowered.rlike(credentials)
    return rows.groupBy(key).agg(F.when(F.bool_or(hit | cred), "REMOTE").otherwise("NON_REMOTE").alias("handling"), F.count_if(cred).alias("credential_rows"))


def client_text(rows: DataFrame, key: str, order: str, role: str = "role", text: str = "text") -> DataFrame:
    """Per group the client's texts in order, or all texts when there is no client row."""
    def joined(only: Column | None) -> Column:
        item = F.struct(F.col(order).alias("o"), F.col(text).alias("t"))
        return F.array_join(F.transform(F.array_sort(F.collect_list(item if only is None else F.when(only, item))), lambda s: s["t"]), " ")

    client = F.col(role) == "CLIENT"
    return rows.where(F.col(text).isNotNull()).groupBy(key).agg(F.when(F.count_if(client) > 0, joined(client)).otherwise(joined(None)).alias("client_text"), F.count(F.lit(1)).alias("n_rows"))


def exact_duplicates(rows: DataFrame, columns: list[str], id_col: str) -> DataFrame:
    """Rows that repeat an earlier one on some columns, with the id of the first; ids are unique.

    Equal rows are met by digest: the least id of each is a sum over rows, so copies are folded where they lie, and only digests of
    several rows are joined back, which Spark can split where very many rows are equal.
    """
    digest = F.sha2(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]), 256)
    out = rows.select(F.col(id_col), digest.alias("_d"))
    first = out.groupBy("_d").agg(F.min(id_col).alias("first_id"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return out.join(first, "_d").where(F.col(id_col) != F.col("first_id")).select(id_col, "first_id")


def first_rows(rows: DataFrame, key: str, order: list[str], k: int = 1) -> DataFrame:
    """First k rows per key in a stated order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_n") <= k).drop("_n")


def time_anomalies(rows: DataFrame, keys: list[str], order: list[str], ts: str = "ts") -> DataFrame:
    """Rows whose time lies before that of the previous row with a time."""
    return time_gaps(rows, keys, order, ts).where("gap_us < 0")


def time_order_report(rows: DataFrame, key: str, order: str, ts: str = "ts", k: int = 3) -> DataFrame:
    """Per source the number of rows earlier than the previous row with a time, and the first k of them as text, in order; empty if there is none.

    All windows and the sums are over the source, so the rows are dealt once.
    """
    _, upto = earlier_rows([key], [order])
    late = F.coalesce(F.col("gap_us") < 0, F.lit(False))
    marked = time_gaps(rows, [key], [order], ts).withColumn("_late", late).withColumn("_n", F.count_if("_late").over(upto))
    line = F.concat(F.col(order).cast("string"), F.lit(" at "), F.col(ts).cast("string"), F.lit(", "), F.expr("(-gap_us) div 60000000").cast("string"), F.lit(" minutes back"))
    shown = F.array_sort(F.collect_list(F.when(F.col("_late") & (F.col("_n") <= k), F.struct(F.col(order).alias("o"), line.alias("t")))))
    out = marked.groupBy(key).agg(F.count_if("_late").alias("anomalies"), shown.alias("_s"))
    return out.select(key, "anomalies", F.array_join(F.transform("_s", lambda x: x["t"]), "; ").alias("samples"))


def transcript(order: str, ts: str, role: str, text: str) -> Column:
    """Aggregate: ``[time] role: text`` pieces in order, line breaks flattened."""
    piece = F.concat(F.lit("["), F.coalesce(F.col(ts).cast("string"), F.lit("")), F.lit("] "), F.col(role), F.lit(": "), F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\r\n]+", " "))
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), piece.alias("t")))), lambda s: s["t"]), " | ")


def transcript_rows(frame: DataFrame, key: str, column: str = "transcript") -> DataFrame:
    """Transcripts back to rows: piece number, time, role, text."""
    out = frame.select(key, F.posexplode(F.split(column, r" \| ")).alias("piece", "_t"))
    shape = r"(?s)^\[([^\]]*)\] ([^:]*): (.*)$"
    return out.select(key, "piece", *[F.regexp_extract("_t", shape, i).alias(n) for i, n in ((1, "time"), (2, "role"), (3, "text"))])


def document_labels(docs: DataFrame, taxonomy: Taxonomy, text: str = "text") -> DataFrame:
    """Rule labeller: category by taxonomy with a fixed confidence, lower for the fallback."""
    category = category_or_fallback(F.col(text), taxonomy)
    return docs.withColumn("label", category).withColumn("confidence", F.when(F.col("label") == taxonomy.fallback, 0.5).otherwise(0.9))
