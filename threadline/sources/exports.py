"""Chat exports: raw text files to messages, and what is known about their quality.

A file becomes rows of (source_file, line_no, line); everything after that is columns, one window over a file
and one grouping. Where files are small the parallelism is across files; ``read_splits`` and ``fold_splits`` spread one
large file over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadline.functions.text import media_of, strip_invisible
from threadline.operators.scans import SLICE, carried

# The shapes of a dated line, and of any line that begins with a date and a time.
DATED_LINE = r"^([0-9]{1,2}/[0-9]{1,2}/[0-9]{2})[ \t]([0-9]{1,2}\.[0-9]{2})[ \t]-[ \t](.+)$"
SENDER_AND_TEXT = r"^(.+?):[ \t](.*)$"
ANY_TIMESTAMP = r"^[ \t]*\[?[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}[, \t]+[0-9]{1,2}[:.][0-9]{2}"


def decoded(content: Column) -> Column:
    """Text of a file's bytes: UTF-8, else Latin-1."""
    return F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))


def read_exports(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """(source_file, path, line_no, line) of all text files of a folder; a file goes through one task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    lines = F.posexplode(F.split(decoded(F.col("content")), "\r?\n")).alias("line_no", "line")
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("source_file"), "path", lines)


def read_splits(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """(source_file, path, split, place, line): the lines of all text files of a folder, a large file in byte ranges of many tasks.

    ``split`` is where the line's byte range begins and ``place`` grows with the lines of a range, so the two order a file. Line
    breaks are those of any system. A file with a line that is no UTF-8 is Latin-1 throughout.
    """
    text = spark.read.format("text").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    rows = text.select(path.alias("path"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("place"), "value")
    other = rows.groupBy("path").agg(F.bool_and(F.is_valid_utf8("value")).alias("_utf8")).where("not _utf8").select(F.col("path").alias("_p"))
    rows = rows.join(other, F.col("path") == F.col("_p"), "left")
    line = F.when(F.col("_p").isNull(), F.col("value")).otherwise(F.decode(F.col("value").cast("binary"), "ISO-8859-1"))
    return rows.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("source_file"), "path", "split", "place", line.alias("line"))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """(source_file, path, line_no, line) of the lines of splits: a line's number is its place in its split and the lines of the splits before."""
    rows = carried(lines.withColumn(SLICE, F.col("split")), ["path"], ["place"], sums={"line_no": F.lit(1)})
    return rows.select("source_file", "path", (F.col("line_no") - 1).cast("long").alias("line_no"), "line")


def cleaned_line() -> Column:
    """The line without invisible signs and line breaks."""
    return strip_invisible(F.regexp_replace("line", r"[\r\n]+$", ""))


def fold_lines(lines: DataFrame) -> DataFrame:
    """Messages of (source_file, line_no, line) rows: a dated line begins a message, any other that is not blank goes on with it.

    Lines before a file's first message are dropped. A dated line without ``sender: `` is a system notice.
    """
    rows = lines.select("source_file", "line_no", cleaned_line().alias("line")).withColumn("starts", F.col("line").rlike(DATED_LINE))
    order = Window.partitionBy("source_file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return messages_of(rows.withColumn("msg_no", F.sum(F.col("starts").cast("int")).over(order)), ["source_file"])


def fold_splits(lines: DataFrame, files: list[str] | None = None) -> DataFrame:
    """``fold_lines`` for lines with a ``split``: the message that is open at the end of a range goes on in the next.

    Each range counts its dated lines; the counts of the ranges before it say which message its first lines belong to. So one
    file over many tasks gives what one task gives. ``files`` names the columns of a file (``source_file`` and ``path``, if not given).
    """
    files = files or ["source_file", "path"]
    rows = lines.withColumn("line", cleaned_line()).withColumn("starts", F.col("line").rlike(DATED_LINE)).withColumn(SLICE, F.col("split"))
    rows = carried(rows, files, ["place"], sums={"msg_no": F.col("starts").cast("int"), "line_no": F.lit(1)})
    return messages_of(rows.withColumn("line_no", F.col("line_no") - 1), files)


def messages_of(rows: DataFrame, files: list[str]) -> DataFrame:
    """Messages of lines with their ``msg_no`` (0 before the first) and whether they start one."""
    rows = rows.where((F.col("msg_no") > 0) & (F.col("starts") | (F.trim("line") != "")))
    rest = F.regexp_extract("line", DATED_LINE, 3)
    named = rest.rlike(SENDER_AND_TEXT)
    piece = F.when(~F.col("starts"), F.col("line")).when(named, F.regexp_extract(rest, SENDER_AND_TEXT, 2)).otherwise(rest)
    head = F.struct(
        F.regexp_extract("line", DATED_LINE, 1).alias("sent_date"), F.regexp_extract("line", DATED_LINE, 2).alias("sent_time"),
        F.when(named, F.trim(F.regexp_extract(rest, SENDER_AND_TEXT, 1))).otherwise("SYSTEM").alias("sender"),
    )
    pieces = F.array_sort(F.collect_list(F.struct(F.col("line_no").alias("o"), piece.alias("t"))))
    out = rows.groupBy(*files, "msg_no").agg(F.min("line_no").alias("line_no"), F.min_by(head, "line_no").alias("h"), F.array_join(F.transform(pieces, lambda s: s["t"]), "\n").alias("text"))
    return out.select(*files, "msg_no", "line_no", "h.*", "text").withColumns({c: media_of(F.col("text"))[c] for c in ("media_type", "file_name", "has_media")})


def with_ids(messages: DataFrame) -> DataFrame:
    """Add ``id``, from 1 over files in order of name and messages in order of line.

    Ranks inside a file come from a window over the file; only the sums before each file are a window over all, with one row a file.
    """
    counts = messages.groupBy("source_file").agg(F.max("msg_no").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("source_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return messages.join(counts.select("source_file", before.alias("first")), "source_file").withColumn("id", F.col("first") + F.col("msg_no")).drop("first")


def attach_media(messages: DataFrame, media: DataFrame) -> DataFrame:
    """Add ``media_path`` from a (chat, file_name, path) inventory: the file of that name in the chat's folder, else empty."""
    chat = F.regexp_replace("source_file", r"\.[^.]*$", "")
    found = media.select(F.col("chat").alias("m_chat"), F.col("file_name").alias("m_name"), F.col("path").alias("media_path")).dropDuplicates(["m_chat", "m_name"])
    out = messages.join(found, (chat == F.col("m_chat")) & (F.col("file_name") == F.col("m_name")) & (F.col("file_name") != ""), "left")
    return out.withColumn("media_path", F.coalesce("media_path", F.lit(""))).drop("m_chat", "m_name")


def parse_quality(messages: DataFrame) -> DataFrame:
    """One row on all messages: totals, missing parts, empty and multi-line texts, media."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return messages.agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("source_file").alias("files"), F.countDistinct("sender").alias("senders"),
        *[F.count_if(F.coalesce(F.col(c), F.lit("")) == "").alias(f"no_{c}") for c in ("sent_date", "sent_time", "sender")],
        F.count_if(F.trim(text) == "").alias("empty"), F.count_if(text.contains("\n")).alias("multi_line"), F.count_if(F.col("has_media")).alias("with_media"),
        F.count_if(F.col("sender") == "SYSTEM").alias("system"),
    )


def detect_chats(lines: DataFrame, path: str = "source_file") -> DataFrame:
    """Files that are chat exports: at least one line that begins with a date and a time; with their number of such lines and place by lower-cased path."""
    line = strip_invisible(F.regexp_replace("line", r"[\r\n]+$", ""))
    timed = line.rlike(DATED_LINE) | line.rlike(ANY_TIMESTAMP)
    counts = lines.groupBy(F.col(path).alias("path")).agg(F.count_if(timed).alias("timed_lines")).where("timed_lines >= 1")
    return counts.withColumn("place", F.row_number().over(Window.orderBy(F.lower("path"), "path")))  # a row a file


def read_rows(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """A CSV table with header, all columns text; quoted fields may hold line breaks."""
    return spark.read.csv(path, schema=", ".join(f"`{c}` string" for c in columns), header=True, multiLine=True, escape='"')


def write_rows(df: DataFrame, path: str, columns: tuple[str, ...], single: bool = False) -> None:
    """Some columns in order as CSV with header; one file for a download if ``single``."""
    out = df.select(*[F.col(c).cast("string") for c in columns])
    (out.coalesce(1) if single else out).write.mode("overwrite").csv(path, header=True, escape='"')


def write_master(master: DataFrame, path: str, columns: tuple[str, ...]) -> None:
    """The master as CSV files, each with a header that begins with a byte-order mark, as spreadsheets want it."""
    first, *rest = [F.col(c).cast("string").alias(("\ufeff" if k == 0 else "") + c) for k, c in enumerate(columns)]
    master.select(first, *rest).write.mode("overwrite").csv(path, header=True, escape='"', encoding="UTF-8")


def write_features(weights: DataFrame, labels: DataFrame, id_col: str, path: str) -> None:
    """(id, term, weight) rows and (id, label) rows of a feature set, as Parquet in two folders."""
    weights.select(id_col, "term", "weight").write.mode("overwrite").parquet(f"{path}/weights")
    labels.select(id_col, "label").write.mode("overwrite").parquet(f"{path}/labels")


def read_features(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The weights and labels that ``write_features`` wrote."""
    return spark.read.parquet(f"{path}/weights"), spark.read.parquet(f"{path}/labels")


def session_rows(master: DataFrame, session: str | None) -> DataFrame:
    """Rows of one session, or of the default one (null); a session without any row is an error, never the default."""
    if session is None:
        return master.where(F.col("session_id").isNull())
    rows = master.where(F.col("session_id") == session)
    if rows.isEmpty():
        raise ValueError(f"no such session: {session}")
    return rows


def scoring_rows(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Add ``text``: the first of some columns that is not blank; rows without any go."""
    text = F.coalesce(*[F.nullif(F.trim(F.col(c)), F.lit("")) for c in columns])
    return rows.withColumn("text", text).where(F.col("text").isNotNull())


def scoring_lines(lines: DataFrame) -> DataFrame:
    """Lines of plain text files that are not blank, numbered from 1 in their file."""
    return lines.where(F.trim("line") != "").select("source_file", (F.col("line_no") + 1).alias("line_no"), F.trim("line").alias("text"))
