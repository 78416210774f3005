"""Queries on chat exports. The lines of the exports are made from the events table, so SQL can state the messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadline import dims
from threadline.functions import text as T
from threadline.operators import chat, distributions
from threadline.plans.frames import read
from threadline.sources import exports, mapping


def export_lines(s, d):
    """One export a user: a dated line an event, more lines for clicks, a preface and blank lines."""
    e = read(s, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    stamp = F.concat(F.date_format("ts", "dd/MM/yy HH.mm"), F.lit(" - "))
    user, number = F.concat(F.lit("user "), F.col("user_id").cast("string")), F.col("event_id").cast("string")
    kind = F.col("event_type")
    rest = F.when(kind == "error", F.concat(F.lit("notice "), number)).when(kind == "purchase", F.concat(user, F.lit(": bill_"), number, F.lit(".pdf (file terlampir)"))) \
        .when(kind == "view", F.lit("desk: <Media omitted>")).when(kind == "click", F.concat(user, F.lit(": clicked "), number)).otherwise(F.concat(user, F.lit(": id: 12"), number))
    lines = F.array(F.when(kind == "signup", F.concat(F.lit("﻿"), stamp, rest)).otherwise(F.concat(stamp, rest)), F.when(kind == "click", F.concat(F.lit("more: "), number)), F.when(kind == "click", F.lit("  ")))
    rows = e.select("user_id", "event_id", F.posexplode(lines).alias("k", "line")).where("line is not null")
    rows = rows.select(F.format_string("user_%d.txt", "user_id").alias("source_file"), (F.col("event_id") * 4 + F.col("k") + 4).alias("line_no"), "line")
    return rows.unionByName(rows.select("source_file", F.lit(0).cast("long").alias("line_no"), F.lit("a line before the first message").alias("line")).distinct())


def parsed(s, d):
    """Messages of the exports."""
    return exports.fold_lines(export_lines(s, d))


def _split_messages(s, d):
    """The same exports with every file in ranges of some lines, as byte ranges of a large file are."""
    lines = export_lines(s, d).withColumns({"split": F.expr("line_no div 1000"), "place": F.col("line_no")}).drop("line_no")
    folded = exports.fold_splits(lines, ["source_file"]).drop("line_no")
    return folded.select("source_file", "msg_no", "sent_date", "sent_time", "sender", "text", "media_type", "file_name", "has_media")


_PARSED = """msgs AS (
  SELECT 'user_' || user_id || '.txt' AS source_file, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS msg_no, event_id, ts, strftime(ts, '%d/%m/%y') AS sent_date, strftime(ts, '%H.%M') AS sent_time,
         CASE event_type WHEN 'error' THEN 'SYSTEM' WHEN 'view' THEN 'desk' ELSE 'user ' || user_id END AS sender,
         CASE event_type WHEN 'error' THEN 'notice ' || event_id WHEN 'purchase' THEN 'bill_' || event_id || '.pdf (file terlampir)' WHEN 'view' THEN '<Media omitted>'
              WHEN 'click' THEN 'clicked ' || event_id || chr(10) || 'more: ' || event_id ELSE 'id: 12' || event_id END AS text,
         CASE event_type WHEN 'purchase' THEN 'document' WHEN 'view' THEN 'image' ELSE '' END AS media_type,
         CASE event_type WHEN 'purchase' THEN 'bill_' || event_id || '.pdf' ELSE '' END AS file_name, event_type IN ('purchase', 'view') AS has_media
  FROM events
)"""
_NAMED = "CASE WHEN sender = 'SYSTEM' THEN 'SYSTEM' WHEN sender = 'desk' THEN 'ADMIN' ELSE 'CLIENT' END"


def _roles(messages):
    role = F.when(F.col("sender") == "SYSTEM", "SYSTEM").when(F.col("sender") == "desk", "ADMIN").otherwise("CLIENT")
    return messages.withColumn("role", role).withColumn("ts", T.parse_chat_time(F.col("sent_date"), F.col("sent_time")))


def _paths(s, d):
    """Documents as files in folders, for the joins of media and chats: a third each are chats, media and others."""
    docs = read(s, d, "documents")
    place = F.concat(F.coalesce("source", F.lit("none")), F.lit("/"), F.expr("coalesce(n_chars, 0) div 20").cast("string"))
    kind = F.when(F.col("doc_id") % 3 == 0, ".TXT").when(F.col("doc_id") % 3 == 1, ".jpg").otherwise(".bin")
    return docs.select("doc_id", "lang", F.concat(place, F.lit("/file "), F.col("doc_id").cast("string"), kind).alias("path"))


def _chats(s, d):
    """All text files; one in English names the file after it."""
    paths = _paths(s, d).where("endswith(path, '.TXT')")
    return paths.select(F.format_string("chat_%d", "doc_id").alias("chat_id"), "path", F.col("doc_id").alias("place"), "lang")


def _media_assign(s, d):
    named = F.concat(F.lit("see FILE "), (F.col("place") + 1).cast("string"), F.lit(".jpg and more"))
    lines = _chats(s, d).select("chat_id", F.when(F.col("lang") == "en", named).otherwise(F.lit("see the .jpg")).alias("line"))
    return mapping.assign_media(_chats(s, d), lines, _paths(s, d).select("path"))


_PATHS = """paths AS (SELECT doc_id, lang, coalesce(source, 'none') || '/' || coalesce(n_chars, 0) // 20 || '/file ' || doc_id || CASE doc_id % 3 WHEN 0 THEN '.TXT' WHEN 1 THEN '.jpg' ELSE '.bin' END AS path FROM documents),
chats AS (SELECT 'chat_' || doc_id AS chat_id, doc_id AS place, lang, path, regexp_replace(path, '/[^/]*$', '') AS folder FROM paths WHERE suffix(path, '.TXT'))"""

QUERIES = {
    "parse_chat": lambda s, d: exports.with_ids(parsed(s, d)).select("id", "source_file", "msg_no", "sent_date", "sent_time", "sender", "text", "media_type", "file_name", "has_media"),
    "parse_splits": lambda s, d: _split_messages(s, d),
    "parse_quality": lambda s, d: exports.parse_quality(parsed(s, d)),
    "detect_chats": lambda s, d: exports.detect_chats(export_lines(s, d).unionByName(s.createDataFrame([("notes.txt", 0, "no date here"), ("Z.txt", 0, "[2024-01-02, 10:30] hi")], "source_file string, line_no long, line string"))),
    "attach_media": lambda s, d: exports.attach_media(parsed(s, d), parsed(s, d).where("file_name <> '' and msg_no % 2 = 0").select(F.regexp_replace("source_file", ".txt$", "").alias("chat"), "file_name", F.concat(F.lit("media/"), "file_name").alias("path"))).select("source_file", "msg_no", "media_path"),
    "chat_mapping": lambda s, d: mapping.chat_mapping(_chats(s, d).select("chat_id", "path")),
    "merge_mapping": lambda s, d: mapping.merged_mapping(mapping.chat_mapping(_chats(s, d)), _chats(s, d).where("place % 2 = 0").select("chat_id", F.lit("new").alias("source_filename"), F.col("path").alias("customer_name"))),
    "number_chats": lambda s, d: mapping.numbered_chats(_chats(s, d).select("path"), 17),
    "media_assign": lambda s, d: _media_assign(s, d),
    "ingest_summary": lambda s, d: mapping.ingest_summary(_chats(s, d), _media_assign(s, d)),
    "media_map": lambda s, d: mapping.media_map(_chats(s, d), _media_assign(s, d)).select("chat_id", F.array_join("media", "|").alias("media")),
    "unresolved_media": lambda s, d: mapping.unresolved_media(_media_assign(s, d)),
    "media_by_sender": lambda s, d: distributions.media_by_sender(parsed(s, d)),
    "period_span": lambda s, d: distributions.period_span(_roles(parsed(s, d)), "ts"),
    "full_master": lambda s, d: distributions.full_master(_roles(parsed(s, d)), dims.TAXONOMY, T.word_pattern(dims.REMOTE_WORDS), T.credential_pattern(dims.CREDENTIAL_WORDS), T.word_pattern(dims.CLOSING_WORDS), T.word_pattern(dims.WAITING_WORDS)),
    "scoring_rows": lambda s, d: exports.scoring_rows(read(s, d, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.lit(" ")).otherwise(F.col("lang")).alias("a"), "source"), ("a", "source")).select("doc_id", "text"),
}
ORACLES = {
    "parse_chat": f"WITH {_PARSED} SELECT row_number() OVER (ORDER BY source_file, msg_no) AS id, * EXCLUDE (event_id, ts) FROM msgs",
    "parse_splits": f"WITH {_PARSED} SELECT * EXCLUDE (event_id, ts) FROM msgs",
    "parse_quality": f"WITH {_PARSED} SELECT count(*) AS messages, count(DISTINCT source_file) AS files, count(DISTINCT sender) AS senders, 0::BIGINT AS no_sent_date, 0::BIGINT AS no_sent_time, 0::BIGINT AS no_sender, 0::BIGINT AS empty, count(*) FILTER (WHERE contains(text, chr(10))) AS multi_line, count(*) FILTER (WHERE has_media) AS with_media, count(*) FILTER (WHERE sender = 'SYSTEM') AS system FROM msgs",
    "detect_chats": f"WITH {_PARSED}, f AS (SELECT source_file AS path, count(*) AS timed_lines FROM msgs GROUP BY 1 UNION ALL SELECT 'Z.txt', 1) SELECT path, timed_lines, (row_number() OVER (ORDER BY lower(path), path))::INT AS place FROM f",
    "attach_media": f"WITH {_PARSED} SELECT source_file, msg_no, CASE WHEN file_name <> '' AND msg_no % 2 = 0 THEN 'media/' || file_name ELSE '' END AS media_path FROM msgs",
    "chat_mapping": f"WITH {_PATHS} SELECT chat_id, 'file ' || place || '.TXT' AS source_filename, 'file ' || place AS customer_name FROM chats",
    "merge_mapping": f"WITH {_PATHS} SELECT chat_id, CASE WHEN place % 2 = 0 THEN 'new' ELSE 'file ' || place || '.TXT' END AS source_filename, CASE WHEN place % 2 = 0 THEN path ELSE 'file ' || place END AS customer_name FROM chats",
    "number_chats": f"WITH {_PATHS} SELECT path, 'chat_' || (17 + row_number() OVER (ORDER BY lower(path), path)) || '.txt' AS chat_id FROM chats",
    "media_assign": f"""WITH {_PATHS}, m AS (SELECT doc_id, path, regexp_replace(path, '/[^/]*$', '') AS folder FROM paths WHERE doc_id % 3 = 1),
b AS (SELECT folder, arg_min(chat_id, place) AS beside FROM chats GROUP BY 1)
SELECT m.path, coalesce(c.chat_id, b.beside) AS chat_id, CASE WHEN c.chat_id IS NOT NULL THEN 'mentioned' WHEN b.beside IS NOT NULL THEN 'folder' ELSE 'unresolved' END AS reason
FROM m LEFT JOIN chats c ON c.place = m.doc_id - 1 AND c.lang = 'en' LEFT JOIN b ON b.folder = m.folder""",
    "media_by_sender": f"WITH {_PARSED} SELECT sender, count(*) FILTER (WHERE has_media) AS media, count(*) FILTER (WHERE file_name <> '') AS with_file, count(*) FILTER (WHERE has_media AND file_name = '') AS without_file, 0::BIGINT AS media_and_text, count(*) FILTER (WHERE has_media) AS media_only FROM msgs GROUP BY 1",
    "period_span": f"WITH {_PARSED}, m AS (SELECT date_trunc('minute', ts) AS ts FROM msgs) SELECT min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT ts::DATE) AS days, count(DISTINCT date_trunc('month', ts)) AS months FROM m",
    "scoring_rows": "SELECT doc_id, CASE WHEN doc_id % 2 = 0 OR lang IS NULL OR trim(lang) = '' THEN trim(source) ELSE trim(lang) END AS text FROM documents WHERE coalesce(CASE WHEN doc_id % 2 = 1 THEN nullif(trim(lang), '') END, nullif(trim(source), '')) IS NOT NULL",
}
_ASSIGNED = ORACLES["media_assign"].replace("SELECT m.path,", ", a AS (SELECT m.path,", 1) + ")"
ORACLES["media_map"] = f"{_ASSIGNED} SELECT c.chat_id, coalesce(string_agg(a.path, '|' ORDER BY a.path), '') AS media FROM chats c LEFT JOIN a ON a.chat_id = c.chat_id GROUP BY 1"
ORACLES["unresolved_media"] = f"{_ASSIGNED} SELECT path, regexp_extract(path, '([^/]+)$', 1) AS filename, 'unable_to_determine_chat' AS reason FROM a WHERE chat_id IS NULL"
ORACLES["ingest_summary"] = ORACLES["media_assign"].replace("SELECT m.path,", ", a AS (SELECT m.path,", 1) + ") SELECT (SELECT count(*) FROM chats) AS chats, count(*) AS media, count(chat_id) AS resolved, count(*) FILTER (WHERE chat_id IS NULL) AS unresolved FROM a"
