"""Queries on the label loop and on distributions of units."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from threadline import dims
from threadline.functions import text as T
from threadline.operators import chat, distributions, labels, reports
from threadline.plans.frames import EVENTS_SQL, MASTER_SQL, MESSAGES_SQL, events, master, messages, read
from threadline.plans.text_queries import _FIRST, _TOKENS
from threadline.plans.text_queries import ORACLES as TEXT_ORACLES

RULES = labels.AuditRules(*(T.word_pattern(w) for w in (("from", "dans"), ("with", "avec"), ("the", "les"), ("for", "pour"), ("that", "que"))), "MEANS", "PLACE", "REASON", "OTHER")
ARTEFACTS = r"https?://[^ \t\n]+|<[^<>]*>"


def _units(s, d):
    return labels.unit_context(messages(s, d), "conv_id", "turn")


def answer(prompt: str) -> str:
    """A stand-in for a model: the number of signs decides; some answers are broken, some fail."""
    text = prompt.split("Complaint:\n", 1)[1].split("\n\nConversation:", 1)[0]
    n = len(text)
    if n % 11 == 0:
        raise RuntimeError("no answer")
    if n % 7 == 0:
        return "nothing to parse"
    label = ("PLACE", "MEANS", "STRANGE", "OTHER")[n % 4]
    return "```json\n" + json.dumps({"label": label, "confidence": str((n % 10) / 5), "reason": f"length {n}", "needs_new": n % 5 == 0})[:-1] + ",}\n```"


def _labelled(s, d):
    return labels.label_units(_units(s, d), "conv_id", dims.TAXONOMY, answer)


_UNITS = f"""{MESSAGES_SQL}, units AS (
  SELECT conv_id, coalesce(string_agg(trim(text), ' ' ORDER BY turn) FILTER (WHERE role = 'CLIENT' AND trim(coalesce(text, '')) <> ''), '') AS client_text,
         coalesce(string_agg('(' || role || ') ' || trim(text), chr(10) ORDER BY turn) FILTER (WHERE trim(coalesce(text, '')) <> ''), '') AS context, count(*) AS n_messages
  FROM msg GROUP BY 1
)"""
_LABELLED = f"""{_UNITS}, m AS (SELECT *, length(CASE WHEN trim(left(client_text, {labels.MAX_TEXT})) = '' THEN '(no text)' ELSE trim(left(client_text, {labels.MAX_TEXT})) END) AS n FROM units),
a AS (SELECT *, CASE WHEN n % 11 = 0 OR n % 7 = 0 THEN NULL ELSE (CASE n % 4 WHEN 0 THEN 'PLACE' WHEN 1 THEN 'MEANS' WHEN 2 THEN 'STRANGE' ELSE 'OTHER' END) END AS said FROM m),
labelled AS (
  SELECT conv_id, client_text, CASE WHEN said IS NULL OR said = 'STRANGE' THEN 'OTHER' ELSE said END AS label, CASE WHEN said IS NULL THEN 0.0::DOUBLE ELSE least((n % 10) / 5.0::DOUBLE, 1.0::DOUBLE) END AS confidence,
         CASE WHEN said IS NULL THEN false WHEN said = 'STRANGE' THEN true ELSE n % 5 = 0 END AS needs_new, CASE WHEN said = 'STRANGE' OR (said IS NOT NULL AND n % 5 = 0) THEN said END AS proposal,
         CASE WHEN said IS NOT NULL THEN 'length ' || n END AS evidence, coalesce({_FIRST.replace("lower(text)", "lower(client_text)")}, 'OTHER') AS rule_label, n % 11 = 0 AS failed
  FROM a
), flagged AS (SELECT *, label = rule_label AS agree, needs_new OR confidence < {labels.LEAST_CONFIDENCE}::DOUBLE OR label = 'OTHER' AS review FROM labelled)"""


def _sql_audit() -> str:
    hit = lambda p: f"regexp_matches(text, '{p}')"
    return f"""SELECT doc_id, rule, CASE WHEN rule <= 5 THEN 'WRONG' WHEN rule <= 9 THEN 'AMBIGUOUS' ELSE 'CONSISTENT' END AS verdict, signals FROM (
SELECT doc_id, (CASE WHEN label = 'MEANS' AND act AND net THEN 1 WHEN label = 'MEANS' AND act AND db THEN 2 WHEN label = 'PLACE' AND {hit(RULES.broken)} THEN 3 WHEN label = 'PLACE' AND asks AND NOT act THEN 4
  WHEN label = 'OTHER' AND act THEN 5 WHEN label = 'PLACE' AND db AND NOT act THEN 6 WHEN label = 'REASON' AND net AND NOT act THEN 7 WHEN label = 'MEANS' AND asks AND (net OR db OR act) THEN 8
  WHEN label IN ('MEANS', 'OTHER') AND length(trim(text)) < 12 THEN 9 ELSE 10 END)::INT AS rule, concat_ws(';', CASE WHEN net THEN 'network' END, CASE WHEN db THEN 'database' END, CASE WHEN act THEN 'active_problem' END) AS signals
FROM (SELECT doc_id, coalesce(text, '') AS text, (ARRAY['PLACE', 'MEANS', 'REASON', 'OTHER'])[1 + doc_id % 4] AS label, {hit(RULES.network)} AS net, {hit(RULES.database)} AS db, {hit(RULES.active)} AS act, {hit(RULES.question)} AS asks FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)))"""


def _audit(s, d):
    names = F.array(*[F.lit(x) for x in ("PLACE", "MEANS", "REASON", "OTHER")])
    docs = read(s, d, "documents").select("doc_id", "text", F.element_at(names, (F.col("doc_id") % 4 + 1).cast("int")).alias("label"))
    return docs.select("doc_id", labels.audit_label(F.col("label"), F.col("text"), RULES).alias("a")).select("doc_id", "a.*")


def _proposals(s, d):
    p = read(s, d, "part").select("p_partkey", F.when(F.col("p_size") % 4 == 0, F.lit("means ")).otherwise(F.concat(F.regexp_replace(F.lower("p_brand"), "[^a-z0-9]", "_"), F.lit(" "))).alias("n"), "p_type", F.split("p_name", " ").alias("k"))
    return p.select("p_partkey", labels.proposal_contract(F.col("n"), F.col("p_type"), F.col("k"), dims.TAXONOMY.names()).alias("p")).select("p_partkey", F.col("p.name").alias("name"), F.array_join("p.keywords", ",").alias("keywords"))


def _relabelled(s, d):
    base = read(s, d, "labels").select("doc_id", F.col("quality").cast("string").alias("old"))
    asked = read(s, d, "labels").where("doc_id % 3 <> 0").select("doc_id", F.col("toxic").cast("string").alias("new_label"))
    previous = read(s, d, "documents").where("doc_id % 2 = 0").select("doc_id", F.when(F.col("doc_id") % 5 == 0, "").otherwise("1").alias("previous_label"))
    return labels.relabelled(base, "doc_id", "old", asked, previous).groupBy("status", "final").agg(F.count(F.lit(1)).alias("n"))


def _chosen(s, d):
    base = read(s, d, "documents").select("doc_id", F.col("lang").alias("label"))
    final = read(s, d, "labels").where("doc_id % 4 = 0").select("doc_id", F.col("quality").cast("string").alias("label"))
    model = read(s, d, "labels").select("doc_id", F.col("toxic").cast("string").alias("label"))
    return labels.chosen_labels(base, "doc_id", final, model).groupBy("origin", "chosen").agg(F.count(F.lit(1)).alias("n"))


def _overridden(s, d):
    base = read(s, d, "documents").select("doc_id", F.col("lang").alias("label"))
    return labels.overridden(base, "doc_id", "label", read(s, d, "labels").select("doc_id", F.when(F.col("toxic") == 1, "toxic").alias("label"))).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def _dominant(s, d):
    return labels.dominant_words(read(s, d, "documents").where("text is not null and source is not null"), "source", T.tokens(T.clean_text(F.col("text"))), dims.STOP_WORDS)


def _units_of_events(s, d):
    """Session units with a response and media, from the events' master."""
    m = master(s, d)
    return m.select("user_id", "session_no", "category", "handling", "total_messages", F.when(F.col("client_messages") > 1, "RESPONSE").otherwise("NO_RESPONSE").alias("response"), (F.col("admin_messages") > 0).alias("has_media"), (F.col("total_messages") > 2).alias("has_credentials"))


_E = f"WITH {MASTER_SQL}, u AS (SELECT *, CASE WHEN client_messages > 1 THEN 'RESPONSE' ELSE 'NO_RESPONSE' END AS response, admin_messages > 0 AS has_media, total_messages > 2 AS has_credentials FROM master)"


def _distribution(s, d):
    m = messages(s, d)
    found = chat.response_labels(m, "conv_id", "turn", T.word_pattern(dims.CLOSING_WORDS), T.word_pattern(dims.WAITING_WORDS))
    return distributions.label_distribution(m.withColumn("src", F.col("conv_id") % 5), found, "conv_id", "response", "src")


def _rows(s, d):
    """Page rows with safe parsing, the number of all rows and pages."""
    found = reports.matching(read(s, d, "documents"), None, (), lang="en").select("doc_id", F.col("source").alias("raw"), F.col("n_chars").cast("string").alias("n"))
    return reports.page_with_totals(found, ["doc_id"], 2, 30).select("doc_id", T.safe_int(F.col("n")).alias("n"), T.safe_int(F.col("raw")).alias("bad"), "total", "pages")


QUERIES = {
    "unit_context": lambda s, d: _units(s, d),
    "label_units": lambda s, d: _labelled(s, d).select("conv_id", "label", "confidence", "evidence", "needs_new", "proposal", "rule_label", "agree", "review", F.col("error").isNotNull().alias("failed")),
    "label_summary": lambda s, d: labels.label_summary(_labelled(s, d)),
    "label_candidates": lambda s, d: labels.candidate_counts(_labelled(s, d), "client_text", ARTEFACTS),
    "label_prompt": lambda s, d: _units(s, d).select("conv_id", F.md5(labels.label_prompt(dims.TAXONOMY, F.col("client_text"), F.col("context")).cast("binary")).alias("prompt_md5")),
    "label_audit": lambda s, d: _audit(s, d),
    "audit_counts": lambda s, d: _audit(s, d).groupBy("verdict").agg(F.count(F.lit(1)).alias("n")),
    "proposal_contract": lambda s, d: _proposals(s, d),
    "relabelled": lambda s, d: _relabelled(s, d),
    "chosen_labels": lambda s, d: _chosen(s, d),
    "overridden_labels": lambda s, d: _overridden(s, d),
    "dominant_words": lambda s, d: _dominant(s, d).select("source", "rank", "word", "n"),
    "executive_summary": lambda s, d: distributions.executive_summary(_units_of_events(s, d), "user_id", "category"),
    "category_report": lambda s, d: distributions.category_report(_units_of_events(s, d), "category"),
    "series_kpis": lambda s, d: distributions.series_kpis(reports.time_series(master(s, d), "day", "category", "start_ts")),
    "highest_rate": lambda s, d: distributions.highest_rate(reports.breakdown(master(s, d), "category", share=True), "category"),
    "top_customers": lambda s, d: distributions.top_with_width(reports.breakdown(master(s, d), "user_id"), "user_id"),
    "gap_distribution": lambda s, d: distributions.gap_distribution(events(s, d).withColumn("src", F.col("user_id") % 10), ["src"], ["ts", "event_id"]),
    "size_distribution": lambda s, d: distributions.size_distribution(master(s, d), "total_messages"),
    "label_distribution": lambda s, d: _distribution(s, d),
    "role_conflicts": lambda s, d: distributions.role_conflicts(events(s, d).select(F.col("user_id").cast("string").alias("sender"), "role")),
    "page_rows": lambda s, d: _rows(s, d),
    "multi_label_counts": lambda s, d: read(s, d, "documents").select(F.explode(T.all_categories(F.col("text"), dims.TAXONOMY)).alias("category")).groupBy("category").agg(F.count(F.lit(1)).alias("n")),
    "display_names": lambda s, d: read(s, d, "documents").select("doc_id", T.clean_category(F.col("lang")).alias("category"), T.display_name(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" "), "lang")).otherwise(F.lit("  ")), F.coalesce("source", F.lit("none"))).alias("customer")),
    "handling_spellings": lambda s, d: read(s, d, "documents").select("doc_id", T.handling_status(F.element_at(F.array(*[F.lit(x) for x in (" remote ", "T", "ya", "1", "tidak", "F", "non-remote", "0", "y", "NON REMOTE", "")]), (F.col("doc_id") % 11 + 1).cast("int"))).alias("handling")),
    "parse_times": lambda s, d: read(s, d, "events").select("event_id", F.date_format(T.parse_time(F.element_at(F.array(*[F.date_format("ts", f) for f in ("dd/MM/yy HH.mm", "dd/MM/yyyy HH.mm", "dd/MM/yy HH:mm", "dd/MM/yyyy HH:mm", "yyyy-MM-dd HH:mm")]), (F.col("event_id") % 5 + 1).cast("int"))), "yyyy-MM-dd HH:mm").alias("at")),
    "suffix_letters": lambda s, d: read(s, d, "orders").select("o_orderkey", T.letters_suffix(F.col("o_orderkey") % 20000).alias("suffix"), T.parent_id(F.when(F.col("o_orderkey") % 2 == 0, F.lit("c")), F.concat(F.lit("a_b_"), F.col("o_orderkey").cast("string"))).alias("parent")),
    "softmax_confidence": lambda s, d: read(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.array_max(T.softmax(F.array(F.col("l_tax") * 10, F.col("l_discount") * 10, F.lit(0.5)))).alias("confidence")),
    "transcripts": lambda s, d: chat.transcript_rows(messages(s, d).withColumn("no_time", F.lit("1/1/24 9.00")).groupBy("conv_id").agg(chat.transcript("turn", "no_time", "role", "text").alias("transcript")), "conv_id"),
}
_CAT = "CASE WHEN lang IS NULL OR lower(trim(lang)) IN ('', 'nan', 'none', 'null', 'unknown', 'unclassified') THEN 'UNKNOWN_UNCLASSIFIED' ELSE trim(lang) END"
_HEAD = "\n".join(["Categories:", *(f"- {c.name}: {c.definition}" for c in dims.TAXONOMY.categories), "- OTHER: none of the above", "", "Examples:", "", "Complaint:"]) + "\n"
ORACLES = {
    "unit_context": f"WITH {_UNITS} SELECT * FROM units",
    "label_units": f"WITH {_LABELLED} SELECT conv_id, label, confidence, evidence, needs_new, proposal, rule_label, agree, review, failed FROM flagged",
    "label_summary": f"WITH {_LABELLED} SELECT label, count(*) AS n, count(*) FILTER (WHERE agree) AS agree, count(*) FILTER (WHERE review) AS review, avg(confidence) AS mean_confidence FROM flagged GROUP BY 1",
    "label_candidates": f"WITH {_LABELLED} SELECT count(*) FILTER (WHERE review) AS flagged, count(*) FILTER (WHERE review AND client_text <> '') AS with_text, count(*) FILTER (WHERE review AND trim(regexp_replace(client_text, '{ARTEFACTS}', ' ', 'g')) <> '') AS usable FROM flagged",
    "label_prompt": f"WITH {_UNITS} SELECT conv_id, md5('{_HEAD}' || CASE WHEN trim(left(client_text, 2000)) = '' THEN '(no text)' ELSE trim(left(client_text, 2000)) END || CASE WHEN trim(context) <> '' THEN chr(10) || chr(10) || 'Conversation:' || chr(10) || left(trim(context), 2000) ELSE '' END) AS prompt_md5 FROM units",
    "label_audit": _sql_audit(),
    "audit_counts": f"SELECT verdict, count(*) AS n FROM ({_sql_audit()}) GROUP BY 1",
    "proposal_contract": """WITH p AS (SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'MEANS' ELSE upper(regexp_replace(lower(p_brand), '[^a-z0-9]', '_', 'g')) END AS name, p_type, list_filter(list_transform(string_split(p_name, ' '), lambda k: trim(regexp_replace(lower(k), '[^a-z0-9_ ]', '', 'g'))), lambda k: k <> '') AS k FROM part),
q AS (SELECT *, list_filter(k, lambda x, i: list_position(k, x) = i) AS keywords FROM p), r AS (SELECT *, regexp_matches(name, '^[A-Z][A-Z0-9_]{2,}$') AND name NOT IN ('PLACE', 'MEANS', 'REASON', 'OTHER') AND length(trim(p_type)) >= 10 AND len(keywords) >= 2 AS sound FROM q)
SELECT p_partkey, CASE WHEN sound THEN name END AS name, CASE WHEN sound THEN array_to_string(keywords, ',') END AS keywords FROM r""",
    "relabelled": """WITH x AS (SELECT l.doc_id, l.quality::VARCHAR AS o, CASE WHEN l.doc_id % 3 <> 0 THEN l.toxic::VARCHAR END AS n, CASE WHEN d.doc_id % 2 = 0 AND d.doc_id % 5 <> 0 THEN '1' END AS p FROM labels l LEFT JOIN documents d USING (doc_id)),
y AS (SELECT *, CASE WHEN n IS NULL OR n = o THEN 'KEEP' WHEN n = p THEN 'UPDATE' ELSE 'REVIEW' END AS status FROM x) SELECT status, CASE WHEN status = 'UPDATE' THEN n ELSE o END AS final, count(*) AS n FROM y GROUP BY ALL""",
    "chosen_labels": "WITH x AS (SELECT d.lang, l.quality::VARCHAR AS q, l.toxic::VARCHAR AS t, d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id)) SELECT CASE WHEN doc_id % 4 = 0 AND q IS NOT NULL THEN 'final' WHEN t IS NOT NULL THEN 'model' ELSE 'existing' END AS origin, CASE WHEN doc_id % 4 = 0 AND q IS NOT NULL THEN q WHEN t IS NOT NULL THEN t ELSE lang END AS chosen, count(*) AS n FROM x GROUP BY 1, 2",
    "overridden_labels": "SELECT CASE WHEN l.toxic = 1 THEN 'toxic' ELSE d.lang END AS label, count(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1",
    "dominant_words": f"WITH t AS (SELECT source, unnest({_TOKENS}) AS word FROM documents WHERE text IS NOT NULL AND source IS NOT NULL), c AS (SELECT source, word, count(*) AS n FROM t WHERE length(word) > 2 AND word NOT IN {dims.STOP_WORDS} GROUP BY 1, 2), r AS (SELECT source, (row_number() OVER (PARTITION BY source ORDER BY n DESC, word))::INT AS rank, word, n FROM c) SELECT * FROM r WHERE rank <= 3",
    "executive_summary": f"""{_E}, a AS (SELECT count(*) AS n, count(DISTINCT user_id) AS c, count(*) FILTER (WHERE response = 'RESPONSE') AS r, count(*) FILTER (WHERE handling = 'REMOTE') AS h, count(*) FILTER (WHERE has_media) AS m, count(*) FILTER (WHERE has_credentials) AS k FROM u),
s AS (SELECT n, unnest(['units', 'conversations', 'responded', 'not_responded', 'remote', 'not_remote', 'with_media', 'with_credentials']) AS metric, unnest([n, c, r, n - r, h, n - h, m, k]) AS value FROM a) SELECT metric, value, value * 100.0::DOUBLE / n AS percent FROM s""",
    "category_report": f"{_E} SELECT category, count(*) AS total, count(*) FILTER (WHERE handling = 'REMOTE') AS remote, count(*) FILTER (WHERE handling = 'REMOTE') * 100.0::DOUBLE / count(*) AS remote_percent, count(*) FILTER (WHERE handling <> 'REMOTE') AS not_remote, count(*) FILTER (WHERE response = 'RESPONSE') AS responded, count(*) FILTER (WHERE response <> 'RESPONSE') AS not_responded, avg(total_messages) AS mean_messages FROM u GROUP BY 1",
    "series_kpis": f"WITH {MASTER_SQL}, c AS (SELECT strftime(start_ts, '%Y-%m-%d') AS period, count(*) AS total FROM master GROUP BY 1) SELECT sum(total)::BIGINT AS total, avg(total) AS mean, (SELECT period FROM c ORDER BY total DESC, period LIMIT 1) AS peak, max(total) AS peak_total FROM c",
    "highest_rate": f"WITH {MASTER_SQL}, c AS (SELECT category, count(*) AS total, count(*) FILTER (WHERE handling = 'REMOTE') AS r, count(*) FILTER (WHERE handling = 'NON_REMOTE') AS o FROM master GROUP BY 1) SELECT category, CASE WHEN r + o > 0 THEN r * 100.0::DOUBLE / (r + o) ELSE 0.0 END AS rate, total FROM c WHERE category <> 'UNKNOWN_UNCLASSIFIED' AND total * 100.0 / (SELECT sum(total) FROM c) >= 3 ORDER BY rate DESC, category LIMIT 1",
    "top_customers": f"WITH {MASTER_SQL}, c AS (SELECT user_id, count(*) AS total FROM master GROUP BY 1 ORDER BY total DESC, user_id LIMIT 10) SELECT user_id, total, total::DOUBLE / max(total) OVER () AS width FROM c",
    "gap_distribution": f"WITH {EVENTS_SQL}, g AS (SELECT user_id % 10 AS src, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id % 10 ORDER BY ts, event_id))) / 60000000::DOUBLE AS m FROM ev), k AS (SELECT * FROM g WHERE m >= 0), w AS (SELECT src, min(m) AS least, max(m) AS largest, avg(m) AS mean FROM k GROUP BY 1), b AS (SELECT src, (CASE " + " ".join(f"WHEN m < {x} THEN {i}" for i, x in enumerate(distributions.GAP_MINUTES[1:])) + " ELSE 12 END)::INT AS bucket, count(*) AS n FROM k GROUP BY 1, 2) SELECT * FROM b JOIN w USING (src)",
    "size_distribution": f"WITH {MASTER_SQL} SELECT count(*) AS conversations, min(total_messages) AS least, max(total_messages) AS largest, " + ", ".join(f"count(*) FILTER (WHERE total_messages >= {a}{f' AND total_messages <= {b}' if b else ''}) AS from_{a}" for a, b in distributions.SIZE_CLASSES) + " FROM master",
    "role_conflicts": f"WITH {EVENTS_SQL} SELECT user_id::VARCHAR AS sender, string_agg(DISTINCT role, ',' ORDER BY role) AS roles, count(DISTINCT role) AS n FROM ev GROUP BY 1 HAVING count(DISTINCT role) > 1",
    "page_rows": "WITH f AS (SELECT doc_id, n_chars FROM documents WHERE lang = 'en') SELECT doc_id, n_chars::INT AS n, 0::INT AS bad, (SELECT count(*) FROM f) AS total, ceil((SELECT count(*) FROM f) / 30.0)::BIGINT AS pages FROM f ORDER BY doc_id LIMIT 30 OFFSET 30",
    "multi_label_counts": "SELECT category, count(*) AS n FROM (SELECT unnest(string_split(categories, ',')) AS category FROM (" + TEXT_ORACLES["all_categories"] + ")) GROUP BY 1",
    "display_names": f"SELECT doc_id, {_CAT} AS category, CASE WHEN doc_id % 2 = 0 AND lang IS NOT NULL THEN trim(lang) ELSE 'Unknown (' || coalesce(source, 'none') || ')' END AS customer FROM documents",
    "handling_spellings": "SELECT doc_id, CASE WHEN doc_id % 11 < 4 THEN 'REMOTE' WHEN doc_id % 11 < 8 THEN 'NON_REMOTE' ELSE 'UNKNOWN' END AS handling FROM documents",
    "parse_times": "SELECT event_id, CASE WHEN event_id % 5 < 4 THEN strftime(ts, '%Y-%m-%d %H:%M') END AS at FROM events",
    "suffix_letters": "WITH o AS (SELECT o_orderkey, o_orderkey % 20000 AS n FROM orders) SELECT o_orderkey, CASE WHEN n < 26 THEN chr((97 + n)::INT) WHEN n < 702 THEN chr((97 + (n - 26) // 26)::INT) || chr((97 + n % 26)::INT) WHEN n < 18278 THEN chr((97 + (n - 702) // 676)::INT) || chr((97 + (n - 702) // 26 % 26)::INT) || chr((97 + n % 26)::INT) ELSE chr((97 + (n - 18278) // 17576)::INT) || chr((97 + (n - 18278) // 676 % 26)::INT) || chr((97 + (n - 18278) // 26 % 26)::INT) || chr((97 + n % 26)::INT) END AS suffix, CASE WHEN o_orderkey % 2 = 0 THEN 'c' ELSE 'a_b' END AS parent FROM o",
    "softmax_confidence": "WITH x AS (SELECT l_orderkey, l_linenumber, l_tax * 10 AS a, l_discount * 10 AS b, 0.5::DOUBLE AS c, greatest(l_tax * 10, l_discount * 10, 0.5) AS m FROM lineitem) SELECT l_orderkey, l_linenumber, 1.0::DOUBLE / (exp(a - m) + exp(b - m) + exp(c - m)) AS confidence FROM x",
    "transcripts": f"WITH {MESSAGES_SQL} SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS piece, '1/1/24 9.00' AS time, role, regexp_replace(coalesce(text, ''), '[\\r\\n]+', ' ', 'g') AS text FROM msg",
}
_RESPONSES = TEXT_ORACLES["response_label"]
ORACLES["label_distribution"] = f"""WITH r AS ({_RESPONSES}), j AS (SELECT c.conv_id, r.response, count(*) AS n FROM conversations c JOIN r ON r.conv_id = c.conv_id GROUP BY 1, 2)
SELECT 'conversation' AS level, NULL::VARCHAR AS source, response AS label, count(*)::BIGINT AS n FROM j GROUP BY 3 UNION ALL SELECT 'message', NULL, response, sum(n)::BIGINT FROM j GROUP BY 3
UNION ALL SELECT 'source', (conv_id % 5)::VARCHAR, response, count(*) FROM j GROUP BY 2, 3"""
