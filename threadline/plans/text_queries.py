"""Queries on conversations and documents: roles, labels, text, features, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadline import dims
from threadline.functions import text as T
from threadline.operators import chat, dictionary, distributions, features, labels, profile, reports, scans
from threadline.plans.frames import MESSAGES_SQL, messages, read

_W = r"\p{L}\p{N}_"


def _words(words: tuple[str, ...]) -> str:
    return f"regexp_matches(lower(text), '{T.word_pattern(words)}')"


_CREDENTIAL = f"regexp_matches(lower(text), '{T.credential_pattern(dims.CREDENTIAL_WORDS)}')"
_FIRST = "CASE " + " ".join(f"WHEN regexp_matches(lower(text), '{T.category_pattern(c)}') THEN '{c.name}'" for c in dims.TAXONOMY.categories) + " END"
_ALL = ", ".join(f"CASE WHEN regexp_matches(lower(text), '{T.category_pattern(c)}') THEN '{c.name}' END" for c in dims.TAXONOMY.categories)
_CLEAN = "lower(text)"
for _p in T.CLEAN_PATTERNS:
    _CLEAN = f"regexp_replace({_CLEAN}, '{_p}', ' ', 'g')"
_CLEAN = f"trim({_CLEAN})"
_TOKENS = f"list_filter(string_split({_CLEAN}, ' '), lambda t: t <> '')"
_TERMS = f"""toks AS (SELECT doc_id, {_TOKENS} AS w FROM documents WHERE text IS NOT NULL),
grams AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM toks),
tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY ALL),
voc AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 2 ORDER BY total DESC, term LIMIT 400),
raw AS (SELECT tf.doc_id, tf.term, (1 + ln(tf.tf)) * (ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (voc.df + 1)) + 1) AS w FROM tf JOIN voc USING (term)),
norm AS (SELECT doc_id, sqrt(sum(w * w)) AS n FROM raw GROUP BY doc_id),
weights AS (SELECT raw.doc_id, raw.term, raw.w / norm.n AS weight FROM raw JOIN norm USING (doc_id))"""


def _cleaned(s, d, keep=()):
    """Cleaned texts, written once; dealt by id, as a small table may be one file."""
    docs = read(s, d, "documents").where("text is not null").select("doc_id", *keep, "text").repartition("doc_id")
    return features.written(docs.select("doc_id", *keep, T.clean_text(F.col("text")).alias("cleaned")))


def _vectors(s, d, min_docs=2, most=400, sublinear=True, keep=()):
    """Feature vectors of all documents, and their vocabulary."""
    docs = _cleaned(s, d, keep)
    known = features.vocabulary(docs, F.col("cleaned"), min_docs, most)
    return features.vectors(docs, "doc_id", "cleaned", known, read(s, d, "documents").count(), sublinear, keep), known


def _weights(s, d, keep=()):
    return features.term_weights(*_vectors(s, d, keep=keep))


def _cluster_vectors(s, d):
    """Vectors by the reference's cluster settings: 2,000 terms, also those of one document, plain counts."""
    return _vectors(s, d, 1, 2000, False)[0]


def _clustered(s, d):
    """(doc_id, cluster) of all documents; one near no other is a cluster of its own."""
    found = features.cosine_clusters(_cluster_vectors(s, d), "doc_id", _CLUSTER_LEAST)
    docs = read(s, d, "documents").select("doc_id").join(found, F.col("doc_id") == F.col("id"), "left")
    return docs.select("doc_id", F.coalesce("cluster", "doc_id").alias("cluster"))


def _cluster_report(s, d):
    """Clusters with their longest text; documents of blanks only are the residual row."""
    texts = read(s, d, "documents").select("doc_id", "text")
    with_text = texts.where(F.trim("text") != "").select("doc_id")
    report = labels.cluster_report(texts, _clustered(s, d).join(with_text, "doc_id", "left_semi"), "doc_id", "text")
    return report.select("cluster", "members", "first_member", F.md5(F.col("sample").cast("binary")).alias("sample_md5"))


def _senders(s, d):
    """Sources, some in capitals, and names of parts as senders."""
    spelt = F.when(F.col("n_chars") % 2 == 0, F.upper("source")).otherwise(F.col("source"))
    return read(s, d, "documents").select(spelt.alias("sender")).union(read(s, d, "part").select("p_name"))


def _chat_master(s, d):
    """The full master of the conversations: a turn an hour, with four more after every third; texts that ask count as media."""
    hours = F.expr("make_interval(0, 0, 0, 0, cast(turn + turn div 3 * 4 as int))")
    rows = messages(s, d).select(F.format_string("chat_%d.txt", "conv_id").alias("source_file"), F.col("turn").alias("msg_no"), (F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")) + hours).alias("ts"), "role", "text", F.coalesce(F.col("text").contains("?"), F.lit(False)).alias("has_media"))
    out = distributions.full_master(rows, dims.TAXONOMY, T.word_pattern(dims.REMOTE_WORDS), T.credential_pattern(dims.CREDENTIAL_WORDS), T.word_pattern(dims.CLOSING_WORDS), T.word_pattern(dims.WAITING_WORDS))
    return out.withColumn("transcript_md5", F.md5(F.col("transcript").cast("binary"))).drop("transcript")


def _top_grams(s, d, most):
    """The commonest n-grams of some sizes."""
    return features.top_grams(_cleaned(s, d), F.col("cleaned"), dict(most))


def _explored(s, d):
    """The tokens that exploration looks at, by language, with the number of texts that have none."""
    words = T.explore_tokens(F.col("text"), dims.STOP_WORDS)
    sized = read(s, d, "documents").where("text is not null").select("lang", F.size(words).alias("n"), F.size(F.array_distinct(words)).alias("m"))
    return sized.groupBy("lang").agg(F.sum("n").alias("tokens"), F.sum("m").alias("distinct_in_text"), F.count_if(F.col("n") == 0).alias("empty"))


def _labels(s, d):
    return read(s, d, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))


def _guess(s, d):
    """A rule as a classifier: short documents are called low quality."""
    docs = read(s, d, "documents").select("doc_id", F.when(F.length("text") < 500, "0").otherwise("1").alias("guess"))
    return _labels(s, d).join(docs, "doc_id")


_LEAST = 0.9
_CLUSTER_LEAST = 0.3
_TOP_GRAMS = ((1, 15), (2, 10), (3, 10))
def _by_tables(s, d):
    """Documents normalised by tables that are made of their own words: domain words of five letters, general ones of six to eight, protected ones of nine."""
    docs = features.written(read(s, d, "documents").repartition("doc_id").select("doc_id", T.clean_text(F.col("text")).alias("c")))
    words = features.materialised(features.gram_totals(docs, F.col("c"), (1,)).select(F.col("term").alias("word")))
    size = F.length("word")
    domain = words.where(size == 5).select("word", F.concat(F.lit("d"), "word").alias("replacement"))
    general = words.where(size.between(6, 8)).select("word", F.substring("word", 1, 5).alias("replacement"))
    table = dictionary.dictionary(domain, general, words.where(size == 9).select("word"))
    return dictionary.normalised_by_table(docs, "doc_id", "c", table)


def _normalised_sql(tables: str) -> str:
    """CTE ``normal`` (doc_id, normalised, changed) by the cascade, given CTEs dom(word, r), gen(word, r) and pro(word) over tok."""
    return f"""toks AS (SELECT doc_id, {_TOKENS} AS ts FROM documents), tok AS (SELECT doc_id, unnest(ts) AS t, generate_subscripts(ts, 1) AS pos FROM toks),
{tables},
shorts AS (SELECT t, array_to_string(list_transform(list_filter(range(1, len(c) + 1), lambda i: i = 1 OR c[i] <> c[i - 1] OR NOT (coalesce(c[i - 2] = c[i], false) OR coalesce(c[i + 1] = c[i], false))), lambda i: c[i]), '') AS s FROM (SELECT t, string_split(t, '') AS c FROM (SELECT DISTINCT t FROM tok))),
news AS (SELECT h.t, coalesce(CASE WHEN pt.word IS NOT NULL THEN h.t END, dt.r, CASE WHEN ps.word IS NOT NULL THEN h.s END, ds.r, gs.r, gt.r, h.s) AS new
  FROM shorts h LEFT JOIN pro pt ON pt.word = h.t LEFT JOIN pro ps ON ps.word = h.s LEFT JOIN dom dt ON dt.word = h.t LEFT JOIN dom ds ON ds.word = h.s LEFT JOIN gen gs ON gs.word = h.s LEFT JOIN gen gt ON gt.word = h.t),
joined AS (SELECT doc_id, string_agg(new, ' ' ORDER BY pos) AS normalised, count(*) FILTER (WHERE new <> tok.t) AS changed FROM tok JOIN news ON tok.t = news.t GROUP BY doc_id),
normal AS (SELECT k.doc_id, CASE WHEN k.ts IS NOT NULL THEN coalesce(normalised, '') END AS normalised, CASE WHEN k.ts IS NOT NULL THEN coalesce(changed, 0) END AS changed FROM toks k LEFT JOIN joined j ON j.doc_id = k.doc_id)"""


QUERIES = {
    "role_assign": lambda s, d: messages(s, d).groupBy("sender", "role").agg(F.count(F.lit(1)).alias("n")),
    "unmapped_senders": lambda s, d: chat.unmapped_senders(messages(s, d), s.range(1).select(F.explode(F.array(F.lit("user"), F.lit("assistant"))).alias("sender"))),
    "role_mix": lambda s, d: messages(s, d).groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"), F.count(F.lit(1)).alias("n")),
    "content_flags": lambda s, d: messages(s, d).agg(
        F.count_if(F.col("text").rlike("https?://")).alias("links"), F.count_if(F.length(F.trim("text")).between(1, 5)).alias("very_short"), F.count_if(F.col("text").contains("?")).alias("questions"),
        F.count_if(T.holds_any(F.col("text"), T.OMITTED_MARKS)).alias("omitted"), F.count_if(F.col("text").contains(T.ATTACHED_MARK)).alias("attached"),
        F.count_if(T.holds_any(F.col("text"), T.DELETED_MARKS)).alias("deleted"), F.count_if(F.col("role") == "SYSTEM").alias("system")),
    "length_profile": lambda s, d: profile.length_profile(messages(s, d), "text", "role"),
    "duplicate_messages": lambda s, d: chat.exact_duplicates(read(s, d, "documents"), ["source", "text"], "doc_id"),
    "similar_names": lambda s, d: profile.similar_names(read(s, d, "part").select("p_name").union(read(s, d, "documents").select("source")), "p_name"),
    "mention_flags": lambda s, d: chat.handling_labels(messages(s, d), "conv_id", T.word_pattern(dims.REMOTE_WORDS), T.credential_pattern(dims.CREDENTIAL_WORDS)),
    "response_label": lambda s, d: chat.response_labels(messages(s, d), "conv_id", "turn", T.word_pattern(dims.CLOSING_WORDS), T.word_pattern(dims.WAITING_WORDS)),
    "topic_split": lambda s, d: chat.split_topics(messages(s, d), ["conv_id"], ["turn"], dims.TAXONOMY).select("conv_id", "turn", "segment", "category"),
    "topic_slices": lambda s, d: scans.topics_by_slice(messages(s, d), ["conv_id"], ["turn"], F.expr("turn div 3"), dims.TAXONOMY).select("conv_id", "turn", "segment", "category"),
    "topic_summary": lambda s, d: chat.split_topics(messages(s, d), ["conv_id"], ["turn"], dims.TAXONOMY).groupBy("conv_id", "segment", "category").agg(F.count(F.lit(1)).alias("n")),
    "first_category": lambda s, d: read(s, d, "documents").select("doc_id", T.category_or_fallback(F.col("text"), dims.TAXONOMY).alias("category")),
    "all_categories": lambda s, d: read(s, d, "documents").select("doc_id", F.array_join(T.all_categories(F.col("text"), dims.TAXONOMY), ",").alias("categories")),
    "client_text": lambda s, d: chat.client_text(messages(s, d), "conv_id", "turn"),
    "clean_text": lambda s, d: read(s, d, "documents").select("doc_id", F.md5(T.clean_text(F.col("text")).cast("binary")).alias("clean_md5")),
    "token_count": lambda s, d: read(s, d, "documents").select("source", F.size(T.tokens(T.clean_text(F.col("text")))).alias("n")).groupBy("source").agg(F.sum("n").alias("tokens"), F.min("n").alias("least"), F.max("n").alias("most"), F.count_if(F.col("n") == 0).alias("empty")),
    "token_statistics": lambda s, d: read(s, d, "documents").select(F.size(T.tokens(T.clean_text(F.coalesce("text", F.lit(""))))).alias("n")).agg(F.count(F.lit(1)).alias("texts"), F.avg("n").alias("mean"), F.min("n").alias("least"), F.max("n").alias("most"), F.count_if(F.col("n") == 0).alias("empty")),
    "explore_tokens": lambda s, d: _explored(s, d),
    "token_normalise": lambda s, d: T.normalised_texts(read(s, d, "documents").select("doc_id", T.clean_text(F.col("text")).alias("c")), "c", dims.SLANG, dims.GENERAL_WORDS, dims.PROTECTED).select("doc_id", "changed", F.md5(F.col("normalised").cast("binary")).alias("normal_md5")),
    "dictionary_normalise": lambda s, d: _by_tables(s, d).select("doc_id", "changed", F.md5(F.col("normalised").cast("binary")).alias("normal_md5")),
    "dictionary_coverage": lambda s, d: dictionary.coverage(_by_tables(s, d)),
    "normalise_coverage": lambda s, d: T.normalised_texts(read(s, d, "documents").select("doc_id", T.clean_text(F.col("text")).alias("c")), "c", dims.SLANG, dims.GENERAL_WORDS, dims.PROTECTED).agg(F.sum("changed").alias("words_changed"), F.count_if(F.col("changed") > 0).alias("texts_changed"), (F.count_if(F.col("changed") > 0) * 100.0 / F.count(F.lit(1))).alias("percent")),
    "ngram_top": lambda s, d: _top_grams(s, d, ((2, 15),)).select("term", "n"),
    "tfidf_terms": lambda s, d: features.feature_summary(_weights(s, d), read(s, d, "documents").count()),
    "top_terms_by_label": lambda s, d: features.top_terms(_weights(s, d, ("lang",)).where("lang is not null").withColumnRenamed("lang", "label"), read(s, d, "documents").select("doc_id", F.col("lang").alias("label")).where("label is not null"), "doc_id", "label"),
    "cosine_pairs": lambda s, d: features.near_pairs(features.written(_vectors(s, d)[0]), "doc_id", _LEAST, scores=False).select("a", "b"),
    "cluster_pairs": lambda s, d: features.near_pairs(features.written(_cluster_vectors(s, d)), "doc_id", _CLUSTER_LEAST, scores=False).select("a", "b"),
    "clusters": lambda s, d: _clustered(s, d).groupBy("cluster").agg(F.count(F.lit(1)).alias("members")),
    "cluster_report": lambda s, d: _cluster_report(s, d),
    "similar_senders": lambda s, d: profile.alike_senders(_senders(s, d), "sender", ("src0",)),
    "chat_master": lambda s, d: _chat_master(s, d),
    "ngram_top_lists": lambda s, d: _top_grams(s, d, _TOP_GRAMS),
    "confusion": lambda s, d: _guess(s, d).groupBy("label", "guess").agg(F.count(F.lit(1)).alias("n")),
    "class_metrics": lambda s, d: reports.class_metrics(_guess(s, d), "label", "guess"),
    "summary_metrics": lambda s, d: reports.summary_metrics(reports.class_metrics(_guess(s, d), "label", "guess")),
    "relabel_decision": lambda s, d: read(s, d, "labels").select("doc_id", T.decide_status(F.col("quality"), F.col("toxic"), F.lit(1)).alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n")),
    "rule_label": lambda s, d: chat.document_labels(read(s, d, "documents"), dims.TAXONOMY).groupBy("label", "confidence").agg(F.count(F.lit(1)).alias("n")),
    "json_contract": lambda s, d: read(s, d, "events").select("event_id", T.first_json(F.concat(F.lit("```json\n"), F.regexp_replace("props", r"\}$", ",}"), F.lit("\n```")), "k int").alias("j")).select("event_id", F.col("j.k").alias("k")),
    "customer_name": lambda s, d: read(s, d, "customer").select("c_custkey", T.customer_from_file(F.element_at(F.array(
        F.concat(F.lit("WhatsApp Chat - "), "c_name", F.lit(".txt")), F.concat(F.lit("in/Obrolan WhatsApp dengan "), "c_name", F.lit(".txt")), F.concat(F.lit("chat_"), "c_custkey", F.lit(".txt")),
        F.concat(F.lit("a/b/"), "c_name", F.lit(".zip")), F.lit("WhatsApp_Export.txt"), F.concat(F.lit("Chat with  "), "c_mktsegment", F.lit(".txt"))), (F.col("c_custkey") % 6 + 1).cast("int"))).alias("customer")),
    "group_split": lambda s, d: _group_split(s, d),
    "search": lambda s, d: reports.matching(read(s, d, "documents"), "this work is", ("text", "source"), lang="en").select("doc_id"),
}


def _group_split(s, d):
    from threadline.operators.learn import group_split

    return group_split(read(s, d, "documents"), "source").select("doc_id", "split")


ORACLES = {
    "role_assign": f"WITH {MESSAGES_SQL} SELECT sender, role, count(*) AS n FROM msg GROUP BY ALL",
    "unmapped_senders": f"WITH {MESSAGES_SQL} SELECT DISTINCT sender FROM msg WHERE sender NOT IN ('user', 'assistant')",
    "role_mix": f"WITH {MESSAGES_SQL} SELECT conv_id, string_agg(DISTINCT role, ',' ORDER BY role) AS roles, count(*) AS n FROM msg GROUP BY 1",
    "content_flags": "SELECT count(*) FILTER (WHERE regexp_matches(text, 'https?://')) AS links, count(*) FILTER (WHERE length(trim(text)) BETWEEN 1 AND 5) AS very_short, count(*) FILTER (WHERE contains(text, '?')) AS questions, " + ", ".join(
        f"count(*) FILTER (WHERE {' OR '.join(f'contains(text, {chr(39)}{m}{chr(39)})' for m in marks)}) AS {name}" for name, marks in (("omitted", T.OMITTED_MARKS), ("attached", (T.ATTACHED_MARK,)), ("deleted", T.DELETED_MARKS))
    ) + ", count(*) FILTER (WHERE role = 'system') AS system FROM conversations",
    "length_profile": f"WITH {MESSAGES_SQL}, l AS (SELECT role, length(text) AS len, row_number() OVER (PARTITION BY role ORDER BY length(text)) AS i, count(*) OVER (PARTITION BY role) AS n FROM msg) SELECT role, avg(len) AS mean_len, min(len)::INT AS min_len, max(len)::INT AS max_len, count(*) FILTER (WHERE len < 10) AS from_0, count(*) FILTER (WHERE len >= 10 AND len < 50) AS from_10, count(*) FILTER (WHERE len >= 50 AND len < 100) AS from_50, count(*) FILTER (WHERE len >= 100 AND len < 500) AS from_100, count(*) FILTER (WHERE len >= 500 AND len < 2000) AS from_500, count(*) FILTER (WHERE len >= 2000) AS from_2000, max(len) FILTER (WHERE i = n // 2 + 1)::INT AS median FROM l GROUP BY role",
    "duplicate_messages": "SELECT doc_id, first_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY source, text) AS first_id FROM documents) WHERE doc_id <> first_id",
    "similar_names": "WITH n AS (SELECT DISTINCT lower(trim(p_name)) AS name FROM (SELECT p_name FROM part UNION ALL SELECT source FROM documents) WHERE length(lower(trim(p_name))) >= 3) SELECT a.name AS short, b.name AS long FROM n a JOIN n b ON a.name <> b.name AND contains(b.name, a.name)",
    "mention_flags": f"SELECT conv_id, CASE WHEN bool_or({_words(dims.REMOTE_WORDS)} OR {_CREDENTIAL}) THEN 'REMOTE' ELSE 'NON_REMOTE' END AS handling, count(*) FILTER (WHERE {_CREDENTIAL}) AS credential_rows FROM conversations GROUP BY 1",
    "response_label": f"""WITH {MESSAGES_SQL}, f AS (SELECT conv_id, turn, role, {_words(dims.CLOSING_WORDS)} AS closing, contains(text, '?') AS asks, {_words(dims.WAITING_WORDS)} AS waits, length(trim(lower(text))) <= 30 AS short, max(CASE WHEN role = 'CLIENT' THEN turn END) OVER (PARTITION BY conv_id) AS client FROM msg),
g AS (SELECT conv_id, max(client) AS client, count(*) FILTER (WHERE role = 'ADMIN') AS admins, arg_max(role, turn) AS last_role, arg_max(closing AND NOT asks AND NOT waits, turn) AS closed, coalesce(bool_and(short OR closing) FILTER (WHERE turn > client), true) AS brief, coalesce(bool_or(asks OR waits) FILTER (WHERE turn > client), false) AS open FROM f GROUP BY 1)
SELECT conv_id, CASE WHEN client IS NULL THEN 'NO_RESPONSE' WHEN admins = 0 OR last_role = 'CLIENT' OR closed OR (brief AND NOT open) THEN 'RESPONSE' ELSE 'NO_RESPONSE' END AS response FROM g""",
    "first_category": f"SELECT doc_id, coalesce({_FIRST}, 'OTHER') AS category FROM documents",
    "all_categories": f"SELECT doc_id, coalesce(nullif(concat_ws(',', {_ALL}), ''), 'OTHER') AS categories FROM documents",
    "client_text": f"WITH {MESSAGES_SQL} SELECT conv_id, coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (WHERE role = 'CLIENT'), string_agg(text, ' ' ORDER BY turn)) AS client_text, count(*) AS n_rows FROM msg WHERE text IS NOT NULL GROUP BY 1",
    "clean_text": f"SELECT doc_id, md5({_CLEAN}) AS clean_md5 FROM documents",
    "token_statistics": f"SELECT count(*) AS texts, avg(n) AS mean, min(n)::INT AS least, max(n)::INT AS most, count(*) FILTER (WHERE n = 0) AS empty FROM (SELECT coalesce(len({_TOKENS}), 0) AS n FROM documents)",
    "explore_tokens": f"WITH w AS (SELECT lang, list_filter({_TOKENS}, lambda t: length(t) > 1 AND NOT regexp_full_match(t, '[0-9]+') AND t NOT IN {dims.STOP_WORDS}) AS w FROM documents WHERE text IS NOT NULL) SELECT lang, sum(len(w))::BIGINT AS tokens, sum(len(list_distinct(w)))::BIGINT AS distinct_in_text, count(*) FILTER (WHERE len(w) = 0) AS empty FROM w GROUP BY 1",
    "token_count": f"SELECT source, sum(n)::BIGINT AS tokens, min(n)::INT AS least, max(n)::INT AS most, count(*) FILTER (WHERE n = 0) AS empty FROM (SELECT source, len({_TOKENS}) AS n FROM documents) GROUP BY 1",
    "ngram_top": f"WITH toks AS (SELECT {_TOKENS} AS w FROM documents), grams AS (SELECT unnest(list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) AS term FROM toks) SELECT term, count(*) AS n FROM grams GROUP BY 1 ORDER BY n DESC, term LIMIT 15",
    "tfidf_terms": f"WITH {_TERMS} SELECT term, sum(weight) / (SELECT count(*) FROM documents) AS mean_weight, count(*) AS df FROM weights GROUP BY term",
    "top_terms_by_label": f"WITH {_TERMS}, s AS (SELECT lang AS label, count(*) AS size FROM documents WHERE lang IS NOT NULL GROUP BY 1), m AS (SELECT d.lang AS label, w.term, sum(w.weight) / any_value(s.size) AS mean_weight FROM weights w JOIN documents d USING (doc_id) JOIN s ON s.label = d.lang GROUP BY 1, 2), r AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY mean_weight DESC, term))::INT AS rank FROM m) SELECT label, rank, term, mean_weight FROM r WHERE rank <= 3",
    "cosine_pairs": f"WITH {_TERMS} SELECT x.doc_id AS a, y.doc_id AS b FROM weights x JOIN weights y ON x.term = y.term AND x.doc_id < y.doc_id GROUP BY 1, 2 HAVING sum(x.weight * y.weight) >= {_LEAST}",
    "confusion": "WITH g AS (SELECT l.quality::VARCHAR AS label, CASE WHEN length(d.text) < 500 THEN '0' ELSE '1' END AS guess FROM labels l JOIN documents d USING (doc_id)) SELECT label, guess, count(*) AS n FROM g GROUP BY ALL",
    "relabel_decision": "SELECT CASE WHEN toxic = quality THEN 'KEEP' WHEN toxic = 1 THEN 'UPDATE' ELSE 'REVIEW' END AS status, count(*) AS n FROM labels GROUP BY 1",
    "rule_label": f"WITH l AS (SELECT coalesce({_FIRST}, 'OTHER') AS label FROM documents) SELECT label, CASE WHEN label = 'OTHER' THEN 0.5::DOUBLE ELSE 0.9::DOUBLE END AS confidence, count(*) AS n FROM l GROUP BY ALL",
    "json_contract": "SELECT event_id, (props->>'$.k')::INT AS k FROM events",
    "search": "SELECT doc_id FROM documents WHERE (contains(lower(text), 'this work is') OR contains(lower(source), 'this work is')) AND lang = 'en'",
    "customer_name": "SELECT c_custkey, CASE c_custkey % 6 WHEN 2 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN c_mktsegment ELSE c_name END AS customer FROM customer",
}
ORACLES["group_split"] = "SELECT doc_id, CASE WHEN ('0x' || substr(md5(source), 1, 8))::BIGINT % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM documents WHERE source IS NOT NULL"
_CLUSTER_TERMS = _TERMS.replace("HAVING count(*) >= 2 ", "").replace("LIMIT 400", "LIMIT 2000").replace("(1 + ln(tf.tf))", "tf.tf")
ORACLES["cluster_pairs"] = f"WITH {_CLUSTER_TERMS} SELECT x.doc_id AS a, y.doc_id AS b FROM weights x JOIN weights y ON x.term = y.term AND x.doc_id < y.doc_id GROUP BY 1, 2 HAVING sum(x.weight * y.weight) >= {_CLUSTER_LEAST}::DOUBLE"
_CLUSTERED = f"""WITH RECURSIVE {_CLUSTER_TERMS},
p AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b FROM weights x JOIN weights y ON x.term = y.term AND x.doc_id <> y.doc_id GROUP BY 1, 2 HAVING sum(x.weight * y.weight) >= {_CLUSTER_LEAST}::DOUBLE),
cc(doc_id, cluster) USING KEY (doc_id) AS (SELECT doc_id, doc_id FROM documents UNION SELECT p.b, min(u.cluster) FROM cc u JOIN p ON p.a = u.doc_id JOIN recurring.cc c ON c.doc_id = p.b WHERE u.cluster < c.cluster GROUP BY 1)"""
ORACLES["clusters"] = f"{_CLUSTERED} SELECT cluster, count(*) AS members FROM cc GROUP BY 1"
ORACLES["cluster_report"] = f"{_CLUSTERED} SELECT CASE WHEN trim(text) <> '' THEN cluster END AS cluster, count(*) AS members, min(doc_id) AS first_member, md5(arg_max(text, (length(text), -doc_id))) AS sample_md5 FROM documents JOIN cc USING (doc_id) GROUP BY 1"
ORACLES["similar_senders"] = """WITH s AS (SELECT DISTINCT sender AS spelling, lower(trim(sender)) AS name FROM (SELECT CASE WHEN n_chars % 2 = 0 THEN upper(source) ELSE source END AS sender FROM documents UNION ALL SELECT p_name FROM part) WHERE trim(sender) <> '' AND sender <> 'src0'),
f AS (SELECT name, min(spelling) AS first FROM s GROUP BY 1)
SELECT first, spelling AS second, 'spelling' AS kind FROM s JOIN f USING (name) WHERE spelling <> first UNION ALL SELECT a.first, b.first, 'contains' FROM f a JOIN f b ON a.name <> b.name AND contains(b.name, a.name)"""
ORACLES["ngram_top_lists"] = f"WITH toks AS (SELECT {_TOKENS} AS w FROM documents), " + ", ".join(
    f"g{n} AS (SELECT {n} AS words, term, count(*) AS n FROM (SELECT unnest(list_transform(range(1, greatest(len(w) - {n - 2}, 1)), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS term FROM toks) GROUP BY term ORDER BY n DESC, term LIMIT {k})" for n, k in _TOP_GRAMS
) + " " + " UNION ALL ".join(f"SELECT * FROM g{n}" for n, _ in _TOP_GRAMS)
_G = "WITH g AS (SELECT l.quality::VARCHAR AS label, CASE WHEN length(d.text) < 500 THEN '0' ELSE '1' END AS guess FROM labels l JOIN documents d USING (doc_id)), c AS (SELECT DISTINCT label AS class FROM g UNION SELECT DISTINCT guess FROM g), m AS (SELECT class, (SELECT count(*) FROM g WHERE label = class) AS support, (SELECT count(*) FROM g WHERE guess = class) AS guesses, (SELECT count(*) FROM g WHERE guess = class AND label = class) AS hits FROM c), p AS (SELECT class, support, CASE WHEN guesses > 0 THEN hits::DOUBLE / guesses ELSE 0 END AS precision, CASE WHEN support > 0 THEN hits::DOUBLE / support ELSE 0 END AS recall, CASE WHEN support + guesses > 0 THEN hits * 2.0::DOUBLE / (support + guesses) ELSE 0 END AS f1 FROM m)"
ORACLES["class_metrics"] = f"{_G} SELECT * FROM p"
ORACLES["summary_metrics"] = f"{_G} SELECT avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1, sum(precision * support) / sum(support) AS weighted_precision, sum(recall * support) / sum(support) AS weighted_recall, sum(f1 * support) / sum(support) AS weighted_f1 FROM p"
_SPLIT = f"""WITH {MESSAGES_SQL}, o AS (SELECT *, CASE WHEN role = 'CLIENT' THEN {_FIRST} END AS own FROM msg),
h AS (SELECT *, last_value(own IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held FROM o),
s AS (SELECT *, (sum(CASE WHEN own <> held THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS segment FROM h),
t AS (SELECT conv_id, turn, segment, coalesce(max(own) OVER (PARTITION BY conv_id, segment), 'OTHER') AS category FROM s)"""
ORACLES["topic_split"] = f"{_SPLIT} SELECT * FROM t"
_CHATS = MESSAGES_SQL.replace("msg AS", "raw AS") + """, timed AS (SELECT *, TIMESTAMP '2024-01-01' + to_hours((turn + turn // 3 * 4)::INT) AS ts FROM raw),
before AS (SELECT *, last_value(CASE WHEN role <> 'SYSTEM' THEN ts END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_ts FROM timed),
numbered AS (SELECT *, 1 + sum(CASE WHEN role <> 'SYSTEM' AND ts >= prev_ts + INTERVAL 4 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_no FROM before),
msg AS (SELECT printf('chat_%d_conv_%03d', conv_id, session_no::BIGINT) AS conv_id, conv_id AS chat, turn, ts, text, role FROM numbered)"""
_ANSWERED = ORACLES["response_label"].replace(f"WITH {MESSAGES_SQL}, ", "").replace("SELECT conv_id, CASE WHEN client IS NULL", "r AS (SELECT conv_id, CASE WHEN client IS NULL").replace("\nr AS", ",\nr AS") + ")"
ORACLES["chat_master"] = f"""{_SPLIT.replace(MESSAGES_SQL, _CHATS)}, {_ANSWERED},
k AS (SELECT conv_id, CASE WHEN bool_or({_words(dims.REMOTE_WORDS)} OR {_CREDENTIAL}) THEN 'REMOTE' ELSE 'NON_REMOTE' END AS handling FROM msg GROUP BY 1),
u AS (SELECT conv_id AS conversation_id, segment, category, 'chat_' || any_value(chat) || '.txt' AS source_file, arg_min(ts, turn) AS start_ts, arg_max(ts, turn) AS end_ts, count(*) AS total_messages, count(*) FILTER (WHERE role = 'CLIENT') AS client_messages, count(*) FILTER (WHERE role = 'ADMIN') AS admin_messages,
      bool_or(coalesce(contains(text, '?'), false)) AS has_media, bool_or({_CREDENTIAL}) AS has_credentials, md5(string_agg('[' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '] ' || role || ': ' || regexp_replace(coalesce(text, ''), '[\\r\\n]+', ' ', 'g'), ' | ' ORDER BY turn)) AS transcript_md5
      FROM msg JOIN t USING (conv_id, turn) GROUP BY 1, 2, 3)
SELECT conversation_id || '_' || chr((97 + segment)::INT) AS sub_id, u.* EXCLUDE (segment), response, handling FROM u JOIN r ON r.conv_id = conversation_id JOIN k ON k.conv_id = conversation_id"""
ORACLES["topic_slices"] = ORACLES["topic_split"]
ORACLES["topic_summary"] = f"{_SPLIT} SELECT conv_id, segment, category, count(*) AS n FROM t GROUP BY ALL"
_VALUES = lambda d: ", ".join(f"('{k}', '{v}')" for k, v in d.items())
_LITERAL = _normalised_sql(f"dom(word, r) AS (VALUES {_VALUES(dims.SLANG)}), gen(word, r) AS (VALUES {_VALUES(dims.GENERAL_WORDS)}), pro(word) AS (VALUES {', '.join(f"('{w}')" for w in dims.PROTECTED)})")
_TABLES = _normalised_sql("dom AS (SELECT DISTINCT t AS word, 'd' || t AS r FROM tok WHERE length(t) = 5), gen AS (SELECT DISTINCT t AS word, left(t, 5) AS r FROM tok WHERE length(t) BETWEEN 6 AND 8), pro AS (SELECT DISTINCT t AS word FROM tok WHERE length(t) = 9)")
for _name, _with in (("token_normalise", _LITERAL), ("dictionary_normalise", _TABLES)):
    ORACLES[_name] = f"WITH {_with} SELECT doc_id, changed, md5(normalised) AS normal_md5 FROM normal"
for _name, _with in (("normalise_coverage", _LITERAL), ("dictionary_coverage", _TABLES)):
    ORACLES[_name] = f"WITH {_with} SELECT sum(changed) AS words_changed, count(*) FILTER (WHERE changed > 0) AS texts_changed, count(*) FILTER (WHERE changed > 0) * 100.0 / count(*) AS percent FROM normal"
