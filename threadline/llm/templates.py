"""Line dedup by a log-template tree of fixed depth. DataFrame functions only.

The tree has three levels: the token count of a line, then its first ``depth`` tokens, then the
template of that leaf. Tokens with a digit are variable from the start and count as ``<*>``.
In a leaf, a token position is fixed if its commonest token stands in at least ``fixed_share``
of the leaf's distinct lines; a line that has the fixed token keeps it, and any other token
is generalised to ``<*>``. A line whose template would keep less than ``similarity`` of its tokens
keeps its own text as template. Templates that occur in at least ``min_docs`` documents recur, and
their lines are dropped from every document.

That is one template a leaf, as the SQL of ``op7_template_lines`` states. With ``several`` a leaf has as many as
its lines show: at level k = 1, 2, ... a token stays if it stands at its position in at least 2^k of the leaf's
distinct lines, any other is generalised; the result is a template of the line if it keeps at least ``similarity``
of the tokens after the first ``depth``. The line itself (masked) is a template too. A line is dropped if any of
its templates recurs. Levels end where 2^k exceeds the lines of the leaf. ``op7_leaf_templates`` does this.

Only leaves that occur in ``min_docs`` documents are opened, and lines are first reduced to distinct
ones with counts, so a frequent line is one row from the first aggregation on.

Cases: null texts have no line; blank lines are never dropped and form no template; repeated rows
count as one document when ids are equal; an empty table gives an empty result; extra columns are not
looked at. Lines keep their order, and a document may end empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, table

DEPTH = 2
MIN_DOCS = 3
SIMILARITY = 0.6
FIXED_SHARE = 0.5
#: Open leaves up to this number go to all tasks (some 50 bytes each); more are met by a shuffle.
BROADCAST_LEAVES = 400_000


def mask(line: Column) -> Column:
    """Tokens of a line in one-space form, those with a digit as ``<*>``. Most lines need neither step, which a byte search tells."""
    odd = line.contains("  ") | line.contains("\t") | line.contains("\r")
    one_space = F.trim(F.when(odd, F.regexp_replace(line, r"[ \t\r]{2,}|[\t\r]", " ")).otherwise(line))
    # a match starts at a token and never goes back, so the time is linear in the line
    return F.when(line.rlike("[0-9]"), F.regexp_replace(one_space, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", "<*>")).otherwise(one_space)


def digest(value: Column) -> Column:
    """32 hex digits of a string."""
    return F.md5(value.cast("binary"))


def line_key(masked: Column) -> Column:
    """16 bytes that stand for a masked line, a leaf or a template."""
    return F.unhex(F.md5(masked.cast("binary")))


def masked_lines(docs: DataFrame, id_col: str, text_col: str, depth: int) -> DataFrame:
    """Lines that are not blank: _id, _r (the hash of the text, tells rows of one id apart), pos, masked, line_md5, leaf."""
    each = F.posexplode(F.transform(F.split(text_col, "\n"), mask)).alias("pos", "masked")
    lines = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_r"), each)
    count = F.length("masked") - F.length(F.replace("masked", F.lit(" "), F.lit(""))) + 1
    leaf = line_key(F.concat_ws(" ", count.cast("string"), F.substring_index("masked", " ", depth)))
    return lines.where(F.col("masked") != "").select("*", line_key(F.col("masked")).alias("line_md5"), leaf.alias("leaf"))


def lines_of_open_leaves(lines: DataFrame, pairs: DataFrame, min_docs: int) -> DataFrame:
    """Distinct lines of the leaves that can hold a recurring template: line_md5, masked, leaf, n_docs, leaf_lines, tokens."""
    # which leaves can hold a recurring template is known from digests alone; texts are shuffled once, to their line's row
    counts = pairs.select("line_md5", "leaf", "_id").distinct().groupBy("line_md5", "leaf").agg((F.count("_id") + F.max(F.col("_id").isNull().cast("long"))).alias("n_docs"))
    leaves = counts.groupBy("leaf").agg(F.sum("n_docs").alias("_docs"), F.count(F.lit(1)).alias("leaf_lines")).where(F.col("_docs") >= min_docs)
    leaves = cut_lineage(leaves.select("leaf", "leaf_lines"))
    if leaves.count() <= BROADCAST_LEAVES:  # then lines of other leaves are not shuffled at all
        leaves = F.broadcast(leaves)
        lines = lines.join(leaves.select("leaf"), "leaf", "left_semi")
    open_lines = counts.join(leaves, "leaf")
    texts = lines.groupBy("line_md5").agg(F.first("masked").alias("masked"))
    return cut_lineage(texts.join(open_lines, "line_md5")).withColumn("tokens", F.split("masked", " "))


def lines_of_recurring(shaped: DataFrame, pairs: DataFrame, min_docs: int) -> DataFrame:
    """Of lines with their template, those whose template recurs."""
    # documents of a template: exact only where several lines share it
    groups = shaped.groupBy("template").agg(F.count(F.lit(1)).alias("_lines"), F.sum("n_docs").alias("_sum")).where(F.col("_sum") >= min_docs)
    likely = shaped.join(groups, "template")
    sure = likely.where(F.col("_lines") == 1).select("line_md5", "template")
    unsure = likely.where(F.col("_lines") > 1).select("line_md5", "template")
    real = unsure.join(pairs.select("line_md5", "_id"), "line_md5").select("template", "_id").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("_docs"))
    return sure.unionByName(unsure.join(real.where(F.col("_docs") >= min_docs).select("template"), "template").select("line_md5", "template"))


def recurring_lines(lines: DataFrame, pairs: DataFrame, min_docs: int, similarity: float, fixed_share: float) -> DataFrame:
    """Digests of masked lines whose template recurs, with the template's digest; pairs has the lines' places in the documents."""
    alive = lines_of_open_leaves(lines, pairs, min_docs)
    several = alive.where(F.col("leaf_lines") > 1)
    spread = several.select("leaf", "leaf_lines", F.posexplode("tokens").alias("pos", "token"))
    counted = spread.groupBy("leaf", "pos", "token").agg(F.count(F.lit(1)).alias("_n"), F.max("leaf_lines").alias("_of"))
    frequent = counted.where((F.col("_n") >= F.col("_of") * fixed_share) & (F.col("_n") > 1))
    best = frequent.groupBy("leaf", "pos").agg(F.max(F.struct(F.col("_n"), F.col("token"))).alias("_best"))
    fixed = best.select("leaf", "pos", F.col("_best.token").alias("token"))
    skeletons = fixed.groupBy("leaf").agg(F.map_from_entries(F.collect_list(F.struct("pos", "token"))).alias("skeleton"))
    shaped = alive.join(skeletons, "leaf", "left")
    template_tokens = F.transform("tokens", lambda t, i: F.when((t == F.lit("<*>")) | F.coalesce(F.element_at("skeleton", i) == t, F.lit(False)), t).otherwise(F.lit("<*>")))
    kept = F.size(F.filter("_general", lambda t: t != "<*>"))
    shaped = shaped.withColumn("_general", F.when(F.col("skeleton").isNotNull(), template_tokens).otherwise(F.col("tokens")))
    template = F.when(F.col("skeleton").isNotNull() & (kept >= F.size("tokens") * similarity), line_key(F.concat_ws(" ", "_general"))).otherwise(F.col("line_md5"))
    shaped = cut_lineage(shaped.select("line_md5", template.alias("template"), "n_docs"))
    return lines_of_recurring(shaped, pairs, min_docs)


def lines_by_templates(lines: DataFrame, pairs: DataFrame, min_docs: int, similarity: float, depth: int) -> DataFrame:
    """As ``recurring_lines``, with several templates a leaf and a row per line and recurring template; templates are digests."""
    alive = lines_of_open_leaves(lines, pairs, min_docs)
    spread = alive.where((F.col("leaf_lines") > 1) & (F.size("tokens") > depth)).select("line_md5", "leaf", F.posexplode("tokens").alias("pos", "token")).where(F.col("token") != "<*>")
    counted = spread.groupBy("leaf", "pos", "token").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    # level at which a token is last kept; tokens of one line only are on none
    levels = spread.join(counted, ["leaf", "pos", "token"]).select("line_md5", "pos", (F.length(F.bin("_n")) - 1).alias("_level"))
    held = levels.groupBy("line_md5").agg(F.map_from_entries(F.collect_list(F.struct("pos", "_level"))).alias("_held"), F.count_if(F.col("pos") >= depth).alias("_kept"))
    alike = alive.join(held, "line_md5").where(F.col("_kept") >= (F.size("tokens") - depth) * F.lit(similarity))
    alike = alike.withColumn("_at", F.transform("tokens", lambda t, i: F.coalesce(F.element_at("_held", i), F.lit(0))))
    own_levels = F.array_distinct(F.map_values("_held"))  # between two of them the template does not change
    alike = alike.select("line_md5", "n_docs", "tokens", "_at", F.explode(own_levels).alias("_k"))
    after = F.size(F.filter(F.slice("_at", depth + 1, F.size("_at")), lambda x: x >= F.col("_k")))
    alike = alike.where(after >= (F.size("tokens") - depth) * F.lit(similarity))
    general = F.array_join(F.transform("tokens", lambda t, i: F.when(F.get("_at", i) >= F.col("_k"), t).otherwise(F.lit("<*>"))), " ")
    own = alive.select("line_md5", F.col("line_md5").alias("template"), "n_docs")
    shaped = cut_lineage(own.unionByName(alike.select("line_md5", line_key(general).alias("template"), "n_docs")).distinct())
    return lines_of_recurring(shaped, pairs, min_docs)


def drop_recurring_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, min_docs: int = MIN_DOCS,
    similarity: float = SIMILARITY, fixed_share: float = FIXED_SHARE, several: bool = False,
) -> DataFrame:
    """Per document: id, ``n_lines``, ``n_dropped`` and ``kept_text`` (null for a null text)."""
    lines = masked_lines(docs, id_col, text_col, depth)
    pairs = cut_lineage(lines.select("line_md5", "leaf", "_id", "_r", "pos"))
    found = lines_by_templates(lines, pairs, min_docs, similarity, depth) if several else recurring_lines(lines, pairs, min_docs, similarity, fixed_share)
    recurring = found.select("line_md5")
    dropped = pairs.join(recurring, "line_md5", "left_semi").groupBy("_id", "_r").agg(F.collect_set("pos").alias("_gone"))
    base = docs.select(F.col(id_col), F.split(text_col, "\n").alias("_parts"), F.xxhash64(text_col).alias("_row"))
    joined = base.join(dropped, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_r")), "left")
    # places that stay, by a set difference; the parts come through the join, so no text is split again for a line
    places = F.array_except(F.sequence(F.lit(0), F.size("_parts") - 1), F.col("_gone"))
    kept = F.when(F.col("_gone").isNull(), F.col("_parts")).otherwise(F.transform(places, lambda i: F.get("_parts", i)))
    n_lines = F.when(F.col("_parts").isNotNull(), F.size("_parts")).otherwise(0)
    return joined.select(
        id_col, n_lines.cast("long").alias("n_lines"), F.when(F.col("_gone").isNotNull(), F.size("_gone")).otherwise(0).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept_text"),
    )


def op7_template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their recurring lines, texts as digests."""
    out = drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", digest(F.coalesce("kept_text", F.lit(""))).alias("kept_md5"))


def op7_leaf_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op7_template_lines, with several templates a leaf."""
    out = drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), several=True)
    return out.select("doc_id", "n_lines", "n_dropped", digest(F.coalesce("kept_text", F.lit(""))).alias("kept_md5"))


def _sql() -> str:
    def masked(line: str) -> str:
        return rf"regexp_replace(trim(regexp_replace({line}, '[ \t\r]+', ' ', 'g')), '[^ ]*[0-9][^ ]*', '<*>', 'g')"

    return f"""
WITH docs AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
numbered AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS no FROM docs WHERE text IS NOT NULL),
lines AS (SELECT doc_id, line, no, {masked("line")} AS masked FROM numbered),
pairs AS (SELECT DISTINCT masked, doc_id FROM lines WHERE masked <> ''),
distinct_lines AS (SELECT masked, count(*) AS n_docs, string_split(masked, ' ') AS tokens FROM pairs GROUP BY masked),
leafed AS (SELECT *, len(tokens)::VARCHAR || ' ' || array_to_string(tokens[1:{DEPTH}], ' ') AS leaf FROM distinct_lines),
leaves AS (SELECT leaf, sum(n_docs) AS docs, count(*) AS leaf_lines FROM leafed GROUP BY leaf),
alive AS (SELECT l.*, v.leaf_lines FROM leafed l JOIN leaves v USING (leaf) WHERE v.docs >= {MIN_DOCS}),
spread AS (SELECT masked, leaf, leaf_lines, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM alive),
counted AS (SELECT leaf, pos, token, count(*) AS n, max(leaf_lines) AS of_lines FROM spread GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY leaf, pos ORDER BY n DESC, token DESC) AS r FROM counted),
fixed AS (SELECT leaf, pos, token FROM best WHERE r = 1 AND of_lines > 1 AND n > 1 AND n >= of_lines * {FIXED_SHARE}),
opened AS (SELECT DISTINCT leaf FROM fixed),
general AS (
  SELECT s.masked, s.leaf, s.pos, CASE WHEN s.token = '<*>' OR s.token = f.token OR o.leaf IS NULL THEN s.token ELSE '<*>' END AS token
  FROM spread s LEFT JOIN fixed f ON s.leaf = f.leaf AND s.pos = f.pos LEFT JOIN opened o ON s.leaf = o.leaf
), shaped AS (
  SELECT masked, CASE WHEN count(*) FILTER (WHERE token <> '<*>') >= count(*) * {SIMILARITY} THEN string_agg(token, ' ' ORDER BY pos) ELSE masked END AS template
  FROM general GROUP BY masked
), recurring AS (
  SELECT s.template FROM shaped s JOIN pairs p USING (masked) GROUP BY s.template HAVING count(DISTINCT coalesce(p.doc_id::VARCHAR, '')) >= {MIN_DOCS}
), gone AS (SELECT DISTINCT masked FROM shaped WHERE template IN (SELECT template FROM recurring)),
judged AS (SELECT l.*, g.masked IS NOT NULL AS dropped FROM lines l LEFT JOIN gone g ON l.masked = g.masked),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE dropped) AS n_dropped, string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT dropped) AS kept_text
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(d.parts), 0)::BIGINT AS n_lines, coalesce(k.n_dropped, 0)::BIGINT AS n_dropped, md5(coalesce(k.kept_text, '')) AS kept_md5
FROM docs d LEFT JOIN kept k ON d.doc_id IS NOT DISTINCT FROM k.doc_id
"""


def _several_sql() -> str:
    """The SQL above with other templates: the same lines, leaves and result."""
    head, rest = _sql().split("counted AS (", 1)
    tail = rest[rest.index("judged AS (") :]
    return head + f"""counted AS (SELECT leaf, pos, token, count(*) AS n FROM spread GROUP BY ALL),
levels AS (SELECT s.masked, s.pos, s.token, c.n, unnest(range(1, 1 + floor(log2(s.leaf_lines))::BIGINT)) AS k FROM spread s JOIN counted c USING (leaf, pos, token)),
general AS (
  SELECT masked, string_agg(CASE WHEN n >= 2 ** k THEN token ELSE '<*>' END, ' ' ORDER BY pos) AS template FROM levels GROUP BY masked, k
  HAVING count(*) > {DEPTH} AND count(*) FILTER (WHERE pos > {DEPTH} AND token <> '<*>' AND n >= 2 ** k) >= (count(*) - {DEPTH}) * {SIMILARITY}::DOUBLE
), shaped AS (SELECT masked, masked AS template FROM alive UNION SELECT masked, template FROM general),
recurring AS (
  SELECT s.template FROM shaped s JOIN pairs p USING (masked) GROUP BY s.template HAVING count(DISTINCT coalesce(p.doc_id::VARCHAR, '')) >= {MIN_DOCS}
), gone AS (SELECT DISTINCT masked FROM shaped WHERE template IN (SELECT template FROM recurring)),
""" + tail


QUERIES = {"op7_template_lines": op7_template_lines, "op7_leaf_templates": op7_leaf_templates}
ORACLES = {"op7_template_lines": _sql(), "op7_leaf_templates": _several_sql()}
