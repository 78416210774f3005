"""URL filter: rules first, then a tree of path templates per host, judged by the share of blocked URLs among the labelled ones.

A path is cut into segments; one that holds a digit is ``<*>`` (and its extension) from the start. The tree
grows level by level over distinct (host, masked path) shapes with counts, so a host is never gathered in one task:

1. Variable segments: a child of a node stays literal only with at least ``MIN_ROWS`` URLs and ``SHARE`` of its node's; others are ``<*>``.
2. Similar branches: the literal children of a node with at least ``MIN_LABELLED`` labelled URLs are ordered by blocked share; neighbours
   whose shares do not differ significantly (two-proportion test, |z| <= ``Z``) are merged into one branch ``{a,b}``. Without labels
   nothing shows that branches are alike, so they stay apart.
3. Purity: (blocked + ``WEIGHT`` * base) / (labelled + ``WEIGHT``), base being the blocked share of all labelled URLs. A template with
   labelled URLs and a purity of at least ``REJECT`` is rejected.

Labels are the rules' own verdicts on the URLs they fit, or a column of the table. A rule fits its host and all subdomains if the
path starts with the rule's; the longest rule wins, ties go to the longer host. Rules are a parameter, some hundred at most: each
is a condition in the plan.

Cases: a null URL or one without ``://`` has an empty host and path, which form a shape like any other; hosts and paths may hold any
sign; repeated rows count as often as they stand; an empty table gives an empty result; extra columns pass through, those named
like an output are replaced. Segments after the sixth are one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import columns, cut_lineage, table

#: Host, path and verdict of each rule (the query's fixed values).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))

DEPTH = 6
MIN_ROWS = 5
SHARE = 0.02
MIN_LABELLED = 10
Z = 1.96
WEIGHT = 5.0
REJECT = 0.8
#: Shapes with more than this part of all rows go to all tasks: there can be no more of them than its inverse.
HOT_PART = 1 / 2000
#: Copies of the literal children in the join with the shapes below them, as one child may have very many.
SALTS = 16
WILD = "<*>"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    at = F.instr(url, "://")
    found = F.regexp_extract(F.substr(url, at + 3), r"^[^/?#]*", 0)
    return F.coalesce(F.when(at > 0, F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.regexp_extract(F.substr(url, at + 3), r"^[^/?#]*([^?#]*)", 1)), F.lit(""))


def fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    """Whether a rule fits."""
    return ((host == rule[0]) | host.endswith(f".{rule[0]}")) & path.startswith(rule[1])


def ruled(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...], value: int | None) -> Column:
    """The longest fitting rule as text, or one of its fields; null if none fits."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]))):
        out = F.when(fits(host, path, rule), rule[0] + rule[1] if value is None else rule[value]).otherwise(out)
    return out


def shape_of(path: Column, depth: int = DEPTH) -> Column:
    """Segments of a path, those after ``depth`` as one; one with a digit is ``<*>`` and its extension."""
    parts = F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(F.substr(path, F.lit(2)), "/", -1))
    tail = F.array(F.array_join(F.slice(parts, depth + 1, F.greatest(F.size(parts) - depth, F.lit(1))), "/"))
    cut = F.when(F.size(parts) > depth, F.concat(F.slice(parts, 1, depth), tail)).otherwise(parts)
    return F.transform(cut, lambda x: F.when(x.rlike("[0-9]"), F.concat(F.lit(WILD), F.regexp_extract(x, r"\.[a-zA-Z]+\z", 0))).otherwise(x))


def shapes_of(urls: DataFrame) -> DataFrame:
    """(host, shape, n, labelled, blocked) of rows (host, shape, label): one row a distinct shape."""
    return urls.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("blocked"))


def literal_children(rows: DataFrame) -> DataFrame:
    """Of rows (host, prefix, segment, n, labelled, blocked) the (host, prefix, segment) that stay literal, no more than 1 / SHARE a node, with the name of their branch."""
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]
    children = rows.groupBy("host", "prefix", "segment").agg(*sums)
    nodes = rows.groupBy("host", "prefix").agg(F.sum("n").alias("_all"))
    # a node may have very many children: they are dealt over SALTS copies of its sum
    dealt = children.where(F.col("n") >= MIN_ROWS).withColumn("_salt", F.pmod(F.xxhash64("segment"), F.lit(SALTS)))
    copies = nodes.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    often = dealt.join(copies, ["host", "prefix", "_salt"]).where(F.col("n") >= F.col("_all") * SHARE)
    known = F.col("labelled") >= MIN_LABELLED
    node = Window.partitionBy("host", "prefix").orderBy(known, F.when(known, F.col("blocked") / F.col("labelled")), "segment")  # at most 1 / SHARE rows
    n1, x1, n2, x2 = F.col("labelled"), F.col("blocked"), F.lag("labelled").over(node), F.lag("blocked").over(node)
    pooled = (x1 + x2) / (n1 + n2)
    # |z| <= Z without a division by zero: the squared difference against Z^2 times its variance
    alike = (n2 >= MIN_LABELLED) & (F.pow(x1 / n1 - x2 / n2, F.lit(2.0)) <= pooled * (1 - pooled) * (1 / n1 + 1 / n2) * Z * Z)
    first = often.withColumn("_first", F.when(known & F.coalesce(alike, F.lit(False)), 0).otherwise(1))
    runs = first.withColumn("_run", F.sum("_first").over(node.rowsBetween(Window.unboundedPreceding, 0)))
    members = F.array_sort(F.collect_list("segment").over(Window.partitionBy("host", "prefix", "_run")))
    name = F.when(F.size(members) > 1, F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))).otherwise(F.col("segment"))
    return runs.select("host", "prefix", "segment", name.alias("_branch"))


def path_templates(shapes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Shapes with their ``template`` in the host's tree."""
    rows = shapes.withColumn("_size", F.size("shape")).withColumn("prefix", F.lit(""))
    for level in range(min(depth + 1, shapes.agg(F.max(F.size("shape"))).first()[0] or 0)):
        rows = rows.withColumn("segment", F.when(F.col("_size") > level, F.try_element_at("shape", F.lit(level + 1))))
        kept = literal_children(rows.where(F.col("segment").isNotNull()))
        kept = kept.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64("shape"), F.lit(SALTS))).join(kept, ["host", "prefix", "segment", "_salt"], "left")
        grown = F.concat("prefix", F.lit("/"), F.coalesce("_branch", F.lit(WILD)))
        rows = cut_lineage(rows.withColumn("prefix", F.when(F.col("segment").isNotNull(), grown).otherwise(F.col("prefix"))).drop("segment", "_salt", "_branch"))
    return rows.drop("_size").withColumnRenamed("prefix", "template")


def judged_templates(shapes: DataFrame) -> DataFrame:
    """Shapes with ``template``, its ``purity`` (blocked share, smoothed; null without labelled URLs) and ``rejected``."""
    rows = path_templates(shapes)
    base = F.broadcast(shapes.agg(F.coalesce(F.sum("blocked") / F.sum("labelled"), F.lit(0.0)).alias("_base")))  # one row
    sums = rows.groupBy("host", "template").agg(F.sum("labelled").alias("_labelled"), F.sum("blocked").alias("_blocked")).crossJoin(base)
    purity = F.when(F.col("_labelled") > 0, (F.col("_blocked") + WEIGHT * F.col("_base")) / (F.col("_labelled") + WEIGHT))
    sums = sums.select(F.col("host").alias("_h"), F.col("template").alias("_t"), purity.alias("purity"))
    return rows.join(sums, (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t"))).drop("_h", "_t").withColumn("rejected", F.coalesce(F.col("purity") >= REJECT, F.lit(False)))


def judge_urls(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, url_col: str = "url", label: Column | None = None) -> DataFrame:
    """Rows with ``host``, ``path``, ``rule``, ``verdict`` (allow or block), ``template`` and ``purity``.

    ``label`` is 1 for blocked and 0 for allowed URLs, null for the others; the rules' verdicts if it is not given.
    """
    own = ("host", "path", "rule", "verdict", "template", "purity", "shape", "label", "_ruled")
    rest = [c for c in columns(pages.drop(*own))]
    url = F.col(f"`{url_col}`").cast("string")
    urls = pages.select(*rest, *([] if label is None else [label.cast("long").alias("label")]), host_of(url).alias("host"), path_of(url).alias("path"))
    host, path = F.col("host"), F.col("path")
    urls = urls.select("*", ruled(host, path, rules, None).alias("rule"), ruled(host, path, rules, 2).alias("_ruled"), shape_of(path).alias("shape"))
    if label is None:
        urls = urls.withColumn("label", F.when(F.col("_ruled") == "block", 1).when(F.col("_ruled") == "allow", 0).cast("long"))
    shapes = cut_lineage(shapes_of(urls.select("host", "shape", "label")))
    found = cut_lineage(judged_templates(shapes).select(F.col("host").alias("_h"), F.col("shape").alias("_s"), "n", "template", "purity", "rejected"))
    total = shapes.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(found.where(F.col("n") > total * HOT_PART).drop("n"))  # fewer than 1 / HOT_PART rows, as their n add up to the total
    cold = found.where(F.col("n") <= total * HOT_PART).drop("n")
    on = (F.col("host") == F.col("_h")) & (F.col("shape") == F.col("_s"))
    common = urls.join(hot, on)
    others = urls.join(hot.select("_h", "_s"), on, "left_anti").join(cold, on)
    out = common.unionByName(others)
    verdict = F.coalesce("_ruled", F.when(F.col("rejected"), "block").otherwise("allow"))
    return out.select(*rest, "host", "path", "rule", verdict.alias("verdict"), "template", "purity")


def op11_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages by the rules and, where none fits, the templates."""
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def _sql() -> str:
    """The same with a step a level."""
    at = "position('://' IN url)"
    rest = f"substr(url, {at} + 3)"
    fit = "(r.host = u.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)"
    parts = [
        "rules(host, path, verdict) AS (VALUES " + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES) + ")",
        f"urls AS (SELECT page_id, coalesce(CASE WHEN {at} > 0 THEN translate(regexp_extract({rest}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END, '') AS host, coalesce(CASE WHEN {at} > 0 THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) END, '') AS path FROM pages)",
        f"v AS (SELECT *, (SELECT arg_max(struct_pack(t := r.host || r.path, v := r.verdict), (length(r.host || r.path), length(r.host))) FROM rules r WHERE {fit}) AS best, CASE WHEN path = '' THEN [] ELSE string_split(substr(path, 2), '/') END AS parts FROM urls u)",
        rf"u AS (SELECT *, list_transform(CASE WHEN len(parts) > {DEPTH} THEN list_append(parts[:{DEPTH}], array_to_string(parts[{DEPTH + 1}:], '/')) ELSE parts END, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{WILD}' || regexp_extract(x, '\.[a-zA-Z]+$') ELSE x END) AS shape FROM v)",
        "s AS (SELECT host, shape, count(*) AS n, count(best) AS labelled, count(*) FILTER (WHERE best.v = 'block') AS blocked FROM u GROUP BY host, shape)",
        "p0 AS (SELECT *, shape AS seg, '' AS prefix FROM s)",
    ]
    node = f"PARTITION BY host, prefix ORDER BY n1 >= {MIN_LABELLED}, CASE WHEN n1 >= {MIN_LABELLED} THEN x1 / n1 END, segment"
    for k in range(DEPTH + 1):
        parts += [
            f"c{k} AS (SELECT host, prefix, seg[{k + 1}] AS segment, sum(n) AS n, sum(labelled) AS n1, sum(blocked) AS x1 FROM p{k} WHERE len(seg) > {k} GROUP BY ALL)",
            f"o{k} AS (SELECT *, lag(n1) OVER w AS n2, lag(x1) OVER w AS x2 FROM (SELECT *, sum(n) OVER (PARTITION BY host, prefix) AS total FROM c{k}) WHERE n >= {MIN_ROWS} AND n >= total * {SHARE} WINDOW w AS ({node}))",
            f"f{k} AS (SELECT *, sum(CASE WHEN n1 >= {MIN_LABELLED} AND n2 >= {MIN_LABELLED} AND pow(x1 / n1 - x2 / n2, 2.0) <= (x1 + x2) / (n1 + n2) * (1 - (x1 + x2) / (n1 + n2)) * (1 / n1 + 1 / n2) * {Z} * {Z} THEN 0 ELSE 1 END) OVER ({node} ROWS UNBOUNDED PRECEDING) AS run FROM o{k})",
            f"k{k} AS (SELECT host, prefix, segment, CASE WHEN count(*) OVER g > 1 THEN '{{' || string_agg(segment, ',') OVER (g ORDER BY segment ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) || '}}' ELSE segment END AS branch FROM f{k} WINDOW g AS (PARTITION BY host, prefix, run))",
            f"p{k + 1} AS (SELECT p.* EXCLUDE (prefix), CASE WHEN len(seg) > {k} THEN p.prefix || '/' || coalesce(k.branch, '{WILD}') ELSE p.prefix END AS prefix FROM p{k} p LEFT JOIN k{k} k ON p.host = k.host AND p.prefix = k.prefix AND p.seg[{k + 1}] = k.segment)",
        ]
    parts += [
        "base AS (SELECT coalesce(sum(blocked) / sum(labelled), 0) AS b FROM s)",
        f"t AS (SELECT host, prefix, CASE WHEN sum(labelled) > 0 THEN (sum(blocked) + {WEIGHT} * any_value(b)) / (sum(labelled) + {WEIGHT}) END AS purity FROM p{DEPTH + 1}, base GROUP BY host, prefix)",
    ]
    return "WITH " + ",\n".join(parts) + f"""
SELECT u.page_id, u.host, u.path, u.best.t AS rule, coalesce(u.best.v, CASE WHEN t.purity >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict, p.prefix AS template, t.purity
FROM u JOIN p{DEPTH + 1} p ON u.host = p.host AND u.shape = p.shape JOIN t ON p.host = t.host AND p.prefix = t.prefix"""


QUERIES = {"op11_url_templates": op11_url_templates}
ORACLES = {"op11_url_templates": _sql()}
