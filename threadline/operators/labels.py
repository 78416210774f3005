"""The label loop: prompts, a labelling job around a user's callable, contracts, audit, taxonomy growth, relabelling."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadline.dims import Category, Taxonomy
from threadline.functions.text import category_or_fallback, decide_status, decided_label, first_json

MAX_TEXT = 2000
LEAST_CONFIDENCE = 0.6
ANSWER = "label string, kategori string, confidence string, evidence string, reason string, main_issue string, needs_new boolean, proposal string"


def blank_to_null(c: Column) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def unit_context(messages: DataFrame, key: str, order: str) -> DataFrame:
    """Per unit the client's text, the whole conversation as ``(role) text`` and the number of messages; blank texts are counted but not joined."""
    full = F.trim(F.coalesce("text", F.lit(""))) != ""

    def joined(only: Column, piece: Column, sep: str) -> Column:
        items = F.array_sort(F.collect_list(F.when(only, F.struct(F.col(order).alias("o"), piece.alias("t")))))
        return F.array_join(F.transform(items, lambda s: s["t"]), sep)

    return messages.groupBy(key).agg(
        joined(full & (F.col("role") == "CLIENT"), F.trim("text"), " ").alias("client_text"),
        joined(full, F.concat(F.lit("("), F.col("role"), F.lit(") "), F.trim("text")), "\n").alias("context"), F.count(F.lit(1)).alias("n_messages"),
    )


def label_prompt(taxonomy: Taxonomy, text: Column, context: Column, examples: tuple[tuple[str, str], ...] = ()) -> Column:
    """Prompt with the categories, examples, the complaint and the conversation, both cut at ``MAX_TEXT`` signs."""
    head = "\n".join(["Categories:", *(f"- {c.name}: {c.definition}" for c in taxonomy.categories), f"- {taxonomy.fallback}: none of the above", "", "Examples:", *(f"{t}\n{a}" for t, a in examples), "", "Complaint:"])
    complaint = F.coalesce(blank_to_null(F.substring(text, 1, MAX_TEXT)), F.lit("(no text)"))
    extra = F.when(F.trim(F.coalesce(context, F.lit(""))) != "", F.concat(F.lit("\n\nConversation:\n"), F.substring(F.trim(context), 1, MAX_TEXT))).otherwise("")
    return F.concat(F.lit(head + "\n"), complaint, extra)


def call_each(rows: DataFrame, key: str, prompt: str, complete: Callable[[str], str]) -> DataFrame:
    """(key, answer, error) of a user's callable on every prompt; a failure is a row with its message and stops nothing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers, errors = [], []
            for p in batch["p"]:
                try:
                    answers.append(complete(p))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  the caller's code may raise anything
                    answers.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"k": batch["k"], "answer": answers, "error": errors})

    out = rows.select(F.col(key).cast("string").alias("k"), F.col(prompt).alias("p")).mapInPandas(run, "k string, answer string, error string")
    return out.withColumnRenamed("k", key)


def label_contract(answer: Column, taxonomy: Taxonomy) -> Column:
    """Struct (label, confidence, evidence, reason, main_issue, needs_new, proposal) of a parsed answer.

    A category that is not in the list becomes the proposal and the label the fallback; confidence is clamped to 0..1; evidence
    falls back to the main issue and then to the first 120 signs of the reason; a proposal alone asks for a new category.
    """
    named = F.coalesce(blank_to_null(answer["label"]), blank_to_null(answer["kategori"]))
    known = F.coalesce(named.isin(*taxonomy.names()), F.lit(False))
    asks, given = F.coalesce(answer["needs_new"], F.lit(False)), blank_to_null(answer["proposal"])
    reason, issue = blank_to_null(answer["reason"]), blank_to_null(answer["main_issue"])
    sure = F.coalesce(answer["confidence"].try_cast("double"), F.lit(0.0))
    proposal = F.when(known, F.when(asks, F.coalesce(given, named)).otherwise(given)).otherwise(F.coalesce(named, given))
    whole = F.struct(
        F.when(known, named).otherwise(taxonomy.fallback).alias("label"), F.least(F.greatest(sure, F.lit(0.0)), F.lit(1.0)).alias("confidence"),
        F.coalesce(blank_to_null(answer["evidence"]), issue, F.substring(reason, 1, 120)).alias("evidence"), reason.alias("reason"), issue.alias("main_issue"),
        (F.when(known, asks | given.isNotNull()).otherwise(F.lit(True))).alias("needs_new"), proposal.alias("proposal"),
    )
    none = F.struct(F.lit(taxonomy.fallback).alias("label"), F.lit(0.0).alias("confidence"), *[F.lit(None).cast("string").alias(c) for c in ("evidence", "reason", "main_issue")], F.lit(False).alias("needs_new"), F.lit(None).cast("string").alias("proposal"))
    return F.when(answer.isNull(), none).otherwise(whole)


def wants_review(label: Column, confidence: Column, needs_new: Column, fallback: str) -> Column:
    """Whether a labelled unit goes on to reconciliation: a new category is asked for, the confidence is low, or the label is the fallback."""
    return needs_new | (confidence < LEAST_CONFIDENCE) | (label == fallback)


def label_units(units: DataFrame, key: str, taxonomy: Taxonomy, complete: Callable[[str], str]) -> DataFrame:
    """Labelling job on (key, client_text, context) rows: prompt, call, parse, contract, and the flags ``agree`` (with the rule label) and ``review``."""
    asked = units.withColumn("_prompt", label_prompt(taxonomy, F.col("client_text"), F.col("context")))
    answers = call_each(asked, key, "_prompt", complete).withColumn("_a", first_json(F.col("answer"), ANSWER)).withColumn("_c", label_contract(F.col("_a"), taxonomy))
    answers = answers.select(F.col(key).alias("_key"), "error", "_c.*")
    out = units.withColumn("rule_label", category_or_fallback(F.col("client_text"), taxonomy)).join(answers, F.col(key).cast("string") == F.col("_key"), "left").drop("_key")
    return out.withColumns({"agree": F.col("label").eqNullSafe(F.col("rule_label")), "review": wants_review(F.col("label"), F.col("confidence"), F.col("needs_new"), taxonomy.fallback)})


def label_summary(labelled: DataFrame) -> DataFrame:
    """Per label: units, those that agree with the rule, those for reconciliation and the mean confidence."""
    return labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("agree").alias("agree"), F.count_if("review").alias("review"), F.avg("confidence").alias("mean_confidence"))


def candidate_counts(labelled: DataFrame, text: str, artefacts: str) -> DataFrame:
    """How many units are flagged, have a text, and have one when artefacts are taken off."""
    full = F.trim(F.coalesce(text, F.lit(""))) != ""
    bare = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), artefacts, " ")) != ""
    return labelled.agg(F.count_if("review").alias("flagged"), F.count_if(F.col("review") & full).alias("with_text"), F.count_if(F.col("review") & full & bare).alias("usable"))


@dataclass(frozen=True)
class AuditRules:
    """Signals as patterns on the text, and what labels they speak against."""

    network: str
    database: str
    active: str
    question: str
    broken: str
    question_label: str
    network_label: str
    database_label: str
    fallback: str
    short: int = 12


def audit_label(label: Column, text: Column, rules: AuditRules) -> Column:
    """Struct (verdict, rule, signals): nine ordered rules to WRONG or AMBIGUOUS, else CONSISTENT. Text is taken as it is, any case mattering."""
    t = F.coalesce(text, F.lit(""))
    net, db, active, asks = (t.rlike(p) for p in (rules.network, rules.database, rules.active, rules.question))
    signals = F.array_compact(F.array(F.when(net, "network"), F.when(db, "database"), F.when(active, "active_problem")))
    some = F.size(signals) > 0
    ordered = (
        ("WRONG", (label == rules.question_label) & active & net), ("WRONG", (label == rules.question_label) & active & db), ("WRONG", (label == rules.network_label) & t.rlike(rules.broken)),
        ("WRONG", (label == rules.network_label) & asks & ~active), ("WRONG", (label == rules.fallback) & active & some), ("AMBIGUOUS", (label == rules.network_label) & db & ~active),
        ("AMBIGUOUS", (label == rules.database_label) & net & ~active), ("AMBIGUOUS", (label == rules.question_label) & asks & some), ("AMBIGUOUS", label.isin(rules.question_label, rules.fallback) & (F.length(F.trim(t)) < rules.short)),
    )
    found = F.lit(len(ordered) + 1)
    for k in range(len(ordered), 0, -1):
        found = F.when(ordered[k - 1][1], k).otherwise(found)
    verdict = F.when(found <= 5, "WRONG").when(found <= len(ordered), "AMBIGUOUS").otherwise("CONSISTENT")
    return F.struct(verdict.alias("verdict"), found.alias("rule"), F.array_join(signals, ";").alias("signals"))


def audit_sample(judged: DataFrame, key: str, verdict: str = "verdict", k: int = 25) -> DataFrame:
    """The first k rows of each verdict but CONSISTENT, in order of the key: what a person looks at."""
    order = Window.partitionBy(verdict).orderBy(key)
    return judged.where(F.col(verdict) != "CONSISTENT").withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def cluster_prompts(texts: DataFrame, clusters: DataFrame, key: str, text: str, names: list[str], least: int = 5, shown: int = 20) -> DataFrame:
    """(cluster, members, prompt) of the clusters of at least ``least`` members: the names in use and the first ``shown`` texts by key."""
    joined = texts.join(clusters, key)
    order = Window.partitionBy("cluster").orderBy(key)
    few = joined.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= shown)
    own = few.groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", F.col(text).alias("t")))), lambda x: x["t"]).alias("_texts"))
    sizes = joined.groupBy("cluster").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") >= least)
    return sizes.join(own, "cluster").select("cluster", "members", proposal_prompt(names, F.col("_texts")).alias("prompt"))


def proposal_contract(name: Column, definition: Column, keywords: Column, existing: list[str]) -> Column:
    """Struct (name, definition, keywords) of a sound proposal, else null: an upper-case name not in use, a definition of 10 signs, two distinct cleaned keywords."""
    upper = F.upper(F.trim(F.coalesce(name, F.lit(""))))
    cleaned = F.filter(F.array_distinct(F.transform(keywords, lambda k: F.trim(F.regexp_replace(F.lower(F.trim(k)), "[^a-z0-9_ ]", "")))), lambda k: k != "")
    sound = upper.rlike("^[A-Z][A-Z0-9_]{2,}$") & ~upper.isin(*existing) & (F.length(F.trim(definition)) >= 10) & (F.size(cleaned) >= 2)
    return F.when(sound, F.struct(upper.alias("name"), F.trim(definition).alias("definition"), cleaned.alias("keywords")))


def proposal_prompt(names: list[str], texts: Column) -> Column:
    """Prompt for a cluster: the names in use and its texts, numbered."""
    return F.concat(F.lit("Categories in use: " + ", ".join(names) + "\nTexts:\n"), F.array_join(F.transform(texts, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n"))


def cluster_report(texts: DataFrame, clusters: DataFrame, key: str, text: str) -> DataFrame:
    """Per cluster its size, the longest text (ties by key) and the smallest member, largest first; members keep their own table.

    ``clusters`` has (key, cluster). Units without a cluster are one residual row with a null cluster.
    """
    joined = texts.join(clusters, key, "left")
    best = F.max_by(text, F.struct(F.length(text), (-F.col(key)).alias("k")))
    return joined.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"), F.min(key).alias("first_member"), best.alias("sample")).orderBy(F.desc("members"), "first_member")


def dominant_words(texts: DataFrame, cluster: str, words: Column, stop_words: tuple[str, ...], k: int = 3) -> DataFrame:
    """(cluster, rank, word, n): the k commonest words of a cluster, longer than two signs and no stop words; ties by word."""
    each = texts.select(cluster, F.explode(words).alias("word")).where((F.length("word") > 2) & ~F.col("word").isin(*stop_words))
    counts = each.groupBy(cluster, "word").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(cluster).orderBy(F.desc("n"), "word")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def grown_taxonomy(taxonomy: Taxonomy, proposals: DataFrame, least_members: int = 5) -> Taxonomy:
    """The taxonomy with the sound proposals of clusters of enough members, one version on; the same if there is none.

    ``proposals`` has (members, name, definition, keywords), a row a cluster: a few, as categories are.
    """
    sound = proposals.where(F.col("members") >= least_members).select(proposal_contract(F.col("name"), F.col("definition"), F.col("keywords"), taxonomy.names()).alias("p")).where("p is not null")
    new = sound.groupBy("p.name").agg(F.min(F.struct("p.definition", "p.keywords")).alias("p")).orderBy("name").collect()
    if not new:
        return taxonomy
    return replace(taxonomy, categories=(*taxonomy.categories, *(Category(r["name"], tuple(r["p"]["keywords"]), (), r["p"]["definition"]) for r in new)), version=taxonomy.version + 1)


def relabelled(all_units: DataFrame, key: str, old: str, asked: DataFrame, previous: DataFrame) -> DataFrame:
    """Every unit with ``status`` and ``final``: KEEP where nobody asked, else decided from the old, new and previous labels.

    ``asked`` has (key, new_label), ``previous`` (key, previous_label).
    """
    out = all_units.join(asked.select(key, "new_label"), key, "left").join(previous.select(key, "previous_label"), key, "left")
    status = F.when(F.col("new_label").isNull(), "KEEP").otherwise(decide_status(F.col(old), F.col("new_label"), F.col("previous_label")))
    final = F.when(F.col("new_label").isNull(), F.col(old)).otherwise(decided_label(F.col(old), F.col("new_label"), F.col("previous_label")))
    return out.withColumns({"status": status, "final": final})


def overridden(rows: DataFrame, key: str, label: str, new: DataFrame) -> DataFrame:
    """Rows with the label of a (key, label) table where it has one; an error if it names none of the rows."""
    table = new.select(F.col(key).alias("_key"), F.col(label).alias("_new")).where("_new is not null")
    if rows.join(table, F.col(key) == F.col("_key"), "left_semi").isEmpty():
        raise ValueError("the new labels name none of the rows")
    return rows.join(table, F.col(key) == F.col("_key"), "left").withColumn(label, F.coalesce("_new", label)).drop("_key", "_new")


def chosen_labels(rows: DataFrame, key: str, final: DataFrame, model: DataFrame, label: str = "label") -> DataFrame:
    """Add ``chosen`` and ``origin``: the final truth, then the model's label, then the one at hand."""
    f = final.select(F.col(key).alias("_f"), F.col(label).alias("_final"))
    m = model.select(F.col(key).alias("_m"), F.col(label).alias("_model"))
    out = rows.join(f, F.col(key) == F.col("_f"), "left").join(m, F.col(key) == F.col("_m"), "left")
    origin = F.when(F.col("_final").isNotNull(), "final").when(F.col("_model").isNotNull(), "model").otherwise("existing")
    return out.withColumns({"chosen": F.coalesce("_final", "_model", label), "origin": origin}).drop("_f", "_m", "_final", "_model")
