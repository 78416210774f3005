"""Text and label expressions. All are JVM-side column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadline.dims import Category, Taxonomy

# Classes are spelled out so that other SQL engines read the patterns the same way.
_WORD = r"\p{L}\p{N}_"
INVISIBLE = "[​-‏‪-‮⁦-⁩﻿]"
# Fixed value: the name of an image as exports have it.
IMAGE_NAME = rf"img-[0-9]+-wa[0-9]+\.[{_WORD}]+"


def category_pattern(category: Category) -> str | None:
    """A pattern for a category's words (with bounds) and phrases (any white space inside); None for an empty one, which would match all."""
    words = [re.escape(w.lower()) for w in category.keywords if w.strip()]
    phrases = [r"[ \t\n]+".join(re.escape(p) for p in phrase.lower().split()) for phrase in category.phrases if phrase.strip()]
    parts = words + phrases
    return rf"(^|[^{_WORD}])({'|'.join(parts)})([^{_WORD}]|$)" if parts else None


def word_pattern(words: tuple[str, ...]) -> str:
    """A pattern for any of some words with bounds."""
    return category_pattern(Category("", words)) or "$^"


def first_category(text: Column, taxonomy: Taxonomy) -> Column:
    """First matching category in order of priority, null if none."""
    lowered = F.lower(text)
    found = [F.when(lowered.rlike(p), F.lit(c.name)) for c in taxonomy.categories if (p := category_pattern(c))]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def category_or_fallback(text: Column, taxonomy: Taxonomy) -> Column:
    """First matching category, else the fallback."""
    return F.coalesce(first_category(text, taxonomy), F.lit(taxonomy.fallback))


def all_categories(text: Column, taxonomy: Taxonomy) -> Column:
    """All matching categories in order, or the fallback alone."""
    lowered = F.lower(text)
    found = F.array_compact(F.array(*[F.when(lowered.rlike(p), F.lit(c.name)) for c in taxonomy.categories if (p := category_pattern(c))]))
    return F.when(F.size(found) == 0, F.array(F.lit(taxonomy.fallback))).otherwise(found)


def strip_invisible(text: Column) -> Column:
    """Without direction marks, zero-width signs and byte-order marks."""
    return F.regexp_replace(text, INVISIBLE, "")


def parse_chat_time(date: Column, time: Column) -> Column:
    """Local timestamp of ``DD/MM/YY`` and ``HH.MM``, null when it is none."""
    return F.to_timestamp_ntz(F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit("d/M/yy H.mm")).cast("string"))


def parse_time(text: Column) -> Column:
    """Timestamp in one of four day-first formats, first success."""
    tries = [F.try_to_timestamp(F.trim(text), F.lit(f)) for f in ("d/M/yy H.mm", "d/M/yyyy H.mm", "d/M/yy H:mm", "d/M/yyyy H:mm")]
    return F.coalesce(*tries)


#: What cleaning removes, in this order: marks of media and deletion, image names and links; signs; lone numbers; doubled blanks.
CLEAN_PATTERNS = (
    rf"<[^<>]*(?:omitted|attached|terlampir|disertakan)[^<>]*>|[(]file[ \t\n]+terlampir[)]|this message was deleted|pesan[ \t\n]+ini[ \t\n]+(?:telah[ \t\n]+)?(?:dihapus|diedit)|https?://[^ \t\n]+|www\.[^ \t\n]+|{IMAGE_NAME}",
    rf"[^{_WORD} ]+", r"(^| )([0-9]+ )*[0-9]+( |$)", r" +",
)


#: Without any of these a text holds nothing that the first pattern removes.
CLEAN_HINTS = ("<", "(file", "this message was deleted", "pesan", "http", "www.", "img-")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def clean_text(text: Column) -> Column:
    """Lower case without media markers, image names, links, punctuation, lone numbers and doubled blanks.

    A byte search tells whether a pattern can match at all, which for most texts and patterns it cannot.
    """
    marks, signs, numbers, blanks = CLEAN_PATTERNS
    out = bound(F.lower(text), lambda v: F.when(holds_any(v, CLEAN_HINTS), F.regexp_replace(v, marks, " ")).otherwise(v))
    out = bound(F.regexp_replace(out, signs, " "), lambda v: F.when(v.rlike("[0-9]"), F.regexp_replace(v, numbers, " ")).otherwise(v))
    return F.trim(bound(out, lambda v: F.when(v.contains("  "), F.regexp_replace(v, blanks, " ")).otherwise(v)))


def tokens(cleaned: Column) -> Column:
    """Blank-separated tokens without empty ones."""
    return F.filter(F.split(cleaned, " "), lambda t: t != "")


def explore_tokens(text: Column, stop_words: tuple[str, ...]) -> Column:
    """Tokens of two or more signs that are no numbers and no stop words."""
    stops = F.array(*[F.lit(w) for w in stop_words])
    return F.filter(tokens(clean_text(text)), lambda t: (F.length(t) > 1) & ~t.rlike("^[0-9]+$") & ~F.array_contains(stops, t))


def reduce_elongated(word: Column) -> Column:
    """Runs of three or more equal signs become one."""
    return F.regexp_replace(word, r"(.)\1{2,}", "$1")


def normalise_token(word: Column, short: Column, domain: dict[str, str], general: dict[str, str], protected: tuple[str, ...]) -> Column:
    """Cascade for a word and its reduced form: protected; domain word; reduced form protected; domain, then general word of the reduced form; general word of the original; reduced form."""
    def lookup(table: dict[str, str], key: Column) -> Column:
        if not table:
            return F.lit(None).cast("string")
        return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)

    return F.when(word.isin(*protected), word).otherwise(F.coalesce(
        lookup(domain, word), F.when(short.isin(*protected), short), lookup(domain, short), lookup(general, short), lookup(general, word), short,
    ))


def normalised_texts(rows: DataFrame, cleaned: str, domain: dict[str, str], general: dict[str, str], protected: tuple[str, ...]) -> DataFrame:
    """Add ``normalised`` (the tokens of a cleaned text, normalised) and ``changed`` (how many of them changed). A word is reduced once, whatever the cascade asks."""
    # only a run of three equal signs is reduced, and few words have one
    forms = F.transform(tokens(F.col(cleaned)), lambda t: F.struct(t.alias("t"), reduce_elongated(t).alias("short")))
    new = F.transform("_forms", lambda p: F.struct(p["t"].alias("t"), normalise_token(p["t"], p["short"], domain, general, protected).alias("n")))
    out = rows.withColumn("_forms", forms).withColumn("_new", new)
    changed = F.size(F.filter("_new", lambda p: p["t"] != p["n"]))
    return out.withColumns({"normalised": F.array_join(F.col("_new.n"), " "), "changed": F.when(F.col("_new").isNotNull(), changed)}).drop("_forms", "_new")


# Spellings of the handling status.
REMOTE_SPELLINGS = ("REMOTE", "TRUE", "YES", "YA", "1", "T")
NON_REMOTE_SPELLINGS = ("NON_REMOTE", "NON-REMOTE", "FALSE", "NO", "TIDAK", "0", "F")


def handling_status(value: Column) -> Column:
    """REMOTE, NON_REMOTE or UNKNOWN from usual spellings."""
    v = F.upper(F.trim(value.cast("string")))
    return F.when(v.isin(*REMOTE_SPELLINGS), "REMOTE").when(v.isin(*NON_REMOTE_SPELLINGS), "NON_REMOTE").otherwise("UNKNOWN")


def clean_category(value: Column) -> Column:
    """The category, or UNKNOWN_UNCLASSIFIED for the empty spellings."""
    v = F.trim(value)
    return F.when(v.isNull() | F.lower(v).isin("", "nan", "none", "null", "unknown", "unclassified"), "UNKNOWN_UNCLASSIFIED").otherwise(v)


def display_name(name: Column, source: Column) -> Column:
    """Customer name, or Unknown with the source."""
    return F.coalesce(F.nullif(F.trim(name), F.lit("")), F.concat(F.lit("Unknown ("), source, F.lit(")")))


def remote_rate(remote: Column, other: Column) -> Column:
    """Share of remote among known handlings in percent, 0 when there are none."""
    return F.coalesce(F.try_divide(remote * 100.0, remote + other), F.lit(0.0))


def safe_int(value: Column) -> Column:
    """Whole number, 0 when it is none."""
    return F.coalesce(value.try_cast("int"), F.lit(0))


def parent_id(conversation: Column, sub: Column) -> Column:
    """The conversation id, else the sub id up to its last underscore."""
    return F.coalesce(conversation, F.regexp_replace(sub, "_[^_]*$", ""))


def letters_suffix(n: Column) -> Column:
    """a to z, aa to zz, aaa, ... for 0, 1, 2, ...: a suffix that does not repeat, for any number below 26^7."""
    rest, out = n.cast("long"), F.lit("")
    for _ in range(7):
        out = F.when(rest >= 0, F.concat(F.chr(F.lit(97) + rest % 26), out)).otherwise(out)
        rest = F.when(rest >= 0, F.floor(rest / 26) - 1).otherwise(F.lit(-1))
    return out


def decide_status(old: Column, new: Column, previous: Column) -> Column:
    """KEEP when the new label is the old one, UPDATE when a previous one that is not blank confirms it, else REVIEW."""
    return F.when(new == old, "KEEP").when((F.trim(previous.cast("string")) != "") & (new == previous), "UPDATE").otherwise("REVIEW")


def decided_label(old: Column, new: Column, previous: Column) -> Column:
    """The label that goes with the status: the new one for UPDATE, else the old one."""
    return F.when(decide_status(old, new, previous) == "UPDATE", new).otherwise(old)


def first_json(answer: Column, schema: str) -> Column:
    """The first to the last brace of an answer as a struct; a second try without trailing commas."""
    body = F.regexp_extract(answer, r"(?s)(\{.*\})", 1)
    strict = F.from_json(body, schema, {"mode": "PERMISSIVE"})
    relaxed = F.from_json(F.regexp_replace(body, r",\s*([}\]])", "$1"), schema, {"mode": "PERMISSIVE"})
    names = [part.split()[0] for part in schema.split(",")]
    return F.when(F.coalesce(*[strict[n].cast("string") for n in names]).isNotNull(), strict).otherwise(relaxed)


def softmax(scores: Column) -> Column:
    """Probabilities of an array of decision scores."""
    top = F.array_max(scores)
    powers = F.transform(scores, lambda s: F.exp(s - top))
    total = F.aggregate(powers, F.lit(0.0), lambda a, b: a + b)
    return F.transform(powers, lambda p: p / total)


# Names of export files that name no customer.
GENERIC_NAMES = ("chat", "export", "whatsapp chat", "obrolan whatsapp", "messages", "chat_parsed", "data", "whatsapp_export")
EXPORT_PREFIX = r"(?i)^(?:WhatsApp Chat|Obrolan WhatsApp|Chat) ?(?:-|with|dengan) ?(.+)$"


def customer_from_file(name: Column) -> Column:
    """Customer name in an export's file name, null for generic names, chat numbers and single signs."""
    stem = F.regexp_replace(F.regexp_extract(name, r"([^/\\]+)$", 1), r"(.)\.[^.]*$", "$1")
    stem = F.trim(F.regexp_replace(stem, r"[ \t\n]+", " "))
    named = F.trim(F.regexp_extract(stem, EXPORT_PREFIX, 1))
    generic = F.lower(stem).isin(*GENERIC_NAMES) | stem.rlike(r"(?i)^chat_[0-9]+$")
    return F.when((named != "") & ~F.lower(named).isin(*GENERIC_NAMES), named).when(~generic & (F.length(stem) > 1), stem)


# Marks of chat exports, and what a system or a sender puts for a deleted message.
OMITTED_MARKS = ("<Media tidak disertakan>", "<Media omitted>")
ATTACHED_MARK = "(file terlampir)"
DELETED_MARKS = ("Pesan ini telah dihapus", "This message was deleted", "You deleted this message", "Anda menghapus pesan ini")
MEDIA_KINDS = (
    ("image", ("jpg", "jpeg", "png", "gif", "webp")), ("video", ("mp4", "3gp", "avi", "mov")),
    ("audio", ("opus", "mp3", "aac", "ogg")), ("document", ("pdf", "doc", "docx", "xls", "xlsx")),
)


def holds_any(text: Column, marks: tuple[str, ...]) -> Column:
    """Whether a text holds one of some strings."""
    found = F.lit(False)
    for mark in marks:
        found = found | F.coalesce(text.contains(mark), F.lit(False))
    return found


def media_kind(name: Column) -> Column:
    """image, video, audio or document by the extension of a file name, else file."""
    extension = F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))
    kind = F.lit("file")
    for label, extensions in reversed(MEDIA_KINDS):
        kind = F.when(extension.isin(*extensions), label).otherwise(kind)
    return kind


def media_of(text: Column) -> Column:
    """Struct of media_type, file_name and has_media of a message."""
    omitted = holds_any(text, OMITTED_MARKS)
    name = F.trim(F.regexp_extract(text, r"([^\n]+?)[ \t\n]+[(]file terlampir[)]", 1))
    attached = name != ""
    return F.struct(
        F.when(omitted, "image").when(attached, media_kind(name)).otherwise("").alias("media_type"),
        F.when(~omitted & attached, name).otherwise("").alias("file_name"), (omitted | attached).alias("has_media"),
    )


def credential_pattern(words: tuple[str, ...]) -> str:
    """A pattern for lower text: phrases, ``id: x`` and the like, nine digits in threes, or eight or nine digits."""
    edge, end = rf"(^|[^{_WORD}])", rf"([^{_WORD}]|$)"
    return rf"{word_pattern(words)}|{edge}(id|pass|password)[ ]*:[ ]*[0-9a-z]+|{edge}[0-9]{{3}}[ ]*[0-9]{{3}}[ ]*[0-9]{{3}}{end}|{edge}[0-9]{{8,9}}{end}"
