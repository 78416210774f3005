"""Chats, customers and media: who a chat belongs to, and which chat a media file belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadline.functions.text import customer_from_file
from threadline.operators.matching import names_in_lines

# Extensions of media files.
MEDIA_EXTENSIONS = ("jpg", "jpeg", "png", "webp", "gif", "mp4", "mov", "avi", "m4a", "mp3", "aac", "ogg", "pdf", "doc", "docx", "xls", "xlsx", "csv")


def is_media(path: Column) -> Column:
    """Whether a path has the extension of a media file."""
    return F.lower(F.regexp_extract(path, r"\.([^./\\]*)$", 1)).isin(*MEDIA_EXTENSIONS)


def file_name(path: Column) -> Column:
    """Last part of a path."""
    return F.regexp_extract(path, r"([^/\\]+)$", 1)


def folder(path: Column) -> Column:
    """Path without its last part."""
    return F.regexp_replace(path, r"[/\\]?[^/\\]+$", "")


def chat_mapping(chats: DataFrame) -> DataFrame:
    """(chat_id, source_filename, customer_name) of (chat_id, path) rows: file names, or whole paths for all if any name repeats."""
    named = chats.select("chat_id", "path", file_name(F.col("path")).alias("name"))
    repeats = named.agg((F.count(F.lit(1)) != F.countDistinct("name")).alias("repeats"))  # one row
    out = named.crossJoin(F.broadcast(repeats))
    return out.select("chat_id", F.when(F.col("repeats"), F.col("path")).otherwise(F.col("name")).alias("source_filename"), customer_from_file(F.col("name")).alias("customer_name"))


def merged_mapping(old: DataFrame, new: DataFrame, key: str = "chat_id") -> DataFrame:
    """Both mappings; where both have a chat the new one wins."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def numbered_chats(new: DataFrame, last: int) -> DataFrame:
    """``chat_id`` for newly found paths, counted on after the last number in use; a row a file."""
    place = F.row_number().over(Window.orderBy(F.lower("path"), "path"))
    return new.select("path", F.format_string("chat_%d.txt", place + F.lit(last)).alias("chat_id"))


def mentioned_media(lines: DataFrame, media: DataFrame) -> DataFrame:
    """(path, chat_id) of media whose file name stands in a chat's text as a substring, any case. Only lines with an extension of media are searched."""
    names = media.select("path", F.lower(file_name(F.col("path"))).alias("name"))
    text = lines.select("chat_id", F.lower("line").alias("line")).where(F.col("line").rlike(r"\.(" + "|".join(MEDIA_EXTENSIONS) + ")"))
    found = names_in_lines(text, "chat_id", "line", names, "name").distinct()
    return names.join(found, "name").select("path", "chat_id").distinct()


def assign_media(chats: DataFrame, lines: DataFrame, media: DataFrame) -> DataFrame:
    """(path, chat_id, reason) per media file: the first chat that mentions it, else the first chat in its folder, else the only chat, else none.

    ``chats`` has (chat_id, path, place), ``lines`` (chat_id, line), ``media`` (path).
    """
    media = media.where(is_media(F.col("path"))).select("path").distinct()
    places = chats.select("chat_id", "place", folder(F.col("path")).alias("folder"))
    first = F.min_by("chat_id", "place")
    named = mentioned_media(lines, media).join(places, "chat_id").groupBy("path").agg(first.alias("named"))
    beside = places.groupBy("folder").agg(first.alias("beside"))
    only = chats.agg(F.when(F.count(F.lit(1)) == 1, F.min("chat_id")).alias("only"))  # one row
    out = media.join(named, "path", "left").join(beside, folder(F.col("path")) == F.col("folder"), "left").crossJoin(F.broadcast(only))
    reason = F.when(F.col("named").isNotNull(), "mentioned").when(F.col("beside").isNotNull(), "folder").when(F.col("only").isNotNull(), "only_chat").otherwise("unresolved")
    return out.select("path", F.coalesce("named", "beside", "only").alias("chat_id"), reason.alias("reason"))


def ingest_summary(chats: DataFrame, assigned: DataFrame) -> DataFrame:
    """One row: chats, media files, resolved and unresolved ones."""
    counts = assigned.agg(F.count(F.lit(1)).alias("media"), F.count_if(F.col("chat_id").isNotNull()).alias("resolved"), F.count_if(F.col("chat_id").isNull()).alias("unresolved"))
    return chats.agg(F.count(F.lit(1)).alias("chats")).crossJoin(counts)


def media_map(chats: DataFrame, assigned: DataFrame) -> DataFrame:
    """(chat_id, media) for every chat: the paths of its media in order, an empty list for none."""
    own = assigned.where("chat_id is not null").groupBy("chat_id").agg(F.array_sort(F.collect_list("path")).alias("_media"))
    return chats.select("chat_id").join(own, "chat_id", "left").select("chat_id", F.coalesce("_media", F.array().cast("array<string>")).alias("media"))


def unresolved_media(assigned: DataFrame) -> DataFrame:
    """(path, filename, reason) of media that no chat has."""
    return assigned.where("chat_id is null").select("path", file_name(F.col("path")).alias("filename"), F.lit("unable_to_determine_chat").alias("reason"))


def ingest_warnings(chats: DataFrame) -> DataFrame:
    """(warning): one row if no chat was found."""
    return chats.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit("no valid chat file was found").alias("warning"))
