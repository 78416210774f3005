import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from threadline import dims
from threadline.operators import chat, matching, scans
from threadline.sources import exports, mapping


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_one_source_over_many_slices(spark):
    rng = random.Random(1)
    start, rows = datetime(2024, 1, 1), []
    for i in range(3000):
        start += timedelta(minutes=rng.choice([0, 1, 30, 200, 240, 900]))
        words = rng.choice(["from here", "with it", "for you", "nothing", None])
        rows.append((i, "hot" if i % 3 else f"s{i % 20}", None if i % 50 == 0 else start, rng.choice(["CLIENT", "ADMIN", "SYSTEM"]), words))
    rows += [(5000, None, start, "CLIENT", "from"), (5001, None, start + timedelta(days=9), "CLIENT", "with")]
    df = spark.createDataFrame(rows, "id long, source string, ts timestamp, role string, text string")
    counted = F.col("role") != "SYSTEM"
    want = chat.sessionise(df, ["source"], ["ts", "id"], 4, counts=counted).select("id", "session_no")
    got = scans.sessions_by_slice(df, ["source"], ["ts", "id"], F.date_trunc("day", "ts"), 4, counts=counted).select("id", "session_no")
    assert rows_of(got) == rows_of(want)
    want = chat.split_topics(df, ["source"], ["id"], dims.TAXONOMY).select("id", "segment", "category", "suffix")
    got = scans.topics_by_slice(df, ["source"], ["id"], F.expr("id div 17"), dims.TAXONOMY).select("id", "segment", "category", "suffix")
    assert rows_of(got) == rows_of(want)
    # the hot source is dealt out: no task of the windows holds more than a day of it
    sliced = df.withColumn("_slice", F.expr("id div 17"))
    assert sliced.groupBy("source", "_slice").count().agg(F.max("count")).first()[0] <= 17
    assert scans.sessions_by_slice(df.limit(0), ["source"], ["ts", "id"], F.col("ts")).collect() == []


def export_text(rng, n):
    lines = ["before any message"]
    for i in range(n):
        kind = rng.randrange(6)
        stamp = f"{1 + i % 28}/2/24 {i % 24}.{i % 60:02d} - "
        lines += [[stamp + f"ann: text {i} é"], [stamp + "notice"], ["goes on", "", "  and on"], ["﻿" + stamp + "bob: <Media omitted>"], [""], [stamp + "ann: img.jpg (file terlampir)", "tail " * rng.randrange(30)]][kind]
    return lines


def test_a_file_in_many_byte_ranges(spark, tmp_path):
    rng = random.Random(2)
    (tmp_path / "in" / "sub+x y").mkdir(parents=True)
    (tmp_path / "in" / "big.txt").write_bytes("\n".join(export_text(rng, 4000)).encode())
    (tmp_path / "in" / "sub+x y" / "big.txt").write_bytes("\r\n".join(export_text(rng, 50)).encode() + b"\r\n")
    (tmp_path / "in" / "old.txt").write_bytes("\n".join(export_text(rng, 300)).encode("latin-1", "ignore"))
    (tmp_path / "in" / "empty.txt").write_bytes(b"")
    folder = str(tmp_path / "in")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    names = ["source_file", "msg_no", "line_no", "sent_date", "sent_time", "sender", "text", "media_type", "file_name", "has_media"]
    whole = exports.read_exports(spark, folder)
    files = whole.withColumn("source_file", F.regexp_extract("path", "in/(.*)$", 1))
    want = rows_of(exports.fold_lines(files).select(*names))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "1024")
        lines = exports.read_splits(spark, folder)
        assert lines.where("source_file = 'big.txt' and path not like '%sub%'").select("split").distinct().count() > 10
        got = rows_of(exports.fold_splits(lines).withColumn("source_file", F.regexp_extract("path", "in/(.*)$", 1)).select(*names))
        numbered = rows_of(exports.numbered_lines(lines).where("line <> ''").select("path", "line_no", "line"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was[0])
        spark.conf.set("spark.sql.files.openCostInBytes", was[1])
    assert got == want and len(got) > 2000
    assert numbered == rows_of(whole.where("line <> ''").select(F.concat(F.lit("file:"), F.regexp_replace("path", "^file:/*", "/")).alias("path"), "line_no", "line"))


def test_names_in_lines_against_all_pairs(spark):
    rng = random.Random(3)
    names = ["".join(rng.choices("ab.-", k=rng.randrange(1, 5))) for _ in range(60)] + ["", None, "ä", "img-1.jpg", "g-1.jp"]
    lines = [(i, "".join(rng.choices("ab.- ", k=rng.randrange(12)))) for i in range(300)] + [(900, "ximg-1.jpgx ä"), (901, None), (900, "again img-1.jpg")]
    table, text = spark.createDataFrame([(n,) for n in names], "n string"), spark.createDataFrame(lines, "i long, t string")
    want = sorted((i, n) for i, t in lines if t for n in {n for n in names if n} if n in t)
    for shard, part in ((100_000, 200_000), (7, 40)):
        got = matching.names_in_lines(text, "i", "t", table, "n", shard, part)
        assert sorted((r["i"], r["n"]) for r in got.collect()) == want
    assert matching.names_in_lines(text.limit(0), "i", "t", table, "n").collect() == []
    assert matching.names_in_lines(text, "i", "t", table.limit(0), "n").collect() == []


def test_media_names_inside_longer_words(spark):
    media = spark.createDataFrame([("m/img-1.jpg",), ("m/__.pdf",), ("m/日本.png",)], "path string")
    lines = spark.createDataFrame([("A", "see ximg-1.jpgx"), ("B", "img and jpg alone"), ("C", "a__.pdf and 日本.PNG")], "chat_id string, line string")
    assert {(r["path"], r["chat_id"]) for r in mapping.mentioned_media(lines, media).collect()} == {("m/img-1.jpg", "A"), ("m/__.pdf", "C"), ("m/日本.png", "C")}
