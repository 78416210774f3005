import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from threadline.operators import chat
from threadline.streaming import ingest, sessions


def test_ingest_in_steps(spark, tmp_path):
    source, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    day = lambda n: datetime(2024, 1, n, 12)
    schema = "event_id long, ts timestamp, text string, batch string"

    def arrive(*rows):
        spark.createDataFrame([(*r, "x") for r in rows], schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = ingest.file_stream(spark, source, 1)
        ingest.ingest(stream, sink, state)
        return sorted((r.event_id or 0, r.ts.day if r.ts else 0, r.text) for r in ingest.ingested(spark, sink, stream.drop("batch").schema).collect())

    arrive((1, day(5), "a"), (1, day(5), "a"), (2, day(6), "b"), (None, day(6), "c"), (None, day(6), "c"))
    first = [(0, 6, "c"), (0, 6, "c"), (1, 5, "a"), (2, 6, "b")]
    assert run() == first
    assert run() == first  # nothing new
    arrive((2, day(6), "b"), (3, day(1), "late"), (1, day(7), "other time"), (4, None, "no time"))
    arrive((4, None, "no time"), (3, day(1), "late"))
    assert run() == sorted([*first, (1, 7, "other time"), (3, 1, "late"), (4, 0, "no time")])


def test_sessions_of_reordered_files(spark, tmp_path):
    rng = random.Random(6)
    start, rows = datetime(2024, 1, 1), []
    for i in range(600):
        start += timedelta(minutes=rng.choice([1, 20, 100, 239, 240, 241, 700]))
        rows.append((i, rng.randrange(3), start, rng.choice(["CLIENT", "CLIENT", "SYSTEM"])))
    end = (9999, 99, start + timedelta(days=400), "CLIENT")
    schema = "id long, source long, ts timestamp, role string"
    folder, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    counted = F.col("role") != "SYSTEM"
    stream = lambda: sessions.stream_sessions(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder), "source", "id", "ts", counted, "3 days")
    # files overlap in time: rows change places with others of the same day or two
    order = sorted(range(600), key=lambda k: rows[k][2] + timedelta(hours=rng.randrange(40)))
    for part in range(6):
        spark.createDataFrame([rows[k] for k in order[part * 100 : part * 100 + 100]], schema).coalesce(1).write.mode("append").parquet(folder)
        sessions.run_to_end(stream(), sink, state)  # stopped and started again after every file
    before = spark.read.parquet(sink).count()
    assert 0 < before < 600  # the last rows wait for the watermark
    spark.createDataFrame([end], schema).coalesce(1).write.mode("append").parquet(folder)
    sessions.run_to_end(stream(), sink, state)
    want = chat.sessionise(spark.createDataFrame(rows, schema), ["source"], ["ts", "id"], 4, counts=counted)
    got = spark.read.parquet(sink)
    plain = lambda df, s, i: sorted((r[s], r[i], r["ts"], r["session_no"]) for r in df.collect())
    assert plain(got, "source", "id") == plain(want, "source", "id")


def test_sources_share_states(spark, tmp_path):
    """As many states as there are shares, however many sources; one without a number is a source, and clocks of any zone agree."""
    rng = random.Random(7)
    start, rows = datetime(2024, 3, 30), []
    for i in range(900):
        start += timedelta(minutes=rng.choice([0, 1, 2, 20]))
        rows.append((i, rng.choice([None, *range(-20, 20), 2**53 + 1]), start, rng.choice(["CLIENT", "CLIENT", "SYSTEM", None])))
    schema = "id long, source long, ts timestamp, role string"
    folder, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    counted = F.col("role") != "SYSTEM"
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        given = spark.createDataFrame(rows, schema)
        for part in ((0, 400), (400, 900)):
            given.where(F.col("id").between(part[0], part[1] - 1)).coalesce(1).write.mode("append").parquet(folder)
        spark.createDataFrame([(9999, 99, start + timedelta(days=400), "CLIENT")], schema).coalesce(1).write.mode("append").parquet(folder)
        stream = sessions.stream_sessions(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder), "source", "id", "ts", counted, "3 days", shares=4)
        run = stream.writeStream.format("parquet").option("checkpointLocation", state).option("path", sink).trigger(availableNow=True).start()
        run.awaitTermination()
        assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress) <= 4 + 1
        micros = F.unix_micros("ts")
        got = spark.read.parquet(sink).select("source", "id", micros, "session_no").collect()
        # the clock of sessionise does not move for rows of no known kind either
        want = chat.sessionise(given, ["source"], ["ts", "id"], 4, counts=F.coalesce(counted, F.lit(False))).select("source", "id", micros, "session_no").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 900
