"""Queries on tables that are read as streams of files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from threadline.operators.features import checkpoint_folder
from threadline.plans.frames import EVENTS_SQL, events
from threadline.streaming import ingest, sessions


def _ingested_days(s, d):
    """Events by day and type after incremental ingest."""
    stream = ingest.file_stream(s, f"{d}/events.parquet*")  # a pattern, as a stream takes no path of a single file
    folder = f"{checkpoint_folder(s)}/ingest-{uuid.uuid4().hex}"
    ingest.ingest(stream, f"{folder}/events", f"{folder}/state")
    rows = ingest.ingested(s, f"{folder}/events", stream.schema)
    return rows.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"), F.max("value").alias("largest"))


def _session_stream(s, d):
    """Events numbered by a stream of files. A last row, years later, moves the watermark past all others; it is its own source and does not come out."""
    folder = f"{checkpoint_folder(s)}/sessions-{uuid.uuid4().hex}"
    rows = events(s, d).select("event_id", "user_id", "ts", "role")
    rows.write.parquet(f"{folder}/in/all")
    rows.agg(F.max("event_id").alias("event_id"), F.max("user_id").alias("user_id"), F.max("ts").alias("ts")).select(F.col("event_id") + 1, F.col("user_id") + 1, F.col("ts") + F.expr("interval 3 years"), F.lit("CLIENT")).toDF("event_id", "user_id", "ts", "role").write.parquet(f"{folder}/in/last")
    stream = s.readStream.schema(rows.schema).parquet(f"{folder}/in/*")
    numbered = sessions.stream_sessions(stream, "user_id", "event_id", "ts", F.col("role") != "SYSTEM")
    sessions.run_to_end(numbered, f"{folder}/out", f"{folder}/state")
    return s.read.parquet(f"{folder}/out").select(F.col("id").alias("event_id"), F.col("source").alias("user_id"), "session_no")


QUERIES = {"ingested_days": _ingested_days, "session_stream": _session_stream}
ORACLES = {
    "session_stream": f"WITH {EVENTS_SQL} SELECT event_id, user_id, session_no::BIGINT AS session_no FROM sess",
    "ingested_days": "WITH e AS (SELECT DISTINCT ON (event_id, ts) * FROM events WHERE event_id IS NOT NULL) SELECT ts::DATE AS day, event_type, count(*) AS n, count(DISTINCT user_id) AS users, max(value) AS largest FROM e GROUP BY ALL",
}
