"""The given tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadline.dims import ROLES
from threadline.operators.chat import assign_roles, sessionise

HANDLING = {"purchase": "REMOTE", "signup": "REMOTE", "click": "NON_REMOTE", "view": "NON_REMOTE"}

EVENTS_SQL = """
ev AS (
  SELECT event_id, ts, user_id, event_type, CASE WHEN event_type = 'error' THEN 'SYSTEM' WHEN event_type = 'view' THEN 'ADMIN' ELSE 'CLIENT' END AS role,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'REMOTE' WHEN event_type IN ('click', 'view') THEN 'NON_REMOTE' ELSE 'UNKNOWN' END AS handling
  FROM events
), prev AS (
  SELECT *, last_value(CASE WHEN role <> 'SYSTEM' THEN ts END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_ts,
         lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS lag_ts FROM ev
), sess AS (
  SELECT *, 1 + sum(CASE WHEN role <> 'SYSTEM' AND epoch_us(ts) - epoch_us(prev_ts) >= 14400000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_no FROM prev
)"""

MASTER_SQL = f"""{EVENTS_SQL}, master AS (
  SELECT user_id, session_no::BIGINT AS session_no, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS total_messages, count(*) FILTER (WHERE role = 'CLIENT') AS client_messages,
         count(*) FILTER (WHERE role = 'ADMIN') AS admin_messages, arg_min(event_type, (ts, event_id)) AS category, arg_min(handling, (ts, event_id)) AS handling
  FROM sess GROUP BY user_id, session_no
)"""

MESSAGES_SQL = """
msg AS (
  SELECT conv_id, turn, text, CASE role WHEN 'user' THEN 'CLIENT' WHEN 'assistant' THEN 'ADMIN' WHEN 'system' THEN 'SYSTEM' ELSE 'UNKNOWN' END AS role, role AS sender FROM conversations
)"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages: source is the user, errors are system rows."""
    role = F.when(F.col("event_type") == "error", "SYSTEM").when(F.col("event_type") == "view", "ADMIN").otherwise("CLIENT")
    handling = F.when(F.col("event_type").isin("purchase", "signup"), "REMOTE").when(F.col("event_type").isin("click", "view"), "NON_REMOTE").otherwise("UNKNOWN")
    return read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", role.alias("role"), handling.alias("handling"))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their session."""
    return sessionise(events(spark, sf_dir), ["user_id"], ["ts", "event_id"], 4, counts=F.col("role") != "SYSTEM")


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per session; grouped on the window's key, so without another exchange of rows."""
    first = lambda c: F.min_by(c, F.struct("ts", "event_id"))
    return sessions(spark, sf_dir).groupBy("user_id", "session_no").agg(
        F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count(F.lit(1)).alias("total_messages"), F.count_if(F.col("role") == "CLIENT").alias("client_messages"),
        F.count_if(F.col("role") == "ADMIN").alias("admin_messages"), first("event_type").alias("category"), first("handling").alias("handling"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as messages with roles."""
    return assign_roles(read(spark, sf_dir, "conversations").withColumnRenamed("role", "sender"), ROLES)
