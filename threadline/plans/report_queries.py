"""Queries on sessions and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadline.operators import distributions, profile, reports, scans
from threadline.operators.chat import first_rows, time_anomalies, time_order_report
from threadline.plans.frames import EVENTS_SQL, MASTER_SQL, events, master, read, sessions

_COUNTS = "count(*) AS total, count(*) FILTER (WHERE handling = 'REMOTE') AS remote, count(*) FILTER (WHERE handling = 'NON_REMOTE') AS non_remote, count(*) FILTER (WHERE handling = 'UNKNOWN') AS unknown"
_RATE = "CASE WHEN remote + non_remote > 0 THEN remote * 100.0::DOUBLE / (remote + non_remote) ELSE 0.0::DOUBLE END AS rate"


def _top(source: str, keys: str) -> str:
    return f"SELECT {keys}, category AS top_category, n AS top_category_count FROM (SELECT {keys}, category, count(*) AS n, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, category) AS r FROM {source} GROUP BY {keys}, category) WHERE r = 1"


def _series(period: str) -> str:
    shape = {"day": "%Y-%m-%d", "week": "%Y-%m-%d", "month": "%Y-%m", "year": "%Y"}[period]
    return f"""WITH {MASTER_SQL}, timed AS (SELECT *, strftime(date_trunc('{period}', start_ts), '{shape}') AS period FROM master),
c AS (SELECT period, {_COUNTS} FROM timed GROUP BY period), t AS ({_top("timed", "period")})
SELECT c.*, {_RATE}, t.top_category, t.top_category_count FROM c LEFT JOIN t USING (period)"""


def _predicted(s, d):
    """Sessions as units, two of three with a prediction: purchase for longer ones, else their own category."""
    units = master(s, d).withColumns({"sub_id": F.format_string("user_%d_%03d", "user_id", "session_no"), "source_file": F.format_string("user_%d.txt", "user_id")})
    scored = units.where("session_no % 3 <> 0").select("sub_id", F.when(F.col("total_messages") > 1, "purchase").otherwise(F.col("category")).alias("predicted"), F.lit(50.0).alias("confidence"))
    return distributions.with_prediction(units, scored)


def _names(s, d):
    """Names of every third user's export."""
    users = read(s, d, "events").select("user_id").distinct().where("user_id % 3 = 0")
    return users.select(F.format_string("user_%d.txt", "user_id").alias("source_filename"), F.format_string("customer %d", "user_id").alias("customer_name"))


def _named_units(s, d):
    """Sessions with the name of their customer."""
    return distributions.with_customer(_predicted(s, d), _names(s, d))


_PREDICTED = f"""WITH {MASTER_SQL}, q AS (SELECT *, printf('user_%d_%03d', user_id, session_no) AS sub_id, CASE WHEN session_no % 3 <> 0 THEN CASE WHEN total_messages > 1 THEN 'purchase' ELSE category END END AS predicted FROM master),
p AS (SELECT *, CASE WHEN category = predicted THEN 'MATCH' ELSE 'DIFFER' END AS match FROM q)"""

QUERIES = {
    "flagship_sessions_timeseries": lambda s, d: reports.time_series(master(s, d), "day", "category", "start_ts"),
    "series_week": lambda s, d: reports.time_series(master(s, d), "week", "category", "start_ts"),
    "series_month": lambda s, d: reports.time_series(master(s, d), "month", "category", "start_ts"),
    "series_year": lambda s, d: reports.time_series(master(s, d), "year", "category", "start_ts"),
    "session_numbers": lambda s, d: sessions(s, d).select("event_id", "user_id", "session_no"),
    "match_rate": lambda s, d: distributions.match_rate(_predicted(s, d)),
    "filtered_units": lambda s, d: reports.matching_any(_predicted(s, d), query="user_1", columns=("sub_id",), category=(" purchase ", ("category", "predicted")), remote_upper=("remote", ("handling",))).select("sub_id", "category", "predicted", "handling"),
    "customer_units": lambda s, d: distributions.with_customer(_predicted(s, d), _names(s, d)).groupBy("customer").agg(F.count(F.lit(1)).alias("units")),
    "session_slices": lambda s, d: scans.sessions_by_slice(events(s, d), ["user_id"], ["ts", "event_id"], F.date_trunc("week", "ts"), 4, counts=F.col("role") != "SYSTEM").select("event_id", "user_id", "session_no"),
    "master": lambda s, d: master(s, d),
    "overview": lambda s, d: reports.overview(master(s, d).withColumn("conv", F.concat_ws("_", "user_id", "session_no")), "conv", "category", "start_ts"),
    "issues": lambda s, d: reports.breakdown(master(s, d), "category", share=True),
    "remote_by_customer": lambda s, d: reports.breakdown(master(s, d).withColumn("customer", F.col("user_id").cast("string")), "customer"),
    "customers": lambda s, d: (lambda m: reports.breakdown(m, "user_id").join(reports.top_value(m, ["user_id"], "category"), "user_id", "left"))(master(s, d)),
    "customer_search": lambda s, d: reports.matching(reports.breakdown(_named_units(s, d), "customer"), "STOMER 1", ("customer",)),
    "issue_view": lambda s, d: reports.matching(reports.breakdown(master(s, d), "category", share=True), category="purchase"),
    "kpi_shares": lambda s, d: reports.shares(master(s, d).agg(*reports.handling_counts())),
    "period_change": lambda s, d: reports.period_change(reports.time_series(master(s, d), "week", "category", "start_ts")),
    "concentration": lambda s, d: reports.concentration(reports.breakdown(master(s, d), "user_id").withColumnRenamed("user_id", "customer")),
    "category_breakdown": lambda s, d: master(s, d).groupBy("category").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("handling") == "REMOTE").alias("remote"), (F.count(F.lit(1)) - F.count_if(F.col("handling") == "REMOTE")).alias("not_remote"),
        F.avg("total_messages").alias("mean_messages")),
    "zero_filled": lambda s, d: reports.zero_filled(
        read(s, d, "events").select(F.col("event_type").alias("category")).distinct(), master(s, d).where("total_messages > 3").groupBy("category").agg(F.count(F.lit(1)).alias("total"))),
    "page": lambda s, d: reports.page(master(s, d), ["start_ts", "user_id", "session_no"], 2, 50).select("user_id", "session_no", "start_ts"),
    "date_range": lambda s, d: reports.in_range(master(s, d), "start_ts", "2024-01-05", "2024-01-06").select("user_id", "session_no", "category"),
    "first_session_rows": lambda s, d: first_rows(sessions(s, d).withColumn("sub", F.concat_ws("_", "user_id", "session_no")), "sub", ["ts", "event_id"]).select("sub", "event_id"),
    "gap_buckets": lambda s, d: profile.gap_buckets(events(s, d), ["user_id"], ["ts", "event_id"]),
    "gap_percentiles": lambda s, d: profile.rank_percentiles(profile.time_gaps(events(s, d), ["user_id"], ["ts", "event_id"]).where("gap_us >= 0"), "gap_us"),
    "threshold_simulation": lambda s, d: profile.threshold_simulation(events(s, d), ["user_id"], ["ts", "event_id"]),
    "session_sizes": lambda s, d: master(s, d).groupBy("total_messages").agg(F.count(F.lit(1)).alias("sessions")),
    "session_median": lambda s, d: profile.upper_median(master(s, d), "total_messages", ["category"]),
    "session_composition": lambda s, d: master(s, d).agg(
        F.count_if((F.col("client_messages") > 0) & (F.col("admin_messages") > 0)).alias("dialog"), F.count_if((F.col("client_messages") > 0) & (F.col("admin_messages") == 0)).alias("client_only"),
        F.count_if((F.col("client_messages") == 0) & (F.col("admin_messages") > 0)).alias("admin_only"), F.count_if((F.col("client_messages") == 0) & (F.col("admin_messages") == 0)).alias("system_only")),
    "time_order_anomalies": lambda s, d: time_anomalies(events(s, d), ["user_id"], ["event_id"]).select("event_id", "gap_us"),
    "time_order_report": lambda s, d: time_order_report(read(s, d, "orders"), "o_custkey", "o_orderkey", "o_orderdate"),
    "issues_view": lambda s, d: reports.report_view(reports.breakdown(master(s, d), "category", share=True), ("total", "remote", "non_remote", "unknown"), ("rate", "share")),
    "share_by_key": lambda s, d: profile.counts_with_share(read(s, d, "events"), ["event_type"]),
}

_GAPS = f"{EVENTS_SQL}, gaps AS (SELECT *, epoch_us(ts) - epoch_us(lag_ts) AS gap_us FROM prev)"
ORACLES = {
    "flagship_sessions_timeseries": _series("day"),
    "series_week": _series("week"),
    "series_month": _series("month"),
    "series_year": _series("year"),
    "session_numbers": f"WITH {EVENTS_SQL} SELECT event_id, user_id, session_no::BIGINT AS session_no FROM sess",
    "match_rate": f"{_PREDICTED}, g AS (SELECT category, count(*) AS total, count(*) FILTER (WHERE match = 'MATCH') AS matched FROM p GROUP BY ROLLUP (category)) SELECT category, total, matched, matched * 100.0::DOUBLE / total AS percent FROM g",
    "filtered_units": f"{_PREDICTED} SELECT sub_id, category, predicted, handling FROM p WHERE contains(sub_id, 'user_1') AND (category = 'purchase' OR predicted = 'purchase') AND upper(handling) = 'REMOTE'",
    "customer_units": f"{_PREDICTED} SELECT CASE WHEN user_id % 3 = 0 THEN 'customer ' || user_id ELSE 'Unknown (user_' || user_id || '.txt)' END AS customer, count(*) AS units FROM p GROUP BY 1",
    "session_slices": f"WITH {EVENTS_SQL} SELECT event_id, user_id, session_no::BIGINT AS session_no FROM sess",
    "master": f"WITH {MASTER_SQL} SELECT * FROM master",
    "overview": f"WITH {MASTER_SQL}, c AS (SELECT {_COUNTS}, count(DISTINCT user_id || '_' || session_no) AS conversations, min(start_ts::DATE)::VARCHAR AS first_day, max(start_ts::DATE)::VARCHAR AS last_day FROM master), k AS (SELECT *, 1 AS one FROM master), t AS ({_top('k', 'one')}) SELECT c.*, t.top_category, t.top_category_count, {_RATE} FROM c, t",
    "issues": f"WITH {MASTER_SQL}, c AS (SELECT category, {_COUNTS} FROM master GROUP BY category) SELECT c.*, {_RATE}, total * 100.0::DOUBLE / sum(total) OVER () AS share FROM c",
    "remote_by_customer": f"WITH {MASTER_SQL}, c AS (SELECT user_id::VARCHAR AS customer, {_COUNTS} FROM master GROUP BY 1) SELECT c.*, {_RATE} FROM c",
    "customers": f"WITH {MASTER_SQL}, c AS (SELECT user_id, {_COUNTS} FROM master GROUP BY 1), t AS ({_top('master', 'user_id')}) SELECT c.*, {_RATE}, t.top_category, t.top_category_count FROM c LEFT JOIN t USING (user_id)",
    "kpi_shares": f"WITH {MASTER_SQL} SELECT h AS handling, count(m.handling) AS n, count(m.handling) * 100.0::DOUBLE / (SELECT count(*) FROM master) AS share FROM (VALUES ('REMOTE'), ('NON_REMOTE'), ('UNKNOWN')) v(h) LEFT JOIN master m ON m.handling = h GROUP BY h",
    "period_change": f"WITH {MASTER_SQL}, c AS (SELECT strftime(date_trunc('week', start_ts), '%Y-%m-%d') AS period, count(*) AS total FROM master GROUP BY 1), l AS (SELECT *, lag(total) OVER (ORDER BY period) AS previous FROM c) SELECT period, total, previous, (total - previous)::DOUBLE / previous AS change FROM l",
    "concentration": f"WITH {MASTER_SQL}, c AS (SELECT user_id, count(*) AS n FROM master GROUP BY 1), r AS (SELECT n, row_number() OVER (ORDER BY n DESC, user_id) AS r FROM c) SELECT sum(n)::DOUBLE / count(*) AS mean_rows, sum(CASE WHEN r <= 10 THEN n ELSE 0 END) * 100.0::DOUBLE / sum(n) AS top10_share, sum(CASE WHEN r <= 25 THEN n ELSE 0 END) * 100.0::DOUBLE / sum(n) AS top25_share, count(*) FILTER (WHERE n = 1) AS single FROM r",
    "category_breakdown": f"WITH {MASTER_SQL} SELECT category, count(*) AS total, count(*) FILTER (WHERE handling = 'REMOTE') AS remote, count(*) FILTER (WHERE handling <> 'REMOTE') AS not_remote, avg(total_messages) AS mean_messages FROM master GROUP BY 1",
    "zero_filled": f"WITH {MASTER_SQL} SELECT e.category, count(m.category) AS total FROM (SELECT DISTINCT event_type AS category FROM events) e LEFT JOIN (SELECT category FROM master WHERE total_messages > 3) m USING (category) GROUP BY 1",
    "page": f"WITH {MASTER_SQL} SELECT user_id, session_no, start_ts FROM master ORDER BY start_ts, user_id, session_no LIMIT 50 OFFSET 50",
    "date_range": f"WITH {MASTER_SQL} SELECT user_id, session_no, category FROM master WHERE start_ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-06'",
    "first_session_rows": f"WITH {EVENTS_SQL} SELECT user_id || '_' || session_no::BIGINT AS sub, arg_min(event_id, (ts, event_id)) AS event_id FROM sess GROUP BY 1",
    "gap_buckets": f"WITH {_GAPS} SELECT (CASE WHEN gap_us < 1800000000 THEN 0 WHEN gap_us < 3600000000 THEN 1 WHEN gap_us < 7200000000 THEN 2 WHEN gap_us < 14400000000 THEN 3 WHEN gap_us < 28800000000 THEN 4 WHEN gap_us < 86400000000 THEN 5 ELSE 6 END)::INT AS bucket, count(*) AS n, min(gap_us) AS least, max(gap_us) AS largest FROM gaps WHERE gap_us >= 0 GROUP BY 1",
    "gap_percentiles": f"WITH {_GAPS}, r AS (SELECT gap_us, row_number() OVER (ORDER BY gap_us) - 1 AS i, count(*) OVER () AS n FROM gaps WHERE gap_us >= 0) SELECT p::INT AS percent, gap_us AS value FROM r, (VALUES (50), (75), (90), (95), (99)) v(p) WHERE i = least(n * p // 100, n - 1)",
    "threshold_simulation": f"WITH {_GAPS}, one AS (SELECT h, count(*) AS n, count(DISTINCT user_id) + count(*) FILTER (WHERE gap_us >= h * 3600000000) AS sessions FROM gaps, (VALUES (1), (2), (3), (4), (6), (8), (12), (24)) v(h) GROUP BY h) SELECT h::INT AS hours, sessions, n::DOUBLE / sessions AS mean_rows FROM one",
    "session_sizes": f"WITH {MASTER_SQL} SELECT total_messages, count(*) AS sessions FROM master GROUP BY 1",
    "session_median": f"WITH {MASTER_SQL}, r AS (SELECT category, total_messages, row_number() OVER (PARTITION BY category ORDER BY total_messages) AS i, count(*) OVER (PARTITION BY category) AS n FROM master) SELECT category, total_messages AS median FROM r WHERE i = n // 2 + 1",
    "session_composition": f"WITH {MASTER_SQL} SELECT count(*) FILTER (WHERE client_messages > 0 AND admin_messages > 0) AS dialog, count(*) FILTER (WHERE client_messages > 0 AND admin_messages = 0) AS client_only, count(*) FILTER (WHERE client_messages = 0 AND admin_messages > 0) AS admin_only, count(*) FILTER (WHERE client_messages = 0 AND admin_messages = 0) AS system_only FROM master",
    "time_order_anomalies": "SELECT event_id, gap_us FROM (SELECT event_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY event_id)) AS gap_us FROM events) WHERE gap_us < 0",
    "time_order_report": """WITH g AS (SELECT *, epoch_us(o_orderdate) - epoch_us(last_value(o_orderdate IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS gap FROM orders),
l AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM g WHERE gap < 0)
SELECT o_custkey, count(o_orderkey) AS anomalies, coalesce(string_agg(o_orderkey || ' at ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ', ' || -gap // 60000000 || ' minutes back', '; ' ORDER BY o_orderkey) FILTER (WHERE r <= 3), '') AS samples
FROM (SELECT DISTINCT o_custkey FROM orders) LEFT JOIN l USING (o_custkey) GROUP BY 1""",
    "share_by_key": "SELECT event_type, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS share FROM events GROUP BY 1",
}
_SHOWN = ", ".join([f"format('{{:,}}', {c}::BIGINT) AS {c}" for c in ("total", "remote", "non_remote", "unknown")] + [f"printf('%.1f%%', {c}) AS {c}" for c in ("rate", "share")])
ORACLES["issues_view"] = f"SELECT category, {_SHOWN} FROM ({ORACLES['issues']})"
ORACLES["customer_search"] = f"{_PREDICTED}, x AS (SELECT *, CASE WHEN user_id % 3 = 0 THEN 'customer ' || user_id ELSE 'Unknown (user_' || user_id || '.txt)' END AS customer FROM p), c AS (SELECT customer, {_COUNTS} FROM x GROUP BY 1) SELECT c.*, {_RATE} FROM c WHERE contains(lower(customer), 'stomer 1')"
ORACLES["issue_view"] = f"SELECT * FROM ({ORACLES['issues']}) WHERE category = 'purchase'"
