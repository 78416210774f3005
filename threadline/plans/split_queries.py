"""Queries that deal rows into folds, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadline.operators import splits
from threadline.plans.frames import read

FOLDS = 5


def _labelled(s, d):
    """Labelled documents with their source."""
    docs = read(s, d, "documents").select("doc_id", "source")
    return docs.join(read(s, d, "labels").select("doc_id", F.col("quality").cast("string").alias("label")), "doc_id")


def _events(s, d):
    return read(s, d, "events").select("event_id", "user_id", "event_type")


#: The greedy deal as a recursion: one group a step, the state being the folds' class counts.
_GREEDY = f"""WITH RECURSIVE rows_ AS (SELECT user_id AS g, event_type AS l FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL),
classes AS (SELECT l, row_number() OVER (ORDER BY l) AS c FROM (SELECT DISTINCT l FROM rows_)),
cells AS (SELECT g.g, c.c, (SELECT count(*) FROM rows_ r WHERE r.g = g.g AND r.l = c.l)::DOUBLE AS n FROM (SELECT DISTINCT g FROM rows_) g, classes c),
hists AS (SELECT g, list(n ORDER BY c) AS h, count(*) * sum(n * n) - sum(n) * sum(n) AS spread FROM cells GROUP BY g),
numbered AS (SELECT g, h, row_number() OVER (ORDER BY spread DESC, g) AS no FROM hists),
total AS (SELECT list(n ORDER BY c) AS t FROM (SELECT c, sum(n) AS n FROM cells GROUP BY c)),
steps(no, state, fold) AS (
  SELECT 0::BIGINT, list_transform(range({FOLDS}), lambda f: list_transform(t, lambda x: 0.0::DOUBLE)), 0::BIGINT FROM total
  UNION ALL
  SELECT no, list_transform(state, lambda s, i: CASE WHEN i = best.f THEN list_transform(s, lambda x, k: x + h[k]) ELSE s END), best.f
  FROM (
    SELECT n.no, n.h, p.state, list_reduce(list_transform(range(1, {FOLDS} + 1), lambda f: struct_pack(f := f, size := list_sum(p.state[f]),
      e := list_avg(list_transform(t, lambda x, k: list_stddev_pop(list_transform(p.state, lambda s, i: (s[k] + CASE WHEN i = f THEN n.h[k] ELSE 0 END) / t[k])))))),
      lambda a, b: CASE WHEN (b.e < a.e AND abs(b.e - a.e) > 1e-8 + 1e-5 * abs(a.e)) OR (abs(b.e - a.e) <= 1e-8 + 1e-5 * abs(a.e) AND b.size < a.size) THEN b ELSE a END) AS best
    FROM steps p JOIN numbered n ON n.no = p.no + 1, total
  )
)"""

QUERIES = {
    "group_folds": lambda s, d: splits.group_folds(_events(s, d), "user_id", "event_type", FOLDS).select("user_id", "fold").distinct(),
    "group_fold_shares": lambda s, d: splits.fold_shares(splits.group_folds(_events(s, d), "user_id", "event_type", FOLDS), "event_type"),
    "stratified_folds": lambda s, d: splits.stratified_folds(_labelled(s, d), "doc_id", "label", FOLDS).select("doc_id", "label", "fold"),
}
ORACLES = {
    "group_folds": f"{_GREEDY} SELECT n.g AS user_id, (s.fold - 1)::INT AS fold FROM steps s JOIN numbered n USING (no)",
    "group_fold_shares": f"{_GREEDY} SELECT fold, event_type, n, n / sum(n) OVER (PARTITION BY fold) AS share FROM (SELECT (s.fold - 1)::INT AS fold, r.l AS event_type, count(*) AS n FROM steps s JOIN numbered x USING (no) JOIN rows_ r ON r.g = x.g GROUP BY 1, 2)",
    "stratified_folds": f"SELECT d.doc_id, l.quality::VARCHAR AS label, ((row_number() OVER (PARTITION BY l.quality ORDER BY ('0x' || substr(md5(d.doc_id::VARCHAR), 1, 8))::BIGINT, d.doc_id) - 1) % {FOLDS})::INT AS fold FROM documents d JOIN labels l USING (doc_id)",
}
