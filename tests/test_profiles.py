"""Names that stand in others, senders that may be one, times that run back, and how a report is shown."""

from collections import Counter
from datetime import datetime

from pyspark.sql import functions as F

from threadline.operators import chat, features, profile, reports


def test_names_in_names_meet_only_true_pairs(spark):
    names = [f"customer {i:04d}" for i in range(300)] + ["customer 00", "Customer 0017 ", "tomer", "ab", "", None, "o" * 400, "o" * 399]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    distinct = {n.strip().lower() for n in names if n and len(n.strip()) >= 3}
    want = {(a, b) for a in distinct for b in distinct if a != b and a in b}
    assert {tuple(r) for r in profile.similar_names(df, "n").collect()} == want and ("customer 00", "customer 0042") in want
    assert profile.similar_names(df.limit(0), "n").isEmpty()


def test_alike_senders(spark):
    rows = [("Budi",), ("budi",), (" BUDI",), ("Budi Store",), ("SYSTEM",), ("system desk",), ("",), ("  ",), (None,), ("Budi",)]
    got = {tuple(r) for r in profile.alike_senders(spark.createDataFrame(rows, "sender string")).collect()}
    assert got == {(" BUDI", "Budi", "spelling"), (" BUDI", "budi", "spelling"), (" BUDI", "Budi Store", "contains")}


def test_time_order_report(spark):
    at = lambda h: datetime(2024, 1, 1, h)
    rows = [("a", i, t) for i, t in enumerate([at(9), None, at(8), at(8), at(7), at(6), at(5), at(10)])] + [("b", 0, at(1)), ("b", 1, at(1)), ("c", 0, None)]
    got = {r["f"]: (r["anomalies"], r["samples"]) for r in chat.time_order_report(spark.createDataFrame(rows, "f string, i int, ts timestamp_ntz"), "f", "i").collect()}
    assert got["b"] == got["c"] == (0, "")
    assert got["a"][0] == 4 and got["a"][1].split("; ") == ["2 at 2024-01-01 08:00:00, 60 minutes back", "4 at 2024-01-01 07:00:00, 60 minutes back", "5 at 2024-01-01 06:00:00, 60 minutes back"]


def test_report_view(spark):
    df = spark.createDataFrame([("x", 1234567, 12.25), ("y", 0, None)], "name string, n long, share double")
    assert [tuple(r) for r in reports.report_view(df, ("n",), ("share",)).collect()] == [("x", "1,234,567", "12.2%"), ("y", "0", "-")]


def test_top_grams_against_counting(spark):
    texts = ["a b a b c", "b a b", "", "c", "a  b", None, "x y z x y z"]
    words = F.filter(F.split("t", " "), lambda w: w != "")
    got = {tuple(r) for r in features.top_grams(spark.createDataFrame([(t,) for t in texts], "t string"), words, {1: 3, 2: 2, 3: 1}).collect()}
    want = set()
    for n, k in ((1, 3), (2, 2), (3, 1)):
        counts = Counter(" ".join(w[i : i + n]) for w in (t.split() for t in texts if t) for i in range(len(w) - n + 1))
        want |= {(n, t, c) for t, c in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]}
    assert got == want


def test_terms_of_the_commonest_words_suffice(spark):
    """Where the n-grams of the first words do not settle which are the commonest, those of more words are counted."""
    texts = ["a x b y c z d"] * 5 + ["p q r"] * 4 + ["a a", "b b", "c d", "p q p q", None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    cut = [t.split() for t in texts if t]
    every = {n: Counter(" ".join(w[i : i + n]) for w in cut for i in range(len(w) - n + 1)) for n in (1, 2, 3)}
    best = lambda n, k: sorted(every[n].items(), key=lambda x: (-x[1], x[0]))[:k]
    got = {tuple(r) for r in features.top_grams(docs, F.col("t"), {2: 4, 3: 2}, first=2).collect()}
    assert got == {(n, *x) for n, k in ((2, 4), (3, 2)) for x in best(n, k)}
    rows = Counter(t for n in (1, 2) for w in cut for t in {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)})
    both = sorted(((t, c) for n in (1, 2) for t, c in every[n].items() if rows[t] >= 2), key=lambda x: (-x[1], x[0]))
    for most in (3, 9, 100):
        assert features.vocabulary(docs, F.col("t"), 2, most) == [(t, rows[t]) for t, _ in both[:most]]
