from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF
from threadline.llm import near_dedup
from threadline.llm.tokens import words

SCHEMA = "doc_id long, text string"


def bag(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else Counter()


def brute_classes(docs, limit=0.8):
    """Components of all pairs of documents whose bags reach the limit, by counting shared shingles of all pairs."""
    bags = {i: bag(t) for i, t in docs if t and words(t)}
    holders = defaultdict(list)
    for i, b in bags.items():
        for s, n in b.items():
            holders[s].append((i, n))
    common = Counter()
    for own in holders.values():
        for k, (i, n) in enumerate(own):
            for j, m in own[k + 1 :]:
                common[i, j] += min(n, m)
    label = {i: i for i in bags}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for (i, j), c in common.items():
        if c >= limit * (sum(bags[i].values()) + sum(bags[j].values()) - c) - 1e-9:
            a, b = sorted((root(i), root(j)))
            label[b] = a
    return {i: root(i) for i in bags}


def edited(rng, base, n, vocabulary):
    out = base.copy()
    for p in rng.choice(len(base), n, replace=False):
        out[p] = vocabulary[int(rng.integers(len(vocabulary)))]
    return out


def made():
    """Families of loose and close variants, one of them large, chains of edits, exact copies, and prose of its own."""
    rng = np.random.default_rng(4)
    vocabulary = np.array([f"v{i}" for i in range(3000)])
    docs, at = [], 1
    for family in range(12):
        base = rng.choice(vocabulary, 40 + 20 * family)
        for k in range(250 if family == 5 else 10):
            docs.append((at, " ".join(edited(rng, base, int(rng.integers(0, 7)), vocabulary))))
            at += 1
    chain = rng.choice(vocabulary, 120)
    for _ in range(30):
        chain = edited(rng, chain, 2, vocabulary)
        docs.append((at, " ".join(chain)))
        at += 1
    for _ in range(60):
        docs.append((at, " ".join(rng.choice(vocabulary, int(rng.integers(1, 90))))))
        at += 1
    return [*docs, (at, docs[0][1]), (at + 1, docs[0][1]), (at + 2, docs[300][1]), (at + 3, None), (at + 4, " .. ")]


def test_classes_against_all_pairs(spark):
    docs = made()
    got = {r["id"]: r["class_id"] for r in near_dedup.near_classes(spark.createDataFrame(docs, SCHEMA)).collect()}
    want = brute_classes(docs)
    assert {i: c for i, c in got.items() if i in want} == want
    assert max(Counter(want.values()).values()) > 100 and len(set(want.values())) > 60


def test_classes_of_the_given_table_against_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_classes(docs)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.op1_near_dedup(spark, SF).collect()}
    assert {i: got[i] for i in want} == want


def test_a_family_of_five_thousand_copies(spark):
    rng = np.random.default_rng(6)
    vocabulary = np.array([f"v{i}" for i in range(5000)])
    base = rng.choice(vocabulary, 60)
    docs = [(i, " ".join(edited(rng, base, 1 if i % 2 else 2, vocabulary))) for i in range(1, 5000)] + [(5000, " ".join(base))]
    got = Counter(r["class_id"] for r in near_dedup.near_classes(spark.createDataFrame(docs, SCHEMA)).collect())
    # one substitution leaves 51 of 61 shingles, so all odd ids are near the base and one class
    assert got.most_common(1)[0][1] >= 2500


def test_prefix_filter_against_all_pairs(spark):
    docs = [(i, t) for i, t in made() if t and words(t)]
    bags = {i: bag(t) for i, t in docs}
    open_ = spark.createDataFrame([(i, sum(b.values()), i) for i, b in bags.items()], "id long, words long, part long")
    texts = spark.createDataFrame(docs, "id long, t string")
    found = {tuple(sorted((r["id"], r["id_2"]))) for r in near_dedup.prefix_candidates(open_, texts, 0.8).collect()}
    for i, a in bags.items():
        for j, b in bags.items():
            if i < j:
                c = sum((a & b).values())
                if c >= 0.8 * (sum(a.values()) + sum(b.values()) - c):
                    assert (i, j) in found


def test_ids_that_stand_twice(spark):
    base = " ".join(f"w{i}" for i in range(60))
    docs = [(1, base), (1, None), (2, base + " end"), (2, None), (3, "quite another text of seven words here"), (3, base + " more"), (None, base), (4, None), (4, None)]
    df = spark.createDataFrame([(*d, k, "x") for k, d in enumerate(docs)], SCHEMA + ", n int, _id string")
    classes = {r["id"]: r["class_id"] for r in near_dedup.near_classes(df).collect()}
    assert classes[1] == classes[2] == 1
    kept = near_dedup.keep_one(df)
    rows = kept.collect()
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in rows]
    assert ids.count(None) == 1 and ids.count(1) == 1 and 2 not in ids and ids.count(4) == 1
    assert [r["text"] for r in rows if r["doc_id"] == 1] == [base]
    assert near_dedup.keep_one(df.where(F.lit(False))).collect() == []


def test_rows_are_dealt_once_to_keep_one(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, None), (None, "x"), (None, "x"), (3, "a b c d e f"), (3, None)], "doc_id long, text string").withColumn("lang", F.lit("en"))
    kept = near_dedup.keep_one(docs)
    assert kept._jdf.queryExecution().executedPlan().toString().count(" AS row#") == 1
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(map(str, spark.createDataFrame([(1, "a b c d e f"), (2, None), (None, "x"), (None, "x")], "doc_id long, text string").collect()))
