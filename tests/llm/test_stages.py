"""Each stage of the corpus pipeline on nulls, repeats, ties and empty tables, against plain loops."""

from collections import Counter

import numpy as np
import pytest

from threadline.llm import decontaminate, mixing, near_dedup, sharding
from threadline.llm.common import DOCUMENT_COLUMNS
from threadline.llm.tokens import words
from tests.llm.test_decontaminate import brute_overlaps
from tests.llm.test_operators import shards_by_sorting

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, class_id string, copies int, _hit long, shard string"
VOCABULARY = [f"w{i}" for i in range(300)]


def prose(seed, n):
    return " ".join(np.random.default_rng(seed).choice(VOCABULARY, n))


def edited(text, places, by):
    parts = text.split()
    for p in places:
        parts[p] = by
    return " ".join(parts)


@pytest.fixture(scope="module")
def rows():
    base, other = prose(1, 120), prose(2, 200)
    out = [(1, base), (2, base), (2, base), (3, edited(base, [10, 80], "zz")), (4, edited(base, range(0, 120, 9), "yy")), (5, None), (6, ""), (6, None), (7, other), (8, other + " tail of it"), (None, other), (None, None), (9, prose(3, 4000)), (10, "one two"), (11, "one two"), (12, "!!!"), (13, prose(4, 50))]
    return [(i, t, None if k % 5 == 0 else "en", ("a", "b", None)[k % 3], None if t is None else len(t)) for k, (i, t) in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)


def plain(rows):
    return sorted(map(str, map(tuple, rows)))


def groups(rows):
    """Connected groups of rows by weighted Jaccard similarity of five-word shingles of 0.8 or more; rows without words stand alone."""
    bags = []
    for r in rows:
        ws = words(r[1])
        bags.append(Counter(tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))) if ws else None)
    label = list(range(len(rows)))
    for i, a in enumerate(bags):
        for j in range(i):
            b = bags[j]
            if a and b and sum((a & b).values()) >= 0.8 * sum((a | b).values()):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


def test_near_dedup_keeps_one_of_each_group(spark, docs, rows):
    out = near_dedup.near_dedup_stage(spark, docs, "")
    assert set(out.columns) == set(DOCUMENT_COLUMNS)
    kept = [tuple(r) for r in out.select(*DOCUMENT_COLUMNS).collect()]
    # rows of one id are one document, of which the row with a text stays; rows without an id all stay
    texts = {}
    for r in rows:
        if r[0] is not None and (r[0] not in texts or r[1] is not None):
            texts[r[0]] = r[1]
    ids = sorted(texts)
    label = groups([(i, texts[i]) for i in ids])
    least = {min(i for i, g in zip(ids, label, strict=True) if g == own) for own in set(label)}
    assert sorted(r[0] for r in kept if r[0] is not None) == sorted(least) and {1, 4} <= least and not {2, 3, 8, 11} & least
    assert plain(r for r in kept if r[0] is None) == plain(r for r in rows if r[0] is None)
    assert all(r in rows and r[1] == texts[r[0]] for r in kept if r[0] is not None)
    assert near_dedup.near_dedup_stage(spark, docs.limit(0), "").collect() == []


def test_decontamination_against_every_place(spark, docs, rows, tmp_path):
    items = [(1, " ".join(prose(2, 200).split()[40:70])), (2, edited(" ".join(prose(3, 4000).split()[900:930]), [3, 20], "qq")), (3, prose(77, 30)), (4, None), (5, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = decontaminate.decontaminate_stage(spark, docs, str(tmp_path))
    hit = {i for i, _ in brute_overlaps([(r[0], r[1]) for r in rows if r[0] is not None], items)}
    assert hit >= {7, 8, 9}
    assert plain(out.select(*DOCUMENT_COLUMNS).collect()) == plain(r for r in rows if r[0] not in hit)
    assert decontaminate.decontaminate_stage(spark, docs.limit(0), str(tmp_path)).collect() == []
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert decontaminate.decontaminate_stage(spark, docs, f"{tmp_path}/none").count() == len(rows)


def test_mix_takes_near_the_target(spark, docs, rows):
    out = mixing.mix_stage(spark, docs, "").select(*DOCUMENT_COLUMNS).collect()
    size = lambda t: len((t or "").split())
    taken, have = Counter(), Counter(tuple(r) for r in rows)
    for r in out:
        taken[r["source"]] += size(r["text"])
    for r, n in Counter(map(tuple, out)).items():
        assert n <= 3 * have[r]
    sized, plan = mixing.mix(docs)
    target = {r["source"]: r["target"] for r in mixing.taken_copies(sized, plan).select("source", "target").distinct().collect()}
    largest = {s: max(size(r[1]) for r in rows if r[3] == s) for s in target}
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    assert plain(out) == plain(mixing.mix_stage(spark, docs.repartition(5), "").select(*DOCUMENT_COLUMNS).collect())
    assert mixing.mix_stage(spark, docs.limit(0), "").collect() == []


def test_shards_of_a_stage(spark, docs, rows):
    got = sharding.shard_stage(spark, docs, "").select("doc_id", "text", "lang", "source", "n_chars", "shard", "slot").collect()
    want = shards_by_sorting([r[:4] for r in rows], 40)
    assert plain(got) == plain((*r, *want[k]) for k, r in enumerate(rows))
    assert sharding.shard_stage(spark, docs.limit(0), "").collect() == []
