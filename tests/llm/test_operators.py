import hashlib
import itertools
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from threadline.llm import decontaminate, language, licenses, mixing, near_dedup, nearest, registry, sharding, substring_dedup, templates, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, hash string"
WORDS = [f"w{i}" for i in range(400)]


def prose(seed, n):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeats, clashing columns."""
    base = prose(1, 200)
    rows = [(1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, base.replace("w5 ", "zz "), "en", None), (4, None, None, None), (5, "", "en", "b"), (6, prose(2, 9000), "de", "b"),
            (7, "MIT License", "fr", "b"), (8, "..., !!!", None, "c"), (None, base, "en", "a"), (9, "Released under the MIT licence.\n" + prose(3, 60), "fr", "c")]
    return spark.createDataFrame([(*r, 0, "x", "y") for r in rows], SCHEMA)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_sql(name, same):
    same(registry.queries()[name], registry.oracle_sql()[name])


def operators(docs):
    profiles = language.learn(docs)
    yield "near", near_dedup.near_classes(docs)
    yield "keep", near_dedup.keep_one(docs)
    yield "spans", substring_dedup.repeated_spans(docs)
    yield "shards", sharding.shard_by_curve(docs, 4)
    yield "licenses", licenses.scan(docs)
    yield "lines", templates.drop_recurring_lines(docs)
    yield "language", language.identify(docs, profiles)
    yield "mix", mixing.taken_copies(*mixing.mix(docs))
    yield "overlaps", decontaminate.overlaps(docs, docs.select(F.col("doc_id").alias("item_id"), "text"))
    labelled = docs.where("doc_id is not null").select(F.col("doc_id").alias("i"), F.col("text").alias("t"), (F.col("doc_id") % 2).cast("int").alias("y"))
    yield "toxicity", toxicity.score_toxicity(docs, toxicity.fit(labelled))


def test_odd_rows_and_empty_tables(spark, odd):
    n = odd.count()
    for name, out in operators(odd):
        rows = out.collect()
        if name not in ("near", "keep", "overlaps"):
            assert len(rows) == n, name
    for name, out in operators(odd.limit(0)):
        assert out.collect() == [], name


def test_near_classes(spark, odd):
    got = {r["id"]: r["class_id"] for r in near_dedup.near_classes(odd).collect()}
    assert got[1] == got[2] == got[3] == 1 and got[6] == 6 and 4 not in got


def test_signatures_estimate_weighted_jaccard():
    a, b = "a b c d e f " * 10, "a b c d e f " * 7 + "x y z u v"
    owner, h, count = near_dedup.bags([a, b], 5)
    mark = near_dedup.bag_minhash(owner, h, count, 2, 8000)
    grams = [Counter(tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)) for t in (a, b)]
    assert abs((mark[0] == mark[1]).mean() - sum((grams[0] & grams[1]).values()) / sum((grams[0] | grams[1]).values())) < 0.03


def test_several_templates_of_a_leaf(spark):
    kinds = [(50, "user session opened for {} now"), (60, "user session closed by {} today"), (55, "user session ended with {} here")]
    names = ["".join(chr(97 + int(c)) for c in f"{i:03d}") for i in range(200)]
    lines = [kind.format(names[i]) for n, kind in kinds for i in range(n)]
    odd = ["user session never was like this", "user session mostly has other words"]
    docs = spark.createDataFrame(list(enumerate(lines + odd)), "doc_id long, text string")
    kept = [r["kept_text"] for r in templates.drop_recurring_lines(docs, several=True).orderBy("doc_id").collect()]
    assert kept == [""] * len(lines) + odd
    assert [r["n_dropped"] for r in templates.drop_recurring_lines(docs).collect()] == [0] * len(lines + odd)


def test_several_templates_on_odd_rows(spark, odd):
    assert templates.drop_recurring_lines(odd, several=True).count() == odd.count()
    assert templates.drop_recurring_lines(odd.limit(0), several=True).collect() == []


def test_repeated_spans_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    seen, want = set(), {}
    for i, t in sorted(docs):
        b = t.encode()
        gone, own = bytearray(len(b)), set()
        for p in range(len(b) - 49):
            own.add(b[p : p + 50])
            if b[p : p + 50] in seen:
                gone[p : p + 50] = b"\1" * 50
        seen |= own
        spans = sum(g and not h for g, h in zip(gone, b"\0" + bytes(gone), strict=False))
        want[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substring_dedup.op2_repeated_substrings(spark, SF).collect()}
    assert got == want


def cut_by_brute_force(docs):
    seen, want = {}, {}
    for i, t in docs:
        for p in range(len(t) - 49):
            seen[t[p : p + 50]] = min(i, seen.get(t[p : p + 50], i))
    for i, t in docs:
        gone = bytearray(len(t))
        for p in range(len(t) - 49):
            if seen[t[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        want[i] = bytes(x for x, g in zip(t, gone, strict=True) if not g)
    return want


@pytest.mark.parametrize("hot", [0, 3, 30])
def test_repeated_spans_of_frequent_triggers(spark, hot):
    rng = np.random.default_rng(8)
    letters = np.frombuffer(b"abcdefghijklmnop qrstuvwxyz", np.uint8)
    noise = lambda n: rng.choice(letters, n).tobytes()
    notice, passage = b"ALL RIGHTS OF THIS NOTICE ARE RESERVED", noise(120)
    docs = [(i, noise(30 + i % 50) + notice + (noise(3) if i % 3 else b"the same end") + (passage[i % 40 : 70 + i % 50] if i % 4 else b"") + noise(i % 37)) for i in range(1, 240)]
    df = spark.createDataFrame([(i, t.decode()) for i, t in docs], "doc_id long, text string")
    got = {r["doc_id"]: bytes(r["kept"]) for r in substring_dedup.repeated_spans(df, block_bytes=3000, hot_phrases=hot).collect()}
    assert got == cut_by_brute_force(docs)


@pytest.mark.parametrize("length", [48, 64, 200])
def test_no_range_grows_with_the_documents_at_a_trigger(spark, length):
    rng = np.random.default_rng(9)
    noise = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))
    notice = ("ALL RIGHTS OF THIS NOTICE ARE RESERVED, SAYS A B" + noise(200).upper())[:length]

    def largest(n, hot):
        docs = spark.createDataFrame([(i, noise(60) + notice + noise(60)) for i in range(n)], "doc_id long, text string")
        sizes = substring_dedup.spans_and_sizes(docs, "doc_id", "text", 8000, hot)[1]
        return sizes.groupBy("bucket").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]

    few, many = largest(1500, 100), largest(4500, 100)
    assert largest(1500, 10**9) > 1000 and few < 1000 and many < 2 * few


def test_whole_licenses_however_wrapped(spark):
    import textwrap

    texts = licenses.whole_texts()
    assert {n for n, _ in texts} == {"MIT", "ISC", "Unlicense", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "GPL-3.0"}
    wrapped = [(n, "\n\n".join(textwrap.fill(p, w) for p in t.split("\n\n"))) for w in (40, 61, 72, 79) for n, t in texts if n in ("MIT", "ISC", "Unlicense", "BSD-3-Clause")]
    wrapped += [("MIT", t.replace("sublicense", "sub-\nlicense").replace("COPYRIGHT HOLDERS", "\nCOPYRIGHT HOLDERS").replace("<year> <holder>", "2020 A. Body")) for n, t in texts if n == "MIT"]
    rows = [*texts, *wrapped, (None, texts[0][1][:3000]), (None, "All software has a license.")]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    assert [r["license_id"] for r in licenses.scan(docs).orderBy("doc_id").collect()] == [n for n, _ in rows]


def test_spellings_are_whole_words(spark):
    known = (("X", "Never favour a ver 2 organisation licence, at https://x.y"),)
    docs = spark.createDataFrame([(1, "NEVER favor a version 2 organization license, at http://x.y"), (2, "neversion favour a ver 2 organisation licence at https x y")], "doc_id long, text string")
    assert [r["license_id"] for r in licenses.scan(docs, known=known).orderBy("doc_id").collect()] == ["X", None]


def test_shards_follow_the_curve(spark):
    rows = sorted(sharding.op3_hilbert_shards(spark, SF).collect(), key=lambda r: (r["shard"], r["slot"]))
    curve = [r["curve"] for r in rows]
    table = sharding.curve_table()
    assert curve == sorted(curve) and all(r["curve"] == table[(r["source_cell"] * 16 + r["lang_cell"]) * 16 + r["size_cell"]] for r in rows)


def shards_by_sorting(rows, n, side=16):
    """(shard, slot) of rows (id, text, lang, source) from one sort, and the cells of the commonest values."""
    def cells(values):
        count = Counter(v or "" for v in values)
        top = sorted(count, key=lambda v: (-count[v], v.encode()))[: side // 2]
        return {v: top.index(v) if v in top else side // 2 + zlib.crc32(v.encode()) % (side // 2) for v in count}

    langs, sources, table = cells(r[2] for r in rows), cells(r[3] for r in rows), sharding.curve_table()
    keyed = []
    for k, (i, text, lang, source) in enumerate(rows):
        raw = (text or "").encode()
        size, crc = len(raw) + 16, zlib.crc32(raw)
        curve = table[(sources[source or ""] * side + langs[lang or ""]) * side + min(side - 1, size.bit_length() - 5)]
        keyed.append((curve, zlib.crc32(str(i).encode()) if i is not None else crc, i is not None, i or 0, crc, size, k))
    out = {}
    for rank, (*_, k) in enumerate(sorted(keyed)):
        shard = rank * n // len(rows)
        out[k] = (shard, rank - -(-shard * len(rows) // n))
    return out


def test_shards_against_one_sort(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    want = shards_by_sorting([tuple(r) for r in docs], 40)
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.op3_hilbert_shards(spark, SF).collect()}
    assert got == {r["doc_id"]: want[k] for k, r in enumerate(docs)}
    rows = [tuple(r) for r in odd.select("doc_id", "text", "lang", "source").collect()]
    want = shards_by_sorting(rows, 4)
    mine = sorted((str(r["doc_id"]), str(r["text"]), r["shard"], r["slot"]) for r in sharding.shard_by_curve(odd, 4).collect())
    assert mine == sorted((str(r[0]), str(r[1]), *want[k]) for k, r in enumerate(rows))


def test_mixing_and_language_keep_columns_of_any_name(spark):
    rows = [(i, "some words in a text", "en", "s" if i % 2 else None, 5, "r", "b", "s", "p", "l", "j") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rounds string, below string, _source string, plan_source string, _l string, row string")
    out = mixing.taken_copies(*mixing.mix(docs))
    assert out.count() == 6 and set(docs.columns) <= set(out.columns)
    assert set(docs.columns) <= set(language.identify(docs, language.learn(docs)).columns)


def test_vectors_meet_those_of_their_length(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.standard_normal(2 if i < 60 else 3).tolist()) for i in range(100)] + [(200, [1.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest.search(df, df.where("vec_id % 20 = 0"), k=5).collect()
    vectors = dict(rows)
    assert {r["query_id"] for r in got} == {0, 20, 40, 60, 80}  # the one of four components has no candidate
    for q in (0, 20, 40, 60, 80):
        scored = sorted(((-float(np.dot(vectors[q], v)), i) for i, v in rows if i != q and len(v) == len(vectors[q])))[:5]
        assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == [i for _, i in scored]


def test_toxicity_does_not_follow_the_partitions(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("toxic").alias("y"))
    rows = spark.read.parquet(f"{sf}/documents.parquet").join(labels, "doc_id").select(F.col("doc_id").alias("i"), F.col("text").alias("t"), "y")
    rows = spark.createDataFrame(rows.toPandas(), rows.schema)
    found = []
    for n in (2, 3, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        found.append(toxicity.fit(rows.repartition(n)))
    assert len({m.distance.dictionaries for m in found}) == 1
    texts = [r["t"] for r in rows.limit(50).collect()]
    assert len({tuple(m.scores(texts).round(12)) for m in found}) == 1


def test_toxicity_on_held_out_rows_and_without_labels(spark):
    sf = "/root/testdata/sf0.1"
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [(toxic[r["doc_id"]], r["score"], r["predicted"]) for r in toxicity.op6_compression_toxicity(spark, sf).collect() if r["held_out"] and r["doc_id"] in toxic]
    hits = sum(y == p == 1 for y, _, p in rows)
    assert hits >= 0.75 * sum(y for y, _, _ in rows) and hits >= 0.85 * sum(p for _, _, p in rows)
    none = spark.createDataFrame([], "i long, t string, y int")
    docs = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id long, text string")
    assert [r["predicted"] for r in toxicity.score_toxicity(docs, toxicity.fit(none)).collect()] == [0, 0]


def test_shards(spark):
    rows = sharding.op3_hilbert_shards(spark, SF).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(40)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s])) for s in sizes)
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) and r["size"] == len(text[r["doc_id"]].encode()) + 16 for r in rows)
    table = sharding.curve_table(2)
    cells = sorted(itertools.product(range(4), repeat=3), key=lambda c: table[c[0] * 16 + c[1] * 4 + c[2]])
    assert sorted(table) == list(range(64)) and all(sum(abs(x - y) for x, y in zip(a, b, strict=True)) == 1 for a, b in itertools.pairwise(cells))


def test_masks_cover_two_substitutions():
    masks = [[i for i, c in enumerate(m) if c == "1"] for m in decontaminate.MASKS]
    for gone in itertools.combinations(range(decontaminate.WINDOW), 2):
        assert any(all(p + i not in gone for i in m) for m in masks for p in range(decontaminate.WINDOW - m[-1]))


def test_overlaps_tolerate_substitutions_and_leave_others(spark):
    item = prose(11, 30).split()
    changed = [w if i % 8 else "zz" for i, w in enumerate(item)]
    docs = spark.createDataFrame([(1, prose(12, 50) + " " + " ".join(changed) + " " + prose(13, 50)), (2, prose(14, 300)), (3, " ".join(item[:6]))], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item)), (8, "w1 w2")], "item_id long, text string")
    assert [(r["id"], r["item_id"]) for r in decontaminate.overlaps(docs, items, block_bytes=100).collect()] == [(1, 7)]


def test_language_and_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in language.op8_language_profiles(spark, sf).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in toxicity.op6_compression_toxicity(spark, SF).collect())


def test_nearest_recall_and_odd_vectors(spark):
    vectors = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    x = np.array([v for _, v in vectors])
    odd = [(9001, None), (9002, [0.0] * x.shape[1]), (9003, [float("nan")] * x.shape[1]), (9004, [None] * x.shape[1]), (9005, vectors[0][1])]
    df = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>")
    got = nearest.search(df, df.where("vec_id % 20 = 0")).collect()
    assert not {r["vec_id"] for r in got} & {9001, 9002, 9003, 9004} and [r["vec_id"] for r in got if r["query_id"] == vectors[0][0] and r["rank"] == 1] == [9005]
    found = Counter()
    for q in (i for i, _ in vectors if i % 20 == 0):
        score = x @ x[q]
        score[q] = -9
        found[q] = len(set(np.argsort(-score)[:20]) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert sum(found.values()) >= 0.9 * 20 * len(found)
    assert nearest.search(df.limit(0), df.limit(0)).collect() == []


def test_mix_near_targets(spark):
    rows = mixing.op9_source_mix(spark, "/root/testdata/sf0.01").collect()
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert abs(sum(r["taken"] for r in rows) / sum(r["size"] for r in rows) - 1) < 0.02


def test_pipeline(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and max(Counter(r["shard"] for r in rows).values()) - min(Counter(r["shard"] for r in rows).values()) <= 1


def test_templates_without_a_broadcast_of_leaves(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    want = sorted(map(tuple, templates.drop_recurring_lines(docs).collect()))
    monkeypatch.setattr(templates, "BROADCAST_LEAVES", 0)
    assert sorted(map(tuple, templates.drop_recurring_lines(docs).collect())) == want
