from collections import Counter

import numpy as np

from tests.conftest import SF
from threadline.llm import language


def profile(texts, size):
    """Ranking of n-grams by plain counting."""
    counts = Counter()
    for t in texts:
        letters = "".join(c if c.isalpha() else "_" for c in (t or "").lower())
        letters = "_".join(x for x in letters.split("_") if x)
        if letters:
            padded = f"_{letters}_"
            counts.update(c for c in padded if c != "_")
            counts.update(padded[i : i + 2] for i in range(len(padded) - 1))
            counts.update(padded[i : i + 3] for i in range(len(padded) - 2) if padded[i + 1] != "_")
    order = sorted(counts, key=lambda g: (-counts[g], sum(ord(c) << 21 * k for k, c in enumerate(g))))
    return order[:size]


def test_ranks_and_distances_against_plain_counting(spark):
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs += [(None, "½ ² ①", "en"), (90001, "½ ② a", None), (90002, None, "en"), (90003, "12 34 !", "de")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    own = language.learn(df, sample=10**9)
    langs = sorted({lang for _, _, lang in docs if lang})
    ranks = {lang: profile([t for _, t, x in docs if x == lang], language.PROFILE) for lang in langs}
    assert own.names == langs
    for _, text, _ in docs:
        grams = profile([text], language.PROFILE)
        want = [sum(abs(ranks[lang].index(g) - k) if g in ranks[lang] else language.PROFILE for k, g in enumerate(grams)) for lang in langs] if len(grams) < 150 else None
        away, most = own.distances(text)
        assert most == language.PROFILE * len(grams)
        if want and grams:
            assert away.tolist() == want


def test_texts_without_a_letter(spark):
    rows = [(1, "½ ² ①", "en", "x"), (2, "the one and the other", "en", "x"), (3, None, "en", "x"), (4, "", None, "x"), (None, "the rest of it", "en", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, judged string")
    out = {r["doc_id"]: r["lang_pred"] for r in language.identify(df, language.learn(df)).collect()}
    assert out == {1: "und", 2: "en", 3: "und", 4: "und", None: "en"}


def test_stage_rejects_what_is_far_from_every_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = np.random.default_rng(1)
    junk = [(10**6 + i, " ".join("".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 3000, 5)) for _ in range(40)), None, None, 0) for i in range(5)]
    more = docs.unionByName(spark.createDataFrame([*junk, (10**7, "! 12", None, None, 0), (10**7 + 1, None, None, None, 0)], docs.schema))
    kept = {r["doc_id"] for r in language.language_stage(spark, more, SF).collect()}
    letters = {r["doc_id"] for r in docs.collect() if r["text"] and any(c.isalpha() for c in r["text"])}
    assert kept <= letters and len(letters - kept) <= 0.01 * len(letters)
    assert language.language_stage(spark, docs.limit(0), SF).collect() == []


def test_limit_comes_from_all_documents(spark):
    rows = [(k, "en", n / 7919.0) for k, n in enumerate(range(7919))] + [(9000, "und", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, lang_pred string, distance double")
    want = sorted(n / 7919.0 for n in range(7919))[-(-99 * 7919 // 100) - 1]
    assert language.distance_limit(df) == (1.0 + want) / 2
    assert language.distance_limit(df.limit(0)) == 1.0
