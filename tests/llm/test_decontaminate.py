import itertools
import math

import numpy as np

from tests.conftest import SF
from threadline.llm import decontaminate as dc
from threadline.llm.tokens import WORD


def needed(n):
    return n if n < dc.WHOLE_BELOW else math.ceil(dc.AGREE * n - 1e-9)


def brute_overlaps(docs, items):
    """Every item laid over every place of every document."""
    out = set()
    for i, t in docs:
        d = WORD.findall((t or "").lower())
        for j, u in items:
            e = WORD.findall((u or "").lower())
            if not e:
                continue
            w = min(dc.WINDOW, len(e))
            for start in range(-len(e) + 1, len(d)):
                same = [0 <= start + k < len(d) and d[start + k] == e[k] for k in range(len(e))]
                if any(sum(same[k : k + w]) >= needed(w) for k in range(len(e) - w + 1)):
                    out.add((i, j))
                    break
    return out


def test_masks_cover_all_substitutions_of_all_lengths():
    for n in range(1, dc.WINDOW + 1):
        masks = ["1" * n] if n < dc.WHOLE_BELOW else [*dc.MASKS, *([dc.SHORT_MASK] if n < dc.WINDOW else [])]
        for gone in itertools.combinations(range(n), n - needed(n)):
            assert any(all(p + i not in gone for i, c in enumerate(m) if c == "1") for m in masks for p in range(n - len(m) + 1)), (n, gone)


def test_items_of_one_to_thirty_tokens_against_brute_force(spark):
    rng = np.random.default_rng(3)
    words = [f"k{i}" for i in range(60)]
    items = [(n, " ".join(f"q{n}x{k}" if k % 3 else words[(n + k) % 60] for k in range(n))) for n in range(1, 31)]
    items += [(40, "same same same same same same same same same same same same same same"), (41, None), (42, "")]
    docs, at = [], 1
    for n, text in items[:30]:
        for changes in range(5):
            own = text.split()
            for p in rng.choice(n, min(changes, n), replace=False):
                own[p] = "zz"
            cut = int(rng.integers(0, 4))  # some copies are cut at an end
            docs.append((at, " ".join([*rng.choice(words, 20), *own[cut if changes == 4 else 0 :], *rng.choice(words, 20)])))
            at += 1
    docs += [(at, "same " * 400), (at + 1, None), (at + 2, ""), (at + 3, "q5x1")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute_overlaps(docs, items)
    for block_bytes in (8_000_000, 700):
        got = {(r["id"], r["item_id"]) for r in dc.overlaps(d, b, block_bytes=block_bytes).collect()}
        assert got == want
    assert len(want) > 60


def test_given_tables_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r["text"] or "") < 1500][:60]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {(r["doc_id"], r["item_id"]) for r in dc.op5_spaced_seeds(spark, SF).collect()}
    ids = {i for i, _ in docs}
    assert {x for x in got if x[0] in ids} == brute_overlaps(docs, items)
