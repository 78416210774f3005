import hashlib
import random
from collections import Counter, defaultdict

import pytest

from tests.conftest import SF
from threadline.llm import alignment

PATHS = f"{alignment.TOKENIZERS}/byte_bpe_50k.json", f"{alignment.TOKENIZERS}/piece_bpe_32k.model"
SCHEMA = "doc_id long, text string, n_a string, _row int, pairs string, rare string"
ODD = [None, "", "a", " ", "  a  b ", "<s> </s> <unk> <|endoftext|>", "▁x", "a▁ b", "\x00\x01é日本語 🎉 \t\n\n x", "\n\n\t a", "x" * 5000, " " * 7000 + "a" + " " * 7000, "12 " * 3000, "é" * 3000, "Ċ Ġ <0x41>", "same text here", "same text here"]


def brute(texts):
    """Rows as the contract states them, from the byte ends of whole lists of tokens."""
    one, other = (alignment.encoder(p) for p in PATHS)
    rows, links = [], []
    for t in texts:
        own, ids = [], None
        if t:
            ids = one.slow.encode(" " + t, add_special_tokens=False).ids, other.model.encode(t)
            parts = [[e.bytes[i] for i in x] for e, x in zip((one, other), ids, strict=True)]
            if any(b"".join(p) != (" " + t).encode() for p in parts):
                ids = None
        if ids is None:
            rows.append((0, 0, 0, 0, ""))
            links.append([])
            continue
        ends = []
        for p in parts:
            n, e = 0, []
            for b in p:
                n += len(b)
                e.append(n)
            ends.append(e)
        place = {e: k for k, e in enumerate(ends[1])}
        groups, a, b = [], 0, 0
        for k, e in enumerate(ends[0]):
            if e in place:
                groups.append(",".join(map(str, ids[0][a : k + 1])) + "|" + ",".join(map(str, ids[1][b : place[e] + 1])))
                own.append((ids[0][k], ids[1][place[e]]))
                a, b = k + 1, place[e] + 1
        rows.append((len(ids[0]), len(ids[1]), len(groups), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append(own)
    count = Counter(x for own in links for x in own)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [(*r, sum(count[x] == most[x[1]] for x in own), sum(count[x] for x in own)) for r, own in zip(rows, links, strict=True)]


def aligned(docs, frequent):
    rows = alignment.align(docs, *PATHS)
    counts = alignment.pair_counts(rows, len(alignment.encoder(PATHS[1]).bytes))
    return alignment.link_sums(rows, counts, frequent)


@pytest.mark.parametrize("frequent", [0, 7, 400_000])
def test_against_lists(spark, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "LANE_BYTES", 64)
    rng = random.Random(frequent)
    texts = ODD + ["".join(rng.choices("ab é\n\t .,'x1日▁", [9, 9, 9, 3, 1, 1, 4, 1, 1, 1, 2, 2, 1, 0.02], k=rng.randrange(400))) for _ in range(120)]
    docs = spark.createDataFrame([(None if i == 3 else i // 2, t, "clash", 0, "p", "r") for i, t in enumerate(texts)], SCHEMA)
    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    got = aligned(docs, frequent).select("id", *names).collect()
    want = [(None if i == 3 else i // 2, *r) for i, r in enumerate(brute(texts))]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_no_rows(spark):
    assert aligned(spark.createDataFrame([], SCHEMA), 10).collect() == []


def test_given_documents(spark):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = alignment.op12_token_alignment(spark, SF).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum").collect()
    assert {tuple(r) for r in got} == {(i, *r) for i, r in zip(texts, brute(list(texts.values())), strict=True)}
    assert len(got) == len(texts)


def test_encoders_agree():
    one, other = (alignment.encoder(p) for p in PATHS)
    rng = random.Random(5)
    texts = [t for t in ODD if t] + ["".join(chr(rng.choice([32, 32, 10, 97, 98, 0x301, 0x3000, 0xAD, 0x1F600, rng.randrange(33, 0xD000)])) for _ in range(rng.randrange(900))) for _ in range(200)]
    assert one.fast is not None
    assert [x.tolist() for x in one.encode(texts)] == [one.slow.encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert not other.crossing
    assert [x.tolist() for x in other.encode(texts)] == other.model.encode(texts)
