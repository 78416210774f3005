import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from threadline.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, rank string, n int"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def brute(rows, fanout):
    """(doc_id, leaf, subroot, root, proof, folded, verified) by building every level as a list."""

    def tree(nodes):
        """The root, and per node its runs from the bottom up as (place, run)."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
            for k, i in enumerate(at):
                paths[k].append((i % fanout, runs[i // fanout]))
            nodes, at = [digest(*r) for r in runs], [i // fanout for i in at]
        return nodes[0], paths

    leaves = {}
    for doc_id, text, lang, source, n_chars in rows:
        form = lambda t: digest(*map(field, (doc_id, source, lang, n_chars, t)))  # noqa: B023, E731
        low = text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        drawn = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        leaves.setdefault(lang, []).append((doc_id is not None, doc_id or 0, form(text), doc_id, form(low) if drawn else form(text)))
    langs = sorted(leaves, key=lambda x: (x is not None, (x or "").encode()))
    subs = {}
    for lang in langs:
        leaves[lang].sort()
        subs[lang] = tree([x[2] for x in leaves[lang]])
    root, tops = tree([subs[x][0] for x in langs])
    out = []
    for lang, over in zip(langs, tops, strict=True):
        for (_, _, leaf, doc_id, other), path in zip(leaves[lang], subs[lang][1], strict=True):
            folded, siblings = other, []
            for at, run in path + over:
                siblings += run[:at] + run[at + 1 :]
                folded = digest(*run[:at], folded, *run[at + 1 :])
            out.append((doc_id, leaf, subs[lang][0], root, digest(*siblings), folded, folded == root))
    return out


def result(docs):
    lowered = F.translate("text", merkle.UPPER, merkle.LOWER)
    fields = [F.col(c) for c in merkle.FIELDS]
    other = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf_digest([*fields[:-1], lowered]))
    leaves = docs.select("doc_id", "lang", merkle.leaf_digest(fields).alias("hash"), other.alias("other"))
    rows = merkle.manifest(leaves, "lang", "doc_id", ["doc_id", "other"]).withColumn("folded", merkle.fold(F.coalesce("other", "hash"), F.col("path")))
    return rows.select("doc_id", "hash", "subroot", "root", merkle.sha(merkle.proof(F.col("path"))), "folded", F.col("folded") == F.col("root"))


def plain(rows):
    return sorted(map(str, map(tuple, rows)))


@pytest.fixture
def odd():
    """Languages of 1, 8, 9, 64, 65 and 200 rows, null fields, equal ids, equal rows, an empty and a long text."""
    rows = [(i, f"Text {i} of A and B É", f"l{n}", f"s{i % 3}", i) for n in (8, 9, 64, 65, 200) for i in range(n)]
    rows += [(1, "ONE", None, None, None), (7, None, "l9", "x", 3), (7, "", "l9", "x", 3), (7, "", "l9", "x", 3), (None, "No id", "l9", "x", None), (None, None, "", "x", None), (3, "Ab " * 90_000, "é", "x", 1)]
    return rows


@pytest.mark.parametrize(("fanout", "levels"), [(8, 3), (8, 1), (3, 2), (2, 1)])
def test_against_lists(spark, odd, monkeypatch, fanout, levels):
    monkeypatch.setattr(merkle, "FANOUT", fanout)
    monkeypatch.setattr(merkle, "LEVELS", levels)
    docs = spark.createDataFrame([(*r, "clash", "rank", 0) for r in odd], SCHEMA)
    assert plain(result(docs).collect()) == plain(brute(odd, fanout))


def test_no_row_and_one_row(spark):
    docs = spark.createDataFrame([(5, "A", "en", "s", 1, "h", "r", 0)], SCHEMA)
    assert result(docs.limit(0)).collect() == []
    got = result(docs).first()
    assert got[1] == got[2] == got[3] and got[4] == digest("")


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert plain(r[:7] for r in merkle.op13_merkle_manifest(spark, SF).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()) == plain(brute(rows, 8))
