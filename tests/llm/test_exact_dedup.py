"""Exact dedup against brute force; tries that spill; hash collisions."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quarry.llm import exact_dedup as X

SF = "/root/testdata/sf0.01"


def brute(docs, largest=True):
    groups: dict = {}
    for i, t in docs:
        groups.setdefault(t if isinstance(t, bytes) else (t or "").encode(), []).append(i)
    out = []
    for text, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = (max if largest else min)(named) if named else None
        left = 1
        for i in ids:
            kept = i == keep and left > 0
            left -= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text).hexdigest()))
    return sorted(out, key=repr)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _docs():
    rng = random.Random(5)
    docs = [(i, "".join(rng.choice("ab") for _ in range(rng.randrange(0, 7)))) for i in range(300)]
    docs += [(1000 + i, "hot copy") for i in range(150)] + [(2000, None), (2001, ""), (None, "only null id"), (None, "only null id"), (None, "a"), (5, "x"), (5, "x")]
    docs += [(3000, "long é " * 50_000), (3001, "long é " * 50_000), (3002, "long é " * 49_999 + "long e "), (3003, "long é " * 49_999 + "lang é "), (-4, "x ")]
    return docs


def test_edge_rows_against_brute_force(spark):
    docs = _docs()
    df = spark.createDataFrame([(i, t, 1, "y") for i, t in docs], "doc_id bigint, text string, row int, cls string").repartition(9)
    assert _rows(X.exact_duplicates(df)) == brute(docs)
    assert _rows(X.exact_duplicates(df, keep="smallest")) == brute(docs, largest=False)
    assert X.exact_duplicates(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        X.exact_duplicates(df, keep="first")


@pytest.mark.parametrize("trie_bytes", [1, 40, 4000])
def test_one_key_for_all_texts_spills_by_subtree(spark, trie_bytes):
    """Every text has one hash and most have one length, so only the tries tell them apart."""
    rng = random.Random(7)
    docs = [(i, f"{rng.randrange(60):06b}"[:6].rjust(6, "0") + "tail" * 3) for i in range(400)] + _docs()[:50]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    assert _rows(X.exact_duplicates(df, content_hash=lambda _: F.lit(0), trie_bytes=trie_bytes)) == brute(docs)


def test_string_ids_and_binary_texts(spark):
    docs = [("a", b"\xff\x00"), ("b", b"\xff\x00"), ("c", b"\xff"), (None, b"\xff")]
    df = spark.createDataFrame(docs, "doc_id string, text binary")
    assert _rows(X.exact_duplicates(df)) == brute(docs)


def test_trie_owns_prefixes_and_forks():
    trie = X.Trie(1 << 20)
    keys = [b"", b"a", b"abc", b"abd", b"ab", b"abc", b"b" * 1000, b"b" * 999 + b"c"]
    for k in keys:
        trie.insert(k).held.append(k)
    found = {text: node.held for text, node in trie.texts()}
    assert found == {k: [k] * keys.count(k) for k in keys}
    assert trie.terminals == len(set(keys)) and trie.size == 1 + 1 + 1 + 1 + 999 + 1 + 1


def test_spilled_branches_keep_what_they_hold():
    trie = X.Trie(0)
    for k in (b"aaxx", b"aayy", b"aayz", b"abzz"):
        trie.insert(k).held.append(k)
    prefix, gone = trie.spill()
    assert prefix == b"aa" and sorted(gone) == [(k, [k]) for k in (b"aaxx", b"aayy", b"aayz")]
    assert trie.insert(b"aaqq").spilled == b"aa" and [t for t, _ in trie.texts()] == [b"abzz"]
    assert not trie.full()


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = _rows(X.op12_exact_dedup(spark, SF))
    assert got == brute(docs) and any(not r[3] for r in got)
