"""Substring dedup against brute force, and a sketch that never underestimates."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from quarry.llm import substring_dedup as S
from quarry.llm.textvec import words

SF = "/root/testdata/sf0.01"


def brute(docs, width):
    """The contract, word by word; ids may be None (after all others)."""
    order = lambda i: (i is None, i or 0)
    split = [(i, (t or "").encode().split()) for i, t in docs]
    first: dict = {}
    for i, w in sorted(split, key=lambda x: order(x[0])):
        for k in range(len(w) - width + 1):
            first.setdefault(b" ".join(w[k : k + width]), (order(i), k))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[b" ".join(w[k : k + width])] < (order(i), k):
                gone[k : k + width] = [True] * width
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=repr)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {i: (n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in brute(docs, 20)}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in S.op4_substring_dedup(spark, SF).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 0


def test_edge_rows_against_brute_force(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "a b", " ", "X\u0085y"]
    docs = [(i, " \t\n".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))) for i in range(40)]
    passage = " ".join(f"p{i}" for i in range(30))
    docs += [(100 + i, f"{rng.random()} {passage} {rng.random()} {passage}") for i in range(30)]
    docs += [(7, None), (8, ""), (9, "  \n"), (200, "same " * 3000), (201, "same " * 2000), (None, passage), (None, passage), (300, passage + " tail"), (300, passage + " tail")]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id bigint, text string, doc int, firsts int").repartition(7)
    for width in (20, 5):
        assert _rows(S.dedup_substrings(df, width)) == brute(docs, width)
    assert S.dedup_substrings(df.limit(0)).count() == 0


@pytest.mark.parametrize("shared", [7, None])
def test_shared_and_null_ids_with_different_texts(spark, shared):
    """Such rows follow each other by the hash of their text."""
    rng = random.Random(9)
    passages = [" ".join(f"{p}{k}" for k in range(25)) for p in "abcd"]
    texts = [" ".join(rng.sample(passages, rng.randrange(1, 5))) for _ in range(30)] + [None, "", passages[0] + " x" * 500, passages[1], passages[1]]
    docs = [(shared, t) for t in texts] + [(1, passages[2] + " tail"), (9, passages[3]), (9, passages[3] + " more " + passages[0])]
    hashed = lambda t: int.from_bytes(xxhash.xxh64((t or "").encode(), seed=42).digest(), "big", signed=True)
    ids = sorted({((i is None, i or 0), hashed(t)) for i, t in docs})
    ranked = [(ids.index(((i is None, i or 0), hashed(t))), t) for i, t in docs]
    want = sorted(((docs[k][0], *r[1:]) for k, r in enumerate(brute_in_order(ranked, 20))), key=repr)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    assert _rows(S.dedup_substrings(df)) == want and sum(r[2] for r in want) > 0


def brute_in_order(docs, width):
    """``brute`` row by row, in the order given; equal ids are equal texts."""
    every = brute(docs, width)
    by_row = {(i, t): next(r for r in every if r[0] == i) for i, t in docs}
    return [by_row[d] for d in docs]


def test_estimates_are_never_below_counts():
    rng = random.Random(4)
    shared = " ".join(f"s{i}" for i in range(25))
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(300)) + f" {shared} end" for _ in range(20)]
    width, cells = 12, 1 << 16
    sketch = S._PartitionSketch()
    counts: dict = {}
    places = []
    for half in (texts[:9], texts[9:]):
        w = words(pa.array(half))
        values, anchor, valid = S._anchors(w, width)
        wanted = np.where(valid, anchor, np.uint64(0))
        top = S.sliding(wanted[::-1], width - S.SUB + 1, np.maximum)[::-1]
        picked = values[(top == values) & (values != S._NONE)]
        sketch.add(np.concatenate([c + np.uint64(r * cells) for r, c in enumerate(S._cells(picked, cells))]))
        raw = w.raw.tobytes()
        for i in np.flatnonzero(valid):
            key = raw[w.start[i] : w.end[i + width - 1]].split()
            counts[tuple(key)] = counts.get(tuple(key), 0) + 1
            places.append((tuple(key), anchor[i]))
    blocks = [b for part in S._merge(iter(sorted(S._blocks(sketch), key=lambda b: b.column(0)[0].as_py()))) for b in zip(*(c.to_pylist() for c in part.columns))]
    merged = S.RepeatSketch(cells, blocks)
    told = merged.repeated(np.array([a for _, a in places], dtype=np.uint64))
    assert all(t for (key, _), t in zip(places, told) if counts[key] > 1)
    assert any(counts[k] > 1 for k, _ in places)
