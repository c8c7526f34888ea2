"""Near-dedup against brute force, on the tables and on hot groups."""

from __future__ import annotations

import random
import re

import pytest

from quarry.llm import near_dedup as N

SF = "/root/testdata/sf0.01"


def brute(docs, width, percent):
    """Components by comparing all pairs that share a shingle."""
    sets = {}
    for i, t in docs:
        w = re.sub("[A-Z]", lambda m: m.group().lower(), t or "").encode().split()
        grams = [b" ".join(w)] if 0 < len(w) < width else [b" ".join(w[k : k + width]) for k in range(len(w) - width + 1)]
        sets[i] = frozenset(grams)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    r, s = find(ids[a]), find(ids[b])
                    root[max(r, s)] = min(r, s)
    return {i: (len(sets[i]), find(i)) for i in sets}


def _compare(rows, want):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    _compare(N.op7_near_dedup(spark, SF).collect(), brute(docs, 3, 85))


def test_a_template_group_around_the_threshold(spark, monkeypatch):
    # many variants of one text whose similarities lie on both sides of the
    # threshold, in blocks far smaller than the group
    monkeypatch.setattr(N, "BLOCK_ROWS", 40)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(400):
        w = list(base)
        for _ in range(rng.randrange(0, 7)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    docs += [(1000 + i, f"only {rng.random()} text {rng.random()} here") for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    for width, percent in ((3, 85), (5, 80)):
        want = brute(docs, width, percent)
        assert len({c for _, c in want.values()}) > 35
        _compare(N.near_duplicates(df, width, percent).collect(), want)


def test_edge_rows(spark):
    docs = [(1, "A b"), (2, "a B"), (3, "a"), (4, None), (5, ""), (6, " \n"), (7, "a b c"), (8, "a  b\tc"), (9, "é É x"), (10, "é É x"), (11, "y " * 50_000), (12, "Y " * 49_000)]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id bigint, text string, sig int, component int")
    _compare(N.near_duplicates(df, 3, 85).collect(), brute(docs, 3, 85))
    extra = spark.createDataFrame([(1, "same old text"), (1, "same old text"), (1, "quite another text"), (None, "same old text"), (None, None)], "doc_id bigint, text string")
    rows = N.near_duplicates(extra, 3, 85).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in rows) == [(0, 0, True)] * 2 + [(1, 1, True)] * 3
    assert N.near_duplicates(df.limit(0)).count() == 0


def test_sketches_decide_small_sets_and_lose_no_large_pair():
    rng = random.Random(3)
    for size in (5, 100, 256, 3000):
        for _ in range(40):
            shared = rng.randrange(int(0.8 * size), size + 1)
            a = {rng.getrandbits(32) for _ in range(size - shared)}
            b = {rng.getrandbits(32) for _ in range(size - shared)}
            c = {rng.getrandbits(32) for _ in range(shared)}
            x, y = sorted(a | c), sorted(b | c)
            rows = [N.pa.chunked_array([[N.np.array(v[: N.SKETCH], "<u4").tobytes()]]) for v in (x, y)]
            may, sure = N._judge(*(N._sketch_matrix(r) for r in rows), N.np.array([len(x)]), N.np.array([len(y)]), 85)
            truth = 100 * len(set(x) & set(y)) >= 85 * len(set(x) | set(y))
            assert may[0] or not truth
            assert sure[0] == (truth and size <= N.SKETCH) and (size > N.SKETCH or may[0] == truth)


def test_chunks_follow_the_threshold():
    assert N.chunk_count(0.85) < N.chunk_count(0.8) <= N.SIGNATURE // N.SYMBOLS
    assert N.SIGNATURE * 0.15 < N.most_differing(0.85) < N.most_differing(0.8) < N.SIGNATURE


def test_thresholds_the_signature_cannot_serve_are_refused(spark):
    assert N.chunk_count(0.85) == 8 and N.chunk_count(0.8) == 11 and N.chunk_count(1.0) == 1
    for threshold in (0.5, 0.3, 0.0, 1.2):
        with pytest.raises(ValueError):
            N.chunk_count(threshold)
