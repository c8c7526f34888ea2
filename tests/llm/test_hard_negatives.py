"""Hard negatives against brute force; packed products against plain ones."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import hard_negatives as H

SF = "/root/testdata/sf0.01"


def brute(rows, is_anchor, n_pos=5, n_neg=3, low=50, high=95, scale=256):
    use = [(i, lab, [math.floor(scale * x) for x in v]) for i, v, lab in rows
           if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, lab, v) in enumerate(use):
        if not is_anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, k, other) for k, (j, other, w) in enumerate(use) if k != a and len(w) == len(v))
        for neg_p, p, _, _ in [s for s in scored if s[3] == lab][:n_pos]:
            hits = [(j, -s) for s, j, _, other in scored if other != lab and low * -neg_p <= 100 * -s <= high * -neg_p]
            out += [(i, p, r, j, -neg_p, s) for r, (j, s) in enumerate(hits[:n_neg], 1)]
    return sorted(out)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _vectors(n, seed=1, dims=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    return [(i, [float(np.float32(x)) for x in centres[i % 6] + 0.6 * rng.normal(size=dims)], int(rng.integers(0, 4))) for i in range(n)]


def test_edge_rows_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(H, "ANCHOR_ROWS", 8)
    monkeypatch.setattr(H, "CANDIDATE_ROWS", 16)
    rows = _vectors(120)
    rows += [(200 + i, rows[0][1], 1) for i in range(12)] + [(200, rows[0][1], 2)] * 3  # copies, ids that repeat
    rows += [(300, None, 1), (310, [], 1), (320, [1.0, None] * 4, 1), (330, [math.nan] * 8, 1), (340, [math.inf] * 8, 1), (350, [1.0] * 8, None), (None, [1.0] * 8, 1)]
    rows += [(400 + i, [0.5, -0.25 + i], i % 2) for i in range(6)] + [(500, [0.0] * 8, 1), (510, [0.0] * 8, 1), (520, [0.0] * 8, 2)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<float>, label int, row int, score int").repartition(6)
    got = H.mine_hard_negatives(df, F.col("vec_id") % 10 == 0)
    assert _rows(got) == brute(rows, lambda i: i % 10 == 0) and got.count() > 50
    got = H.mine_hard_negatives(df, F.col("vec_id") % 10 == 0, n_positives=2, n_negatives=4, low=-20, high=100, scale=16)
    assert _rows(got) == brute(rows, lambda i: i % 10 == 0, 2, 4, -20, 100, 16)
    assert H.mine_hard_negatives(df.limit(0), F.lit(True)).count() == 0
    assert H.mine_hard_negatives(df, F.lit(None).cast("boolean")).count() == 0


@pytest.mark.parametrize(("reach", "dims"), [(1, 1), (3, 4), (200, 64), (1 << 20, 16), (1 << 24, 3)])
def test_packed_products_are_exact(reach, dims):
    rng = random.Random(reach)
    rows = np.array([[rng.randrange(-reach, reach + 1) for _ in range(dims)] for _ in range(41)], dtype=np.int64)
    anchors = rows[:7]
    want = [[sum(int(x) * int(y) for x, y in zip(a, c)) for c in rows] for a in anchors]
    packed = H.Packed(rows, int(anchors.min()), int(anchors.max()))
    assert packed.scores(anchors).tolist() == want
    assert (packed.kind is np.uint64) == (2 * packed.width <= 64) and packed.fields >= 2


def test_scores_beyond_64_bits_are_told():
    rows = np.array([[1 << 40, -(1 << 40)], [3, 4]], dtype=np.int64)
    with pytest.raises(OverflowError):
        H.Packed(rows, -(1 << 40), 1 << 40).scores(rows[:1])


def test_ties_go_to_the_first_position():
    scores = np.array([3, 9, 9, 1, 9, 3])
    assert H._best(scores, 2).tolist() == [1, 2] and H._best(scores, 5).tolist() == [1, 2, 4, 0, 5] and H._best(scores, 9).tolist() == [1, 2, 4, 0, 5, 3]


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    moved = [(i, v, (lab + 1) % 10 if lab is not None and i % 7 == 0 else lab) for i, v, lab in rows]
    got = _rows(H.op13_hard_negatives(spark, SF))
    assert got == brute(moved, lambda i: i % 50 == 0) and got
