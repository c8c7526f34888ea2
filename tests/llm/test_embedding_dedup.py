"""Embedding near-dedup against all pairs, unbiased estimates, edge rows."""

from __future__ import annotations

import numpy as np

from quarry.llm import embedding_dedup as E

SF = "/root/testdata/sf0.01"


def brute(rows, threshold=0.98):
    """``{id: (links, component)}``; rows (id, vector, label)."""
    usable = [(i, np.array(v, dtype=np.float32).astype(float), label) for i, v, label in rows if label is not None and v is not None and len(v) and None not in v]
    usable = [(i, v / np.linalg.norm(v), label) for i, v, label in usable if np.isfinite(v).all() and np.abs(v).max() > 0]
    root = {i: i for i, _, _ in rows}
    links = dict.fromkeys(root, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(usable)):
        for b in range(a):
            (i, v, x), (j, w, y) = usable[a], usable[b]
            if x == y and len(v) == len(w) and float(v @ w) >= threshold:
                links[i] += 1
                links[j] += 1
                r, s = find(i), find(j)
                root[max(r, s)] = min(r, s)
    return {i: (links[i], find(i)) for i in root}


def _compare(rows, want):
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    _compare(E.op10_embedding_dedup(spark, SF).collect(), brute(rows))


def test_clusters_in_blocks_and_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(6)
    rows = []
    for c in range(6):
        centre = rng.normal(size=64)
        for _ in range(60):
            v = centre + rng.normal(size=64) * rng.choice([0.0, 0.08, 0.15, 0.25])
            rows.append((len(rows), [float(x) for x in v], int(c % 2)))
    rows.append((len(rows), rows[3][1], rows[3][2]))
    rows.append((len(rows), [2 * x for x in rows[3][1]], rows[3][2]))
    for v, label in ((None, 1), ([], 1), ([0.0] * 64, 1), ([1.0, None], 1), ([float("nan")] * 64, 1), ([float("inf")] * 64, 1), (rows[3][1], None), ([1.0, 2.0], 1), ([1.0, 2.0], 1), ([1.0], 0), ([5.0], 0)):
        rows.append((len(rows), v, label))
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, label int, weight int").repartition(5)
    want = brute(rows)
    assert len({c for _, c in want.values()}) > 20 and max(n for n, _ in want.values()) > 20
    _compare(E.embedding_near_duplicates(df).collect(), want)
    assert E.embedding_near_duplicates(df.limit(0)).count() == 0


def test_estimates_are_unbiased_and_within_their_bounds():
    rng = np.random.default_rng(9)
    x, y = (E._unit(rng.normal(size=(4000, 64)).astype(np.float32)) for _ in range(2))
    y = E._unit((x + 0.3 * y).astype(np.float32))
    code, factor = E.signs(x, 0)
    turned = y @ E.rotation(64, 0).T
    estimate = (np.where(code, 1.0, -1.0) * turned).sum(axis=1) / np.sqrt(E.BITS) / factor
    error = estimate - (x * y).sum(axis=1)
    bound = E.ERRORS * np.sqrt((1 - factor**2) / factor**2) / np.sqrt(E.BITS - 1)
    assert abs(error.mean()) < 0.002 and (np.abs(error) <= bound).all()


def test_repeated_ids(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (None, [1.0, 0.0], 1)], "vec_id bigint, embedding array<float>, label int")
    rows = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in E.embedding_near_duplicates(df).collect())
    assert rows == [(0, 0, 0, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]


def test_shared_ids_with_different_vectors_and_double_components(spark):
    """Vectors that share an id count their own links; doubles stay doubles."""
    at = np.arccos(0.98)
    rows = [
        (1, [1.0, 0.0, 0.0], 1),
        (1, [0.0, 0.0, 1.0], 1),
        (2, [1.0, 0.01, 0.0], 1),
        (3, [0.0, 0.01, 1.0], 1),
        (4, [float(np.cos(at - 1e-9)), float(np.sin(at - 1e-9)), 0.0], 2),
        (5, [1.0, 0.0, 0.0], 2),
        (6, [float(np.cos(at + 1e-9)), 0.0, float(np.sin(at + 1e-9))], 2),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in E.embedding_near_duplicates(df).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 4), (5, 1, 4), (6, 0, 6)]


def test_vectors_travel_only_to_buckets_with_an_open_pair(spark):
    rng = np.random.default_rng(12)
    rows = [(i, [float(x) for x in rng.normal(size=48)], 0) for i in range(3000)]
    rows.append((3000, [x * 1.5 + 0.01 for x in rows[7][1]], 0))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    usable = E._usable(df, "vec_id", "embedding", "label", np.float32)
    bits, n_chunks = E.chunking(0.98, len(rows))
    classes = E._with_codes(usable.groupBy("label", "raw").agg(E.F.min("vec").alias("vec"), E.F.count("*").alias("weight")), bits, n_chunks, np.float32).cache()
    dealt = E.deal_cells(E._buckets(classes, bits, n_chunks), E._BUCKET, "key", E.BLOCK_ROWS)
    left = E._open(E.by_cell(dealt.join(classes.select("key", "code"), "key"), E._BUCKET), 0.98, bits, n_chunks)
    assert sorted(r.vec for r in left.join(classes, "key").select("vec").collect()) == [7, 3000]
    classes.unpersist()
