"""Embedding near-dedup with randomised-rotation binary codes.

A unit vector, padded to ``BITS`` dimensions and rotated by a fixed random
orthogonal matrix, is kept as the signs of its coordinates.  With x' the sign
vector scaled to unit length, the stored factor f = <x', Px> corrects the
code: for another unit vector q, <x', Pq> / f is an unbiased estimate of
<x, q>, and the error stays within

    ERRORS * sqrt((1 - f^2) / f^2) / sqrt(BITS - 1)

with overwhelming probability.  A pair whose estimate plus this bound is
below the threshold is decided; only the others are recomputed exactly in
double precision.

Pairs to estimate come from the codes themselves.  Two vectors at cosine c
agree in a bit with probability 1 - acos(c) / pi; codes are cut into chunks,
and vectors that agree in a whole chunk meet in a bucket.  The number of
chunks, with as many rotations as that takes, makes the chance that a pair
at the threshold meets nowhere smaller than ``MISS``; the chunk length grows
with the logarithm of the largest label, so buckets stay small up to about
2 ** (MOST_BITS - SPARE_BITS) vectors a label; beyond, they grow in proportion.

Codes and factors are stored once.  Buckets first hold codes only: a pair
whose codes differ in too many bits is decided there, and a pair counts in the
first chunk it shares only.  The vectors themselves travel only to buckets
where they have a pair left; there the estimates decide what is recomputed.

Equal vectors are one class with a weight.  Large buckets are compared in
bounded blocks; link counts are added up in the tasks, and what leaves them is
a count per vector and the links of a spanning forest, not all pairs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import acos, ceil, log, log2, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from quarry.llm.components import by_cell, connected_components, deal_cells, spanning_links
from quarry.llm.textvec import run_ids, run_pairs, whole_runs
from quarry.session import materialize

BITS = 256
ERRORS = 5.0
MISS = 1e-7
SPARE_BITS = 3
MOST_BITS = 32
BLOCK_ROWS = 2048
_SEED = 29


@lru_cache(8)
def rotation(dimensions: int, turn: int) -> np.ndarray:
    """The first ``dimensions`` columns of a random orthogonal matrix."""
    size = max(BITS, dimensions)
    q, r = np.linalg.qr(np.random.default_rng(_SEED + turn).normal(size=(size, size)))
    return np.ascontiguousarray((q * np.sign(np.diag(r)))[:BITS, :dimensions])


def chunking(threshold: float, largest: int) -> tuple[int, int]:
    """Bits of a chunk and number of chunks for ``largest`` vectors of one label.
    With ``SPARE_BITS`` more than the logarithm, unlike vectors rarely meet."""
    bits = int(min(MOST_BITS, max(10, SPARE_BITS + ceil(log2(max(largest, 2))))))
    agree = (1 - acos(threshold) / pi) ** bits
    return bits, ceil(log(MISS) / log(1 - agree))


def _matrix(column: pa.ChunkedArray | pa.Array, dtype) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def signs(unit: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the rotated vectors and their correction factors."""
    turned = unit @ rotation(unit.shape[1], turn).T
    factor = np.abs(turned).sum(axis=1) / sqrt(BITS)
    return turned > 0, np.maximum(factor, 1e-9)


def _chunk_values(code: np.ndarray, bits: int, n_chunks: int) -> np.ndarray:
    """The value of every chunk; ``code`` holds the packed signs of as many
    rotations as needed, one after the other."""
    per_turn = BITS // bits
    flat = np.unpackbits(code, axis=1)
    weights = 1 << np.arange(bits, dtype=np.int64)
    starts = [c // per_turn * BITS + c % per_turn * bits for c in range(n_chunks)]
    return np.stack([flat[:, s : s + bits] @ weights for s in starts], axis=1)


def _usable(vectors: DataFrame, ident: str, vector: str, label: str, dtype) -> DataFrame:
    """Vectors that can be linked, as ``vec, label, raw`` (the components' bytes)."""
    value = F.col(vector)
    good = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(vector, lambda x: x != 0)
    src = vectors.where(F.col(ident).isNotNull() & F.col(label).isNotNull() & value.isNotNull() & good)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.asarray(v.values.to_numpy(), dtype=dtype).tobytes() for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary())], names=["vec", "label", "raw"])

    kind = "array<double>" if dtype == np.float64 else "array<float>"
    rows = src.select(F.col(ident).cast("bigint").alias("vec"), F.col(label).cast("string").alias("label"), value.cast(kind))
    return rows.mapInArrow(pack, "vec bigint, label string, raw binary")


_CODED = "key bigint, vec bigint, label string, raw binary, weight bigint, size int, factor double, code binary"


def _with_codes(classes: DataFrame, bits: int, n_chunks: int, dtype) -> DataFrame:
    """``key, vec, label, raw, weight`` plus the length of the vector, the
    correction factor of the first rotation and the signs of all rotations.
    Keys tell classes apart, also those of rows that share an id."""
    turns = ceil(n_chunks / (BITS // bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(3)
            sizes = np.array([len(r.as_buffer()) for r in raw], dtype=np.int32)
            for size in np.unique(sizes):
                own = batch.take(pa.array(np.flatnonzero(sizes == size)))
                unit = _unit(_matrix(own.column(3), dtype))
                codes, factor = [], None
                for turn in range(turns):
                    code, own_factor = signs(unit, turn)
                    codes.append(np.packbits(code, axis=1))
                    factor = own_factor if factor is None else factor
                packed = pa.array([c.tobytes() for c in np.concatenate(codes, axis=1)], pa.binary())
                lengths = pa.array(np.full(len(own), size, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*own.columns, lengths, pa.array(factor), packed], names=["key", "vec", "label", "raw", "weight", "size", "factor", "code"])

    return classes.select(F.monotonically_increasing_id().alias("key"), "vec", "label", "raw", "weight").mapInArrow(run, _CODED)


_BUCKET = ["label", "size", "chunk", "value"]
_CELL = [*_BUCKET, "cell_a", "cell_b"]


def _buckets(coded: DataFrame, bits: int, n_chunks: int) -> DataFrame:
    """``label, size, chunk, value, key`` for every chunk of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            values = _chunk_values(_matrix(batch.column(3), np.uint8), bits, n_chunks)
            rows = pa.array(np.repeat(np.arange(len(batch)), n_chunks))
            chunks = pa.array(np.tile(np.arange(n_chunks, dtype=np.int32), len(batch)))
            label, size, key = (batch.column(k).take(rows) for k in (0, 1, 2))
            yield pa.RecordBatch.from_arrays([label, size, chunks, pa.array(values.reshape(-1)), key], names=[*_BUCKET, "key"])

    return coded.select("label", "size", "key", "code").mapInArrow(run, "label string, size int, chunk int, value bigint, key bigint")


def _pairs(cols: dict[str, np.ndarray], run_of: np.ndarray, code: np.ndarray, threshold: float, bits: int, n_chunks: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs of each cell that the codes leave open and whose
    first shared chunk is the cell's."""
    values = _chunk_values(code, bits, n_chunks)
    head = code[:, : BITS // 8]
    for i, j in run_pairs(run_of, most=1 << 13):
        ok = (cols["cell_a"][i] == cols["cell_b"][i]) | (cols["block"][i] != cols["block"][j])
        i, j = i[ok], j[ok]
        # cosines at the threshold differ in few bits
        apart = np.bitwise_count(head[i] ^ head[j]).sum(axis=1, dtype=np.int64)
        ok = apart <= _most_bits(threshold)
        i, j = i[ok], j[ok]
        first = (values[i] == values[j]).argmax(axis=1)
        ok = first == cols["chunk"][i]
        if ok.any():
            yield i[ok], j[ok]


def _open(cells: DataFrame, threshold: float, bits: int, n_chunks: int) -> DataFrame:
    """The members of each cell that have an open pair there, told from codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, _CELL):
            cols = {c: table.column(c).to_numpy() for c in ("chunk", "block", "cell_a", "cell_b")}
            wanted = np.zeros(len(table), dtype=bool)
            for i, j in _pairs(cols, run_ids(table, _CELL), _matrix(table.column("code"), np.uint8), threshold, bits, n_chunks):
                wanted[i] = wanted[j] = True
            if wanted.any():
                yield from table.select([*_CELL, "block", "key"]).filter(pa.array(wanted)).to_batches()

    schema = "label string, size int, chunk int, value bigint, cell_a int, cell_b int, block int, key bigint"
    return cells.select(*_CELL, "block", "key", "code").mapInArrow(run, schema)


_FOUND = "key bigint, links bigint, vec bigint, other bigint"


def _compare(cells: DataFrame, threshold: float, bits: int, n_chunks: int, dtype) -> DataFrame:
    """Rows with ``links``: linked vectors counted for class ``key`` in this
    cell; rows with ``other``: links of a spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, _CELL):
            cols = {c: table.column(c).to_numpy() for c in ("key", "vec", "weight", "chunk", "block", "cell_a", "cell_b", "size", "factor")}
            run_of = run_ids(table, _CELL)
            counts: dict[int, int] = {}
            links: list[tuple[int, int]] = []
            edges = np.flatnonzero(np.diff(cols["size"])) + 1
            for lo, hi in zip([0, *edges], [*edges, len(run_of)]):  # one vector length at a time
                part = table.slice(lo, hi - lo)
                unit = _unit(_matrix(part.column("raw"), dtype))
                packed = _matrix(part.column("code"), np.uint8)
                own = {k: v[lo:hi] for k, v in cols.items()}
                factor = own["factor"]
                sign = np.where(np.unpackbits(packed[:, : BITS // 8], axis=1), 1.0, -1.0)
                bound = ERRORS * np.sqrt((1 - np.minimum(factor, 1) ** 2) / factor**2) / sqrt(BITS - 1)
                turned = unit @ rotation(unit.shape[1], 0).T
                parent: dict[int, int] = {}
                for i, j in _pairs(own, run_of[lo:hi], packed, threshold, bits, n_chunks):
                    estimate = np.einsum("ij,ij->i", sign[i], turned[j]) / sqrt(BITS) / factor[i]
                    ok = estimate + bound[i] >= threshold
                    i, j = i[ok], j[ok]
                    cosine = np.einsum("ij,ij->i", unit[i], unit[j])
                    ok = cosine >= threshold
                    i, j = i[ok], j[ok]
                    u, v = own["vec"][i], own["vec"][j]
                    for a, w in zip([*own["key"][i].tolist(), *own["key"][j].tolist()], [*own["weight"][j].tolist(), *own["weight"][i].tolist()]):
                        counts[a] = counts.get(a, 0) + w
                    links += [(int(u[k]), int(v[k])) for k in spanning_links(u.tolist(), v.tolist(), parent)]
            if counts or links:
                none, no_link = [None] * len(counts), [None] * len(links)
                found = [[*counts, *no_link], [*counts.values(), *no_link], [*none, *(a for a, _ in links)], [*none, *(b for _, b in links)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["key", "links", "vec", "other"])

    columns = cells.select(*_CELL, "block", "key", "vec", "weight", "factor", "code", "raw")
    return columns.mapInArrow(run, _FOUND)


def _most_bits(threshold: float) -> int:
    """Differing bits that a pair at the threshold exceeds with probability
    below about 1e-9 (six standard deviations)."""
    p = acos(threshold) / pi
    return int(ceil(BITS * p + 6 * sqrt(BITS * p * (1 - p))))


def embedding_near_duplicates(
    vectors: DataFrame, threshold: float = 0.98, ident: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Vectors of one label are linked when their cosine, in double precision of
    the components as stored (float or double), is at least ``threshold``.  Null, empty or
    zero vectors, vectors with null or non-finite components, and vectors
    with a null label or id are linked with nothing; vectors of different
    length are not compared.  Rows that share an id are vectors of their own
    in the counts and one node in the components.  Other columns are ignored."""
    dtype = np.float64 if isinstance(vectors.schema[vector].dataType.elementType, DoubleType) else np.float32
    usable = materialize(_usable(vectors, ident, vector, label, dtype), "vectors")
    largest = usable.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    bits, n_chunks = chunking(threshold, largest)
    equal = usable.groupBy("label", "raw").agg(F.min("vec").alias("vec"), F.count(F.lit(1)).alias("weight"))
    classes = materialize(_with_codes(equal, bits, n_chunks, dtype), "classes")
    dealt = deal_cells(_buckets(classes, bits, n_chunks), _BUCKET, "key", BLOCK_ROWS)
    left = _open(by_cell(dealt.join(classes.select("key", "code"), "key"), _BUCKET), threshold, bits, n_chunks)
    cells = by_cell(left.join(classes.drop("label", "size"), "key"), _BUCKET)
    found = materialize(_compare(cells, threshold, bits, n_chunks, dtype), "found")
    parts = connected_components(found.where("other IS NOT NULL").select(F.col("vec").alias("u"), F.col("other").alias("v")))
    counted = found.where("links IS NOT NULL").groupBy("key").agg(F.sum("links").alias("links"))
    of_class = classes.join(counted, "key", "left").join(parts.withColumnRenamed("id", "vec"), "vec", "left").select(
        "label", "raw", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "vec").alias("component")
    )
    of_vector = usable.join(of_class, ["label", "raw"]).groupBy(F.col("vec").alias("v_id")).agg(F.max("n_links").alias("n_links"), F.min("component").alias("component"))
    rows = vectors.select(F.col(ident).alias("id")).join(of_vector, F.col("id") == F.col("v_id"), "left")
    component = F.coalesce("component", F.col("id").cast("bigint"))
    return rows.select(
        F.col("id").alias(ident),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``embeddings`` by label."""
    return embedding_near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), u AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98
), reach AS (
  SELECT vec_id AS id, vec_id AS got FROM embeddings
  UNION
  SELECT l.u AS id, r.got FROM links l JOIN reach r ON l.v = r.id
), comp AS (SELECT id, MIN(got) AS component_id FROM reach GROUP BY id),
deg AS (SELECT u AS id, COUNT(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, COALESCE(deg.n, 0) AS n_links, comp.component_id, comp.component_id = e.vec_id AS kept
FROM embeddings e JOIN comp ON comp.id = e.vec_id LEFT JOIN deg ON deg.id = e.vec_id
"""
