"""Hard-negative mining with exact integer scores from Kronecker-packed products.

Components are integers, ``floor(scale * x)``.  Several candidates' components
of one dimension are biased to be non-negative and set into separate fields of
one wide integer; one multiplication by an anchor's (biased) component then
multiplies them all, and the sum over the dimensions holds every candidate's
inner product in its own field.  A field is as wide as the largest possible
sum, so nothing carries over; taking the biases off gives the exact score.
Words of 64 bits serve while they hold two fields, Python's integers beyond.

Anchors and candidates are dealt into blocks by row number; a task scores the
cells (block of anchors, block of candidates) that fall to it, in slices of
bounded size, and hands on each anchor's best few only.  First the cells of
one label find an anchor's positives; their scores give the bands in which the
cells over all labels then look for negatives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.textvec import run_ids, whole_runs
from quarry.session import materialize

ANCHOR_ROWS = 2048
CANDIDATE_ROWS = 4096
_SLICE = 64  # anchors scored at once
_WIDE_FIELDS = 32
_LARGEST_SCORE = ((1 << 63) - 1) // 128


class Packed:
    """Candidates, a matrix of integers, packed for products with anchors
    whose components lie between ``low`` and ``high``."""

    def __init__(self, candidates: np.ndarray, low: int, high: int):
        n, d = candidates.shape
        self.bias = int(candidates.min())
        self.low = low
        self.n, self.d = n, d
        top = int(candidates.max()) - self.bias
        self.width = max(1, (d * top * (high - low)).bit_length())
        small = 2 * self.width <= 64
        self.fields = 64 // self.width if small else _WIDE_FIELDS
        self.kind = np.uint64 if small else object
        groups = -(-n // self.fields)
        shifted = np.zeros((groups * self.fields, d), dtype=self.kind)
        shifted[:n] = _minus(candidates, self.bias, self.kind)
        shifted = shifted.reshape(groups, self.fields, d)
        words = np.zeros((groups, d), dtype=self.kind)
        for k in range(self.fields):
            words = words | (shifted[:, k, :] << self._number(k * self.width))
        self.words = np.ascontiguousarray(words.T)  # a row of words per dimension
        self.sums = _total(candidates)

    def _number(self, x: int):
        return self.kind(x) if self.kind is np.uint64 else x

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products, anchors x candidates, as int64."""
        shifted = _minus(anchors, self.low, self.kind)
        total = np.zeros((len(anchors), self.words.shape[1]), dtype=self.kind)
        product = np.empty_like(total)
        for j in range(self.d):
            np.multiply(shifted[:, j, None], self.words[j], out=product)
            total += product
        mask = self._number((1 << self.width) - 1)
        fields = [(total >> self._number(k * self.width)) & mask for k in range(self.fields)]
        raw = np.stack(fields, axis=2).reshape(len(anchors), -1)[:, : self.n]
        sums = _total(anchors)
        if self.kind is np.uint64 and max(abs(self.bias), abs(self.low)) < 1 << 31:
            raw = raw.astype(np.int64)
            own = self.bias * sums.astype(np.int64)
            return raw + own[:, None] + self.low * self.sums.astype(np.int64) - self.d * self.low * self.bias
        exact = raw.astype(object) + (self.bias * sums)[:, None] + (self.low * self.sums)[None, :] - self.d * self.low * self.bias
        if exact.size and max(abs(exact.max()), abs(exact.min())) > _LARGEST_SCORE:
            raise OverflowError("an inner product is too large for a 64-bit score")
        return exact.astype(np.int64)


def _minus(values: np.ndarray, bias: int, kind: type) -> np.ndarray:
    return (values.astype(object) - bias) if kind is object else (values - bias).astype(np.uint64)


def _total(values: np.ndarray) -> np.ndarray:
    return values.astype(object).sum(axis=1) if np.abs(values.astype(np.float64)).max(initial=0) > 1 << 31 else values.sum(axis=1).astype(object)


def _best(scores: np.ndarray, most: int) -> np.ndarray:
    """Positions of the ``most`` largest scores, largest first, ties by position."""
    if len(scores) > most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.argsort(-scores[at], kind="stable")][:most]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), -1)


def _cells(anchors: DataFrame, candidates: DataFrame, keys: list[str], blocks: tuple[int, int]) -> DataFrame:
    """Both sides in every cell they take part in, one cell after the other."""
    n_anchor, n_candidate = blocks

    def dealt(rows: DataFrame, own: str, n_own: int, other: str, n_other: int, is_anchor: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("row"), F.lit(n_own)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        return rows.select("*", block.alias(own), copies.alias(other), F.lit(is_anchor).alias("anchor"))

    a = dealt(anchors, "block_a", n_anchor, "block_c", n_candidate, True)
    c = dealt(candidates, "block_c", n_candidate, "block_a", n_anchor, False)
    cell = [*keys, "block_a", "block_c"]
    both = a.unionByName(c, allowMissingColumns=True)
    return both.repartition(*cell).sortWithinPartitions(*cell, "anchor", "vec", "row")


def _each_cell(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, pa.Table]]:
    """(anchors, candidates) of every cell that has both; candidates ascend by
    id and row number."""
    for table in whole_runs(batches, keys):
        run = run_ids(table, keys)
        edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(run)]
        is_anchor = table.column("anchor").to_numpy()
        for lo, hi in zip(edges, edges[1:]):
            first = lo + int(np.count_nonzero(~is_anchor[lo:hi]))
            if lo < first < hi:
                yield table.slice(first, hi - first), table.slice(lo, first - lo)


def _scored(anchors: pa.Table, candidates: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(position of an anchor, its scores with all candidates)."""
    a, c = _matrix(anchors.column("parts")), _matrix(candidates.column("parts"))
    packed = Packed(c, int(a.min()), int(a.max()))
    for at in range(0, len(a), _SLICE):
        for i, scores in enumerate(packed.scores(a[at : at + _SLICE])):
            yield at + i, scores


_FOUND = "anchor_row bigint, anchor_id bigint, place int, positive_id bigint, positive_score bigint, row bigint, vec bigint, score bigint"


def _found(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in _FOUND.split(", ")]
    kinds = [pa.int32() if n == "place" else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _positives(cells: DataFrame, most: int) -> DataFrame:
    """Of every cell of one label the best rows of each anchor, itself left out."""
    keys = ["label", "dims", "block_a", "block_c"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, candidates in _each_cell(batches, keys):
            rows, vecs = candidates.column("row").to_numpy(), candidates.column("vec").to_numpy()
            own, ids = anchors.column("row").to_pylist(), anchors.column("vec").to_pylist()
            out = []
            for i, scores in _scored(anchors, candidates):
                others = np.flatnonzero(rows != own[i])
                for k in others[_best(scores[others], most)]:
                    out.append((own[i], ids[i], None, None, None, int(rows[k]), int(vecs[k]), int(scores[k])))
            if out:
                yield _found(out)

    return cells.select(*keys, "anchor", "row", "vec", "parts").mapInArrow(run, _FOUND)


def _negatives(cells: DataFrame, most: int, low: int, high: int) -> DataFrame:
    """Of every cell the best rows of another label in each positive's band."""
    keys = ["dims", "block_a", "block_c"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, candidates in _each_cell(batches, keys):
            rows, vecs = candidates.column("row").to_numpy(), candidates.column("vec").to_numpy()
            own, ids, bands = (anchors.column(c).to_pylist() for c in ("row", "vec", "bands"))
            names = candidates.column("label").combine_chunks().dictionary_encode()
            code = names.indices.to_numpy()
            codes = {name: k for k, name in enumerate(names.dictionary.to_pylist())}
            labels = anchors.column("label").to_pylist()
            out = []
            for i, scores in _scored(anchors, candidates):
                others = np.flatnonzero(code != codes.get(labels[i], -1))
                scores = scores[others]
                for band in bands[i]:
                    least, top = -(-low * band["score"] // 100), high * band["score"] // 100
                    inside = np.flatnonzero((scores >= least) & (scores <= top))
                    for k in others[inside[_best(scores[inside], most)]]:
                        hit = (band["place"], band["vec"], band["score"], int(rows[k]), int(vecs[k]))
                        out.append((own[i], ids[i], *hit, int(scores[np.searchsorted(others, k)])))
            if out:
                yield _found(out)

    return cells.select(*keys, "anchor", "row", "vec", "parts", "label", "bands").mapInArrow(run, _FOUND)


def _first(found: DataFrame, group: list[str], most: int) -> DataFrame:
    """The best rows of a group, with their ``rank``."""
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), "vec", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine_hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    ident: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for each row that ``anchor`` holds for, and each of its
    ``n_positives`` best other rows of the same label, the ``n_negatives`` best
    rows of other labels whose score lies between ``low`` and ``high`` percent
    of the positive's.  Scores are inner products of ``floor(scale * x)`` in
    double precision; higher ones come first, ties by the smaller id.

    Rows with a null id, label or vector, an empty vector, or a null or
    non-finite component take no part; vectors of different length are not
    compared.  Rows that share an id are rows of their own, so repeated rows
    can be each other's positives and every repeated anchor has results of
    its own.  A score above 2**56 raises.  An empty table has no results;
    other columns are ignored."""
    value = F.col(vector)
    broken = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = vectors.where(F.col(ident).isNotNull() & F.col(label).isNotNull() & (F.size(value) > 0) & ~broken).select(
        F.col(ident).cast("bigint").alias("vec"),
        F.col(label).cast("string").alias("label"),
        F.size(value).alias("dims"),
        F.transform(value, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))).alias("parts"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = materialize(usable, "integer-vectors")
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    blocks = max(1, -(-n_anchors // ANCHOR_ROWS)), max(1, -(-n // CANDIDATE_ROWS))
    columns = ["label", "dims", "row", "vec", "parts"]
    anchors, candidates = rows.where("is_anchor").select(*columns), rows.select(*columns)

    near = _positives(_cells(anchors, candidates, ["label", "dims"], blocks), n_positives)
    best = materialize(_first(near, ["anchor_row"], n_positives), "positives")
    bands = best.groupBy(F.col("anchor_row").alias("row")).agg(F.collect_list(F.struct(F.col("rank").alias("place"), "vec", "score")).alias("bands"))
    hard = _negatives(_cells(anchors.join(bands, "row"), candidates, ["dims"], blocks), n_negatives, low, high)
    return _first(hard, ["anchor_row", "place"], n_negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth row of ``embeddings``; every seventh
    row takes the next label first."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), n AS (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  WHERE 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
