"""Quality classifier: random Fourier features, ridge, isotonic calibration.

1. Statistics of every whole text are computed once, in Arrow batches.
2. Standardised statistics are mapped to random Fourier features, whose inner
   products approximate a Gaussian kernel.
3. Each partition sums its rows' normal equations by fold; the sums are added
   row by row of the matrix in a second shuffle, so what reaches the driver is
   one matrix per fold whatever the number of partitions.
4. Ridge weights are solved from all folds, and once without each fold; the
   scores of the left-out folds, counted in fixed bins, are fitted by pool
   adjacent violators, which turns a ridge score into a probability."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.langid import remainder
from quarry.llm.textvec import chunks, text_buffer, word_hashes, words
from quarry.session import materialize

FEATURES = 192
SEED = 3
RIDGE = 1e-3
FOLDS = 4
BINS = 2000
LOW, HIGH = -0.5, 1.5  # range of the binned ridge scores; beyond it the ends hold

STATISTICS = (
    "log_bytes", "log_words", "word_length", "word_length_sd", "lower", "upper", "digit", "space", "newline",
    "exclamation", "signs", "bars", "sentence_marks", "other_marks", "high_bytes", "distinct_words", "top_word",
    "same_as_previous", "capital_words", "marked_words", "byte_entropy", "long_words",
)


def _classes() -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)  # 0: high bytes
    table[:128] = 9  # other marks
    table[97:123] = 1
    table[65:91] = 2
    table[48:58] = 3
    table[[32, 9, 11, 12, 13]] = 4
    table[10] = 5
    table[ord("!")] = 6
    for c in "%#$&*@^~":
        table[ord(c)] = 7
    table[ord("|")] = 8
    for c in ".,;:?'\"-()":
        table[ord(c)] = 10
    return table


_CLASS = _classes()


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text; all zero for an empty or null one."""
    raw, offsets = text_buffer(column)
    n = len(offsets) - 1
    out = np.zeros((n, len(STATISTICS)))
    size = np.diff(offsets)
    share = 1.0 / np.maximum(size, 1)
    kinds = _CLASS[raw]
    by_kind = np.zeros((n, 11))
    for k in range(11):
        sums = np.concatenate([[0], np.cumsum(kinds == k, dtype=np.int64)])
        by_kind[:, k] = (sums[offsets[1:]] - sums[offsets[:-1]]) * share
    w = words(column)
    count = np.diff(w.rows)
    per_word = 1.0 / np.maximum(count, 1)
    length = (w.end - w.start).astype(np.float64)

    def mean(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        return (sums[w.rows[1:]] - sums[w.rows[:-1]]) * per_word

    hashes = word_hashes(w)
    same = np.zeros(len(hashes))
    same[1:] = hashes[1:] == hashes[:-1]
    first_of_row = w.rows[:-1][count > 0]
    same[first_of_row] = 0
    m1 = mean(length)
    out[:, 0] = np.log1p(size)
    out[:, 1] = np.log1p(count)
    out[:, 2] = np.minimum(m1, 40)
    out[:, 3] = np.minimum(np.sqrt(np.maximum(mean(length * length) - m1 * m1, 0)), 40)
    out[:, 4:9] = by_kind[:, 1:6]
    out[:, 9], out[:, 10], out[:, 11] = by_kind[:, 6], by_kind[:, 7], by_kind[:, 8]
    out[:, 12], out[:, 13], out[:, 14] = by_kind[:, 10], by_kind[:, 9], by_kind[:, 0]
    out[:, 17] = mean(same)
    if len(length):
        first, last = _CLASS[w.raw[w.start]], _CLASS[w.raw[w.end - 1]]
        out[:, 18] = mean(first == 2)
        out[:, 19] = mean((last == 6) | (last == 7))
        out[:, 21] = mean(length > 15)
    for r in np.flatnonzero(count):
        _, times = np.unique(hashes[w.rows[r] : w.rows[r + 1]], return_counts=True)
        out[r, 15] = len(times) / count[r]
        out[r, 16] = times.max() / count[r]
        p = np.bincount(raw[offsets[r] : offsets[r + 1]], minlength=256) * share[r]
        p = p[p > 0]
        out[r, 20] = -float(p @ np.log(p))
    return out


def document_statistics(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``ident, stats array<double>`` for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                values = statistics(part.column("text"))
                flat = pa.array(values.reshape(-1))
                starts = pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1])
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(starts, flat)], names=["id", "stats"])

    src = docs.select(F.col(ident).alias("id"), F.col(text).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, stats array<double>").withColumnRenamed("id", ident)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


class Fourier:
    """Random features of standardised statistics: cosines of random
    projections, and a constant."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int = FEATURES, width: float = 1.0):
        rng = np.random.default_rng(SEED)
        d = len(mean)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(size=(d, features)) / (width * np.sqrt(d))
        self.b = rng.uniform(0, 2 * np.pi, size=features)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.cos(x @ self.w + self.b) * np.sqrt(2.0 / len(self.b))
        return np.hstack([z, np.ones((len(z), 1))])


def _sum_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for fold, row, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            values = np.frombuffer(raw)
            sums[fold, row] = sums[fold, row] + values if (fold, row) in sums else values
    if sums:
        keys = list(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            names=["fold", "row", "sums"],
        )


def normal_equations(train: DataFrame, fourier: Fourier) -> dict[int, np.ndarray]:
    """By fold, the summed matrix ``[Z y]' [Z y]`` of ``train (stats, y, fold)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            z = fourier(_matrix(batch.column(0)))
            rows = np.hstack([z, batch.column(1).to_numpy()[:, None]])
            folds = batch.column(2).to_numpy()
            for fold in np.unique(folds):
                own = rows[folds == fold]
                sums[int(fold)] = sums.get(int(fold), 0) + own.T @ own
        for fold, m in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([fold] * len(m), pa.int32()), pa.array(range(len(m)), pa.int32()), pa.array([r.tobytes() for r in m], pa.binary())],
                names=["fold", "row", "sums"],
            )

    kind = "fold int, row int, sums binary"
    parts = train.select("stats", F.col("y").cast("double"), F.col("fold").cast("int")).mapInArrow(run, kind)
    total = parts.repartition("fold", "row").mapInArrow(_sum_vectors, kind).collect()
    out: dict[int, np.ndarray] = {}
    for r in total:
        out.setdefault(r["fold"], np.zeros((fourier.w.shape[1] + 2,) * 2))[r["row"]] = np.frombuffer(r["sums"])
    return out


def _ridge(m: np.ndarray) -> np.ndarray:
    """Weights from a summed ``[Z y]' [Z y]``; the last one is the constant."""
    a, b, n = m[:-1, :-1], m[:-1, -1], m[-2, -2]
    penalty = np.full(len(b), RIDGE * max(n, 1.0))
    penalty[-1] = 0
    return np.linalg.lstsq(a + np.diag(penalty), b, rcond=None)[0]


def isotonic(total: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Pool adjacent violators over ordered bins with at least one row each."""
    pools: list[list[float]] = []
    for n, p in zip(total, positive):
        pools.append([n, p, 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            n2, p2, k2 = pools.pop()
            pools[-1] = [pools[-1][0] + n2, pools[-1][1] + p2, pools[-1][2] + k2]
    return np.concatenate([np.full(k, p / n) for n, p, k in pools])


class QualityModel:
    """A fitted classifier; ``score`` gives probabilities of label 1."""

    def __init__(self, fourier: Fourier | None, weights: np.ndarray, knots: np.ndarray, values: np.ndarray):
        self.fourier, self.weights, self.knots, self.values = fourier, weights, knots, values

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.fourier is None:
            return np.full(len(stats), self.values[0])
        raw = np.clip(self.fourier(stats) @ self.weights, LOW, HIGH)
        # a thousandth of the ridge score keeps the order inside a calibrated step
        return 0.999 * np.interp(raw, self.knots, self.values) + 0.001 * (raw - LOW) / (HIGH - LOW)


def fit(train: DataFrame) -> QualityModel:
    """Fit on ``train (stats, y, fold)``, all rows.  With no row, or one class
    only, the model is the share of label 1 (0.5 with no row)."""
    d = len(STATISTICS)
    moments = train.agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("p"),
        *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(d)], *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(d)],
    ).first()
    n, p = moments["n"], moments["p"] or 0
    if n == 0 or p in (0, n):
        return QualityModel(None, np.zeros(0), np.zeros(1), np.array([p / n if n else 0.5]))
    mean = np.array([moments[f"m{i}"] for i in range(d)])
    scale = np.array([max(moments[f"s{i}"], 1e-3) for i in range(d)])
    fourier = Fourier(mean, scale)
    sums = normal_equations(train, fourier)
    total = sum(sums.values())
    without = {k: _ridge(total - m if len(sums) > 1 else total) for k, m in sums.items()}

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = fourier(_matrix(batch.column(0))) if batch.num_rows else np.zeros((0, len(total) - 1))
            folds = batch.column(2).to_numpy()
            raw = np.zeros(len(z))
            for k, weights in without.items():
                raw[folds == k] = z[folds == k] @ weights
            at = np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(1)], names=["bin", "y"])

    rows = train.select("stats", F.col("y").cast("double"), F.col("fold").cast("int")).mapInArrow(bins, "bin int, y double")
    table = rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p")).toPandas().sort_values("bin")
    values = isotonic(table["n"].to_numpy(float), table["p"].to_numpy(float))
    knots = LOW + (table["bin"].to_numpy() + 0.5) * (HIGH - LOW) / BINS
    return QualityModel(fourier, _ridge(total), knots, values)


def score_documents(stats: DataFrame, model: QualityModel, ident: str = "doc_id") -> DataFrame:
    """``ident, score`` for every row of ``stats (ident, stats)``."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = np.clip(shared.value.score(_matrix(batch.column(1))), 0, 1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["id", "score"])

    kind = stats.schema[ident].dataType.simpleString()
    return stats.select(F.col(ident).alias("id"), "stats").mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", ident)


def op3_quality_classifier(spark: SparkSession, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    """Scores of all ``documents``, learned from labels whose remainder is not 0."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stats = materialize(document_statistics(docs), "stats")
    fold = remainder("doc_id", FOLDS + 1)
    known = labels.where(F.col("quality").isNotNull() & (fold != 0)).select("doc_id", F.col("quality").alias("y"), fold.alias("fold"))
    train = materialize(stats.join(known, "doc_id").select("stats", "y", "fold"), "labelled")
    scored = score_documents(stats, fit(train))
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", FOLDS + 1) == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
