"""Quality classifier: held-out accuracy, calibration parts, edge rows."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from quarry.llm.quality import BINS, FOLDS, HIGH, LOW, RIDGE, STATISTICS, Fourier, document_statistics, fit, isotonic, normal_equations, op3_quality_classifier, score_documents, statistics
from quarry.session import materialize

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    scored = op3_quality_classifier(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)
    everything = scored.collect()
    assert len(everything) == 1000 and all(0 <= r.score <= 1 for r in everything)
    assert all(r.predicted == int(r.score >= 0.3) for r in everything)


def test_statistics_of_edge_texts():
    got = statistics(pa.array(["", None, "a", "The The The THE!!", "x" * 100_000]))
    assert got.shape == (5, len(STATISTICS)) and np.isfinite(got).all()
    assert not got[0].any() and not got[1].any()
    assert got[3][STATISTICS.index("same_as_previous")] == 0.5


def test_partition_sums_equal_one_sum(spark):
    rng = np.random.default_rng(0)
    rows = [([float(x) for x in rng.normal(size=len(STATISTICS))], float(i % 2), i % 3) for i in range(300)]
    train = spark.createDataFrame(rows, "stats array<double>, y double, fold int").repartition(7)
    fourier = Fourier(np.zeros(len(STATISTICS)), np.ones(len(STATISTICS)), features=8)
    got = normal_equations(train, fourier)
    z = np.hstack([fourier(np.array([r[0] for r in rows])), np.array([[r[1]] for r in rows])])
    for k in range(3):
        own = z[[i for i, r in enumerate(rows) if r[2] == k]]
        assert np.allclose(got[k], own.T @ own)


def test_isotonic_is_monotone_and_keeps_the_mean():
    n, p = np.array([2.0, 1, 4, 1]), np.array([2.0, 0, 1, 1])
    got = isotonic(n, p)
    assert (np.diff(got) >= 0).all() and np.isclose((got * n).sum(), p.sum())


def test_nothing_or_one_class_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b", 9), (None, None, 9), (1, "", 9)], "doc_id bigint, text string, stats int")
    stats = materialize(document_statistics(docs), "stats")
    empty = spark.createDataFrame([], "stats array<double>, y int, fold int")
    assert {r.score for r in score_documents(stats, fit(empty)).collect()} == {0.5}
    ones = stats.selectExpr("stats", "1 AS y", "1 AS fold")
    assert {r.score for r in score_documents(stats, fit(ones)).collect()} == {1.0}
    assert score_documents(stats.limit(0), fit(empty)).count() == 0


def _plain_statistics(text):
    """The statistics of one text, counted one by one."""
    raw = (text or "").encode()
    if not raw:
        return [0.0] * len(STATISTICS)
    found = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    signs, sentence = b"%#$&*@^~", b".,;:?'\"-()"

    def share(test):
        return sum(1 for b in raw if test(b)) / len(raw)

    def part(test):
        return sum(1 for w in found if test(w)) / max(len(found), 1)

    sizes = [len(w) for w in found]
    mean = sum(sizes) / max(len(sizes), 1)
    times = Counter(found)
    shares = [n / len(raw) for n in Counter(raw).values()]
    is_space, is_letter = (lambda b: b in b"\x20\x09\x0b\x0c\x0d"), (lambda b: 97 <= b <= 122 or 65 <= b <= 90 or 48 <= b <= 57)
    return [
        np.log1p(len(raw)), np.log1p(len(found)), min(mean, 40), min(np.sqrt(sum((s - mean) ** 2 for s in sizes) / max(len(sizes), 1)), 40),
        share(lambda b: 97 <= b <= 122), share(lambda b: 65 <= b <= 90), share(lambda b: 48 <= b <= 57), share(is_space), share(lambda b: b == 10),
        share(lambda b: b == 33), share(lambda b: b in signs), share(lambda b: b == 124), share(lambda b: b in sentence),
        share(lambda b: b < 128 and not is_letter(b) and not is_space(b) and b not in b"\n!|" and b not in signs and b not in sentence),
        share(lambda b: b >= 128), len(times) / max(len(found), 1), max(times.values(), default=0) / max(len(found), 1),
        sum(a == b for a, b in zip(found, found[1:])) / max(len(found), 1), part(lambda w: 65 <= w[0] <= 90),
        part(lambda w: w[-1] == 33 or w[-1] in signs), -sum(s * np.log(s) for s in shares) if found else 0.0, part(lambda w: len(w) > 15),
    ]


def test_scores_equal_a_plain_fit(spark):
    """Statistics, features, ridge and calibration recomputed without Spark."""
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    x = {r.doc_id: np.array(_plain_statistics(r.text)) for r in docs}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect() if r.quality is not None}
    fold = {i: zlib.crc32(str(i).encode()) % (FOLDS + 1) for i in x}
    train = [i for i in x if i in labels and fold[i]]
    own, y = np.array([x[i] for i in train]), np.array([float(labels[i]) for i in train])
    folds = np.array([fold[i] for i in train])
    fourier = Fourier(own.mean(axis=0), np.maximum(own.std(axis=0), 1e-3))

    def features(rows):
        inside = np.clip((rows - fourier.mean) / fourier.scale, -6, 6) @ fourier.w + fourier.b
        return np.hstack([np.sqrt(2 / len(fourier.b)) * np.cos(inside), np.ones((len(rows), 1))])

    def ridge(z, t):
        penalty = np.full(z.shape[1], RIDGE * len(z))
        penalty[-1] = 0
        return np.linalg.solve(z.T @ z + np.diag(penalty), z.T @ t)

    z = features(own)
    left_out = np.zeros(len(y))
    for k in set(folds):
        left_out[folds == k] = z[folds == k] @ ridge(z[folds != k], y[folds != k])
    at = np.clip((left_out - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(int)
    bins = sorted(set(at))
    n, p = np.array([np.sum(at == b) for b in bins]), np.array([y[at == b].sum() for b in bins])
    # isotonic regression by its min-max formula
    level = [max(min(p[j : k + 1].sum() / n[j : k + 1].sum() for k in range(i, len(n))) for j in range(i + 1)) for i in range(len(n))]
    raw = np.clip(features(np.array([x[r.doc_id] for r in docs])) @ ridge(z, y), LOW, HIGH)
    want = 0.999 * np.interp(raw, LOW + (np.array(bins) + 0.5) * (HIGH - LOW) / BINS, level) + 0.001 * (raw - LOW) / (HIGH - LOW)
    got = {r.doc_id: r for r in op3_quality_classifier(spark, small).collect()}
    assert len(got) == len(docs) and np.allclose([got[r.doc_id].score for r in docs], want, atol=1e-6)
    assert all(got[i].held_out == (fold[i] == 0) for i in x)
