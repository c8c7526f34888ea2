"""Language ID: held-out accuracy, linear bundling, edge rows."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np

from quarry.llm.langid import DIMENSIONS, LETTERS, SEED, _letter, learn_profiles, op5_language_id, predict_language, trigram_counts, trigram_vectors

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = op5_language_id(spark, SF).join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)


def test_bound_vectors_equal_the_definition():
    vectors = trigram_vectors()
    a, b, c = 3, 0, 40
    letters = [vectors[(x * LETTERS + x) * LETTERS + x] for x in (a, b, c)]
    assert len(letters) == 3 and set(np.unique(vectors[:1000])) == {-1, 1}
    # a trigram is unlike its permutations
    abc, cba = vectors[(a * LETTERS + b) * LETTERS + c].astype(int), vectors[(c * LETTERS + b) * LETTERS + a].astype(int)
    assert abs(int(abc @ cba)) < 0.3 * len(abc)


def test_counts_ignore_what_is_no_letter():
    at, counts, ok = trigram_counts("12 !?")
    assert not ok and len(at) == 0
    assert trigram_counts("\U0001f600")[2] is False and trigram_counts("\U00010400")[2] is True
    assert trigram_counts("aaa")[1].sum() == 3


def test_edge_rows_and_clashing_columns(spark):
    train = spark.createDataFrame([("the and of with", "en"), ("der und die mit", "de"), (None, "en"), ("xx", None), ("123", "fr")], "text string, lang string")
    names, prototypes = learn_profiles(train)
    assert names == ["de", "en"]
    docs = spark.createDataFrame([(1, "the with", "x"), (2, None, "x"), (3, "", "x"), (4, "42", "x"), (None, "und der", "x"), (1, "the with", "x")], "id bigint, text string, lang_pred string")
    rows = predict_language(docs, names, prototypes).collect()
    assert [r.lang_pred for r in rows] == ["en", "und", "und", "und", "de", "en"]
    assert all(0 <= r.score <= 1 for r in rows) and rows[1].score == 0
    assert predict_language(docs.limit(0), names, prototypes).count() == 0
    nothing, none = learn_profiles(train.limit(0))
    assert nothing == [] and {r.lang_pred for r in predict_language(docs, nothing, none).collect()} == {"und"}


def test_predictions_equal_plain_bundles(spark):
    """Vectors, prototypes and cosines recomputed without Spark, a trigram at a time."""
    small = "/root/testdata/sf0.001"
    base = np.random.default_rng(SEED).choice(np.array([-1, 1]), size=(LETTERS, DIMENSIONS))
    bound: dict = {}

    def counts(text):
        letters = [_letter(ord(c)) for c in f" {text or ''} "]
        return Counter(g for g in zip(letters, letters[1:], letters[2:]) if g[1])

    def bundle(grams):
        total = np.zeros(DIMENSIONS)
        for (a, b, c), n in grams.items():
            if (a, b, c) not in bound:
                bound[a, b, c] = np.roll(base[a], 2) * np.roll(base[b], 1) * base[c]
            total += n * bound[a, b, c]
        return total

    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang").collect()
    vectors, sums = {}, {}
    for r in docs:
        grams = counts(r.text)
        vectors[r.doc_id] = bundle(grams)
        if grams and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            size = np.sqrt(sum(n * n for n in grams.values()))
            sums[r.lang] = sums.get(r.lang, 0) + vectors[r.doc_id] / size
    names = sorted(sums)
    got = {r.doc_id: r for r in op5_language_id(spark, small).collect()}
    assert len(got) == len(docs) == len(vectors)
    for i, vector in vectors.items():
        if not vector.any():
            assert got[i].lang_pred == "und" and got[i].score == 0
            continue
        cosines = [float(sums[k] @ vector / np.linalg.norm(sums[k]) / np.linalg.norm(vector)) for k in names]
        assert abs(got[i].score - min(1, max(0, *cosines))) < 1e-4
        assert cosines[names.index(got[i].lang_pred)] > max(cosines) - 1e-4


def test_training_bundles_in_tasks_not_in_the_driver(spark):
    rows = [(f"{a} und {b} with the {b}{a}", lang) for i, (a, b) in enumerate(zip("abcdefgh", "stuvwxyz")) for lang in ("de", "en")[: 1 + i % 2]]
    trigram_vectors.cache_clear()
    names, prototypes = learn_profiles(spark.createDataFrame(rows, "text string, lang string").repartition(5))
    assert names == ["de", "en"] and trigram_vectors.cache_info().misses == 0  # the driver needs no trigram vectors
    vectors = trigram_vectors().astype(np.int64)
    for name, got in zip(names, prototypes):
        want = np.zeros(DIMENSIONS, dtype=np.int64)
        for text, lang in rows:
            if lang == name:
                at, counts, _ = trigram_counts(text)
                want += np.rint(counts * ((1 << 20) / np.sqrt(float(counts @ counts)))).astype(np.int64) @ vectors[at]
        assert np.allclose(got, want / np.linalg.norm(want), rtol=0, atol=1e-12)
