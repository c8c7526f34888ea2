"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1.  A letter trigram is
bound by multiplying its letters' vectors, each rotated by its place; a text
is the bundle (sum) of its trigrams, a language prototype the bundle of the
unit-length trigram counts of its training documents.  Bundling is linear, so
each training task bundles its own documents and Spark adds the bundles up:
the driver gets one vector per language.  A document gets the language whose
prototype has the largest cosine with its vector."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DIMENSIONS = 512
LETTERS = 48  # 0: not a letter; 1-26: a-z; the rest shared by other letters
TRIGRAMS = LETTERS**3
_WEIGHT = 1 << 20  # unit-length counts are summed as integers, so sums don't depend on order
SEED = 20
_BUNDLE_ROWS = 1024  # trigram vectors bundled at once


def _letter(code: int) -> int:
    ch = chr(code)
    if not ch.isalpha():
        return 0
    low = ch.lower()[0]
    return ord(low) - 96 if "a" <= low <= "z" else 27 + (ord(low) * 31) % (LETTERS - 27)


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([0 if 0xD800 <= c < 0xE000 else _letter(c) for c in range(0x10000)], dtype=np.uint8)


@lru_cache(1)
def trigram_vectors(dimensions: int = DIMENSIONS) -> np.ndarray:
    """The bound vector of every trigram, one row each, as -1 and +1."""
    rng = np.random.default_rng(SEED)
    base = rng.choice(np.array([-1, 1], dtype=np.int8), size=(LETTERS, dimensions))
    first, second = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
    return (first[:, None, None, :] * second[None, :, None, :] * base[None, None, :, :]).reshape(TRIGRAMS, dimensions)


def trigram_counts(text: str) -> tuple[np.ndarray, np.ndarray, bool]:
    """Distinct trigrams around each letter of ``text``, their counts, and
    whether the text has a letter.  The text is read between two spaces."""
    codes = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    table = _letters()
    if codes.max() < 0x10000:
        letters = table[codes].astype(np.int32)
    else:
        letters = table[np.minimum(codes, 0xFFFF)].astype(np.int32)
        for i in np.flatnonzero(codes >= 0x10000):
            letters[i] = _letter(int(codes[i]))
    middle = letters[1:-1] > 0
    grams = ((letters[:-2] * LETTERS + letters[1:-1]) * LETTERS + letters[2:])[middle]
    if not len(grams):
        return grams, grams, False
    counts = np.bincount(grams)
    at = np.flatnonzero(counts)
    return at, counts[at], True


def learn_profiles(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Language names and unit-length prototypes from ``docs``; rows without
    a language or a letter teach nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, name in zip(batch.column(0), batch.column(1).to_pylist()):
                if not value.is_valid:
                    continue
                at, counts, ok = trigram_counts(value.as_py())
                if ok:
                    total = sums.setdefault(name, np.zeros(TRIGRAMS, dtype=np.int64))
                    total[at] += np.rint(counts * (_WEIGHT / np.sqrt(float(np.dot(counts, counts))))).astype(np.int64)
        vectors = trigram_vectors() if sums else None
        for name, total in sums.items():
            at = np.flatnonzero(total)
            bundle = np.zeros(DIMENSIONS, dtype=np.int64)
            for k in range(0, len(at), _BUNDLE_ROWS):
                some = at[k : k + _BUNDLE_ROWS]
                bundle += total[some] @ vectors[some].astype(np.int64)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * DIMENSIONS, pa.string()), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(bundle)], names=["lang", "place", "value"]
                )
        # workers are kept between stages; the 57 MB of vectors are not
        del vectors
        trigram_vectors.cache_clear()

    rows = docs.where(F.col(lang).isNotNull()).select(F.col(text), F.col(lang)).mapInArrow(run, "lang string, place int, value bigint")
    table = rows.groupBy("lang", "place").agg(F.sum("value").alias("value")).collect()
    names = sorted({r.lang for r in table})
    number = {name: i for i, name in enumerate(names)}
    prototypes = np.zeros((len(names), DIMENSIONS))
    for r in table:
        prototypes[number[r.lang], r.place] = r.value
    norms = np.linalg.norm(prototypes, axis=1, keepdims=True)
    return names, prototypes / np.where(norms > 0, norms, 1)


def predict_language(
    docs: DataFrame, names: list[str], prototypes: np.ndarray, text: str = "text", keep: list[str] | None = None, distinct: bool = False
) -> DataFrame:
    """The ``keep`` columns of ``docs`` (default: all) with ``lang_pred`` and
    ``score`` (cosine, at least 0).  A null text, a text without a letter, or
    no learned language give ``und`` with score 0; equal cosines go to the
    first name in order.  With ``distinct`` the number of distinct trigrams is
    added as ``trigrams``.  Columns of these names are replaced."""
    added = ["lang_pred", "score", "trigrams"] if distinct else ["lang_pred", "score"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    src = docs.select(*kept, *([] if text in kept else [text]))
    shared = docs.sparkSession.sparkContext.broadcast((names, prototypes.astype(np.float32)))
    at_text = src.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, profiles = shared.value
        vectors = trigram_vectors()
        for batch in batches:
            found, scores, sizes = [], [], []
            for value in batch.column(at_text):
                at, counts, ok = trigram_counts(value.as_py()) if value.is_valid else ((), None, False)
                sizes.append(len(at))
                if not ok or not labels:
                    found.append("und")
                    scores.append(0.0)
                    continue
                vector = counts.astype(np.float32) @ vectors[at].astype(np.float32)
                cosines = profiles @ vector / max(float(np.linalg.norm(vector)), 1e-12)
                best = int(np.argmax(cosines))
                found.append(labels[best])
                scores.append(min(1.0, max(0.0, float(cosines[best]))))
            new = [pa.array(found, pa.string()), pa.array(scores, pa.float64()), pa.array(sizes, pa.int32())][: len(added)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *new], names=[*kept, *added])
        # workers are kept between stages; the 57 MB of vectors are not
        del vectors
        trigram_vectors.cache_clear()
        pa.default_memory_pool().release_unused()

    fields = StructType([src.schema[c] for c in kept]).add("lang_pred", "string").add("score", "double")
    if distinct:
        fields = fields.add("trigrams", "integer")
    return src.mapInArrow(run, fields)


def remainder(ident: str, modulus: int):
    """``crc32(id as text) mod modulus``, the rule of the held-out folds."""
    return F.crc32(F.col(ident).cast("string").cast("binary")) % modulus


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all ``documents``, learned where the remainder is not 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    names, prototypes = learn_profiles(docs.where(remainder("doc_id", 4) != 2))
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return predict_language(rows, names, prototypes, keep=["doc_id", "held_out"])
