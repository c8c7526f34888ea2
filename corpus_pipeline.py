"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame.  ``run`` writes each stage's result as
Parquet in the shared folder and reads it back as the next stage's ``docs``,
so a lost executor costs at most a part of one stage.  All stages but the
last keep the columns of ``documents``.

Rows with the same id are possible in any stage; null texts fall out with the
language stage, which rejects what has no letter.  Columns beyond those of
``documents`` are carried along and may have any name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.decontamination import decontaminate
from quarry.llm.langid import learn_profiles, predict_language, remainder
from quarry.llm.near_dedup import near_duplicates
from quarry.llm.packing import pack_documents, word_bpe_path
from quarry.llm.pii import sanitise
from quarry.session import materialize

# Cosine below which a text resembles no learned language, by its number n of
# distinct trigrams: 0.2 min(1, n / 60) ** 1.5, and from 150 to 300 trigrams up
# to 0.35.  Noise reaches 0.17 at 60 trigrams, random Latin letters 0.21 at
# 3,000.  Distinct ones count, as repeating a text leaves its cosine.
LEAST_COSINE = 0.2
LEAST_COSINE_LONG = 0.35


def least_cosine(n: Column) -> Column:
    short = LEAST_COSINE * F.pow(F.least(F.lit(1.0), n / 60), 1.5)
    return short + (LEAST_COSINE_LONG - LEAST_COSINE) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), (n - 150) / 150))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; a null text, one without a letter or
    one unlike every language goes.  The predicted language fills a null one."""
    names, prototypes = learn_profiles(docs.where(remainder("doc_id", 4) != 2))
    if not names:  # nothing to learn from: only texts without a letter can be told
        return docs.where(F.col("text").rlike(r"\p{L}"))
    shadow = docs.select(*[F.col(c).alias(f"d_{c}") for c in docs.columns])
    known = predict_language(shadow, names, prototypes, text="d_text", distinct=True)
    kept = known.where((F.col("lang_pred") != "und") & (F.col("score") >= least_cosine(F.col("trigrams"))))
    lang = F.coalesce("d_lang", "lang_pred")
    return kept.select(*[(lang if c == "lang" else F.col(f"d_{c}")).alias(c) for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates at five-word shingles and
    a similarity of 0.8: the one with the smallest id.  Rows that share an id,
    or have none, are documents of their own, told apart by their text; of
    rows equal in id and text one stays."""
    shared = materialize(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("s_id"), F.lit(True).alias("s_any")), "shared-ids")
    if shared.isEmpty():
        found = near_duplicates(docs, width=5, percent=80)
        dropped = found.where(~F.col("kept")).select("doc_id").distinct()
        return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    # ids of such rows come from id and text, below all ids there are
    marked = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text").join(shared, F.col("doc_id").eqNullSafe(F.col("s_id")), "left")
    own = F.xxhash64("doc_id", "text").bitwiseOR(F.lit(-(1 << 63)))
    marked = marked.select("row", "text", F.col("s_any").isNotNull().alias("shared"), F.when(F.col("s_any"), own).otherwise(F.col("doc_id")).alias("near_id"))
    found = near_duplicates(marked, width=5, percent=80, ident="near_id")
    dropped = found.where(~F.col("kept")).select("near_id").distinct()
    left = marked.join(dropped, "near_id", "left_anti")
    left = left.where(~F.col("shared")).unionByName(left.where("shared").dropDuplicates(["near_id"]))
    return left.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and disclosing terms replaced in the text."""
    clean = sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns) if "n_chars" in docs.columns else clean


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences."""
    return pack_documents(docs, word_bpe_path()).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

# Hyperdimensional profiles, signatures and the tokenizer have no SQL; the
# stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
