"""Queries of the training-data operators and the pipeline, with DuckDB SQL
where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.chat import OP2_SQL, op2_chat_formatting
from quarry.llm.decontamination import op1_decontamination
from quarry.llm.embedding_dedup import OP10_SQL, op10_embedding_dedup
from quarry.llm.exact_dedup import OP12_SQL, op12_exact_dedup
from quarry.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from quarry.llm.langid import op5_language_id
from quarry.llm.merkle import OP11_SQL, op11_merkle_manifest
from quarry.llm.near_dedup import op7_near_dedup
from quarry.llm.packing import op6_best_fit_packing
from quarry.llm.pii import op9_pii
from quarry.llm.quality import op3_quality_classifier
from quarry.llm.substring_dedup import OP4_SQL, op4_substring_dedup
from quarry.llm.warc import OP8_SQL, op8_warc


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_chat_formatting": op2_chat_formatting,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_language_id": op5_language_id,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_near_dedup": op7_near_dedup,
        "op8_warc": op8_warc,
        "op9_pii": op9_pii,
        "op10_embedding_dedup": op10_embedding_dedup,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_exact_dedup": op12_exact_dedup,
        "op13_hard_negatives": op13_hard_negatives,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    """The other operators are tested against brute force, an exact round
    trip or held-out accuracy."""
    return {
        "op2_chat_formatting": OP2_SQL,
        "op4_substring_dedup": OP4_SQL,
        "op8_warc": OP8_SQL,
        "op10_embedding_dedup": OP10_SQL,
        "op11_merkle_manifest": OP11_SQL,
        "op12_exact_dedup": OP12_SQL,
        "op13_hard_negatives": OP13_SQL,
    }
