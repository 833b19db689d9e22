"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import decontaminate, exact_dedup, html_extract, pii, quality, sentencepiece_bpe, simhash, suffix_dedup, token_files, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.annotate(table(spark, sf_dir, "documents"))


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file; LEXMILL_TOKENIZERS names another folder."""
    folder = os.environ.get("LEXMILL_TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digests(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end=2)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_token_files": op5_token_files,
    "op6_quality": op6_quality,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_simhash": op9_simhash,
    "op10_decontamination": op10_decontamination,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op7_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept,
               sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id)""",
}
