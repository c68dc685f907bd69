"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillflow.llm import (
    byte_bpe,
    exact_dedup,
    html_templates,
    lang_gru,
    mixing,
    periodic_runs,
    quality_rules,
    secret_scans,
    simhash_dedup,
    spelling_variants,
    suffix_dedup,
    token_counts,
    toxicity,
)
from tillflow.llm.common import documents


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(documents(spark, sf_dir))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir), ["doc_id"])


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.counted(documents(spark, sf_dir), path)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assigned(documents(spark, sf_dir))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return byte_bpe.digests(documents(spark, sf_dir), path)


def op7_html_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_templates.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.assigned(documents(spark, sf_dir))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(documents(spark, sf_dir), _labels(spark, sf_dir))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.assigned(documents(spark, sf_dir), _labels(spark, sf_dir))


def op10_lang_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_gru.predicted(documents(spark, sf_dir))


def op11_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.digests(documents(spark, sf_dir))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(documents(spark, sf_dir))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_quality_rules, op3_token_counts, op4_exact_dedup, op5_byte_bpe, op6_toxicity,
        op7_html_templates, op8_simhash, op9_mixing, op10_lang_gru, op11_secret_scans,
        op12_spelling_variants, op13_periodic_runs,
    )
} | {"pipeline": corpus_pipeline.run}

_NORMAL = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
SQL = {
    "op4_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id,
               count(*) OVER (PARTITION BY h) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
        FROM (SELECT doc_id, sha256({_NORMAL}) AS h FROM documents)
    """,
}
