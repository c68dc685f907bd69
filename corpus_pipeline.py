"""A training-data pipeline over ``documents``: filter, deduplicate, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs.  All but the last return the columns of documents;
the last returns doc_id, n_tokens and the token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import byte_bpe, exact_dedup, mixing, quality_rules, simhash_dedup
from tillflow.llm.common import documents, stored

#: Mixing and encoding have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return exact_dedup.distinct(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest doc_id stays."""
    return simhash_dedup.distinct(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Low-quality and toxic documents are thinned out to the target weights."""
    return mixing.mixed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    coded = byte_bpe.encoded(
        docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", rules),
    ("exact_dedup", exact),
    ("simhash_dedup", near),
    ("mixing", mix),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
