"""Exact duplicates by progressive refinement.

Texts are equal when they are identical after lower-casing A-Z.  Three keys narrow the
search: the length in bytes, a hash of the first bytes, and the SHA-256 of the whole text.
Each step keeps only the keys that more than one row has, so the digest column is compared
for the rows alone whose length and prefix another row shares.  The text itself is read
once: the scan that measures lengths and prefixes also makes the digest, because every
row's digest is part of the result, and no text is shuffled for grouping.

Groups are counted with sums made before the shuffle, so a group that holds a third of all
rows arrives as one row from each task.  Rows then meet their group's row in a join whose
large partitions can be split.

Defined results: a null text is empty, and all empty texts are one group.  Of equal texts
the largest doc_id stays; a null doc_id is smaller than any other.  Where several rows tie
(same text, same doc_id), one of them stays.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import ascii_lower, col, fresh, stored, text_of

PREFIX_CHARS = 256


def keyed(docs: DataFrame, carry: list[str], text: str) -> tuple[DataFrame, dict[str, str]]:
    """``carry`` with a row number, length, prefix hash and digest, written to shared files."""
    kinds = ["row_no", "n_bytes", "prefix_hash", "digest", "normal"]
    names = dict(zip(kinds, fresh(docs, *kinds)))
    normal = F.col(names["normal"])
    rows = docs.withColumn(names["normal"], ascii_lower(text_of(text))).select(
        *[col(c) for c in carry],
        F.monotonically_increasing_id().alias(names["row_no"]),
        F.octet_length(normal).alias(names["n_bytes"]),
        F.xxhash64(F.substring(normal, 1, PREFIX_CHARS)).alias(names["prefix_hash"]),
        F.sha2(normal, 256).alias(names["digest"]),
    )
    return stored(rows, "exact-keys"), names


def groups(rows: DataFrame, names: dict[str, str], doc_id: str) -> DataFrame:
    """digest, keep (doc_id, row_no), group_size of each text that two or more rows have."""
    size, prefix = names["n_bytes"], names["prefix_hash"]
    by_prefix = rows.groupBy(size, prefix).agg(F.count("*").alias("rows_of"))
    lengths = by_prefix.groupBy(size).agg(F.sum("rows_of").alias("of_length"))
    lengths = lengths.where("of_length > 1").select(size)
    prefixes = (
        by_prefix.where("rows_of > 1").join(lengths, size, "left_semi").select(size, prefix)
    )
    return (
        rows.select(
            size, prefix, names["digest"], col(doc_id).alias("id_of"),
            F.col(names["row_no"]).alias("no_of"),
        )
        .join(prefixes, [size, prefix], "left_semi")
        .groupBy(F.col(names["digest"]).alias("group_digest"))
        .agg(F.max(F.struct("id_of", "no_of")).alias("keep"), F.count("*").alias("size_of"))
        .where("size_of > 1")
    )


def assigned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row."""
    plain = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    slim, names = keyed(plain, ["doc_id"], "text")
    found = groups(slim, names, "doc_id")
    single = F.col("size_of").isNull()
    return slim.join(found, F.col(names["digest"]) == F.col("group_digest"), "left").select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep.id_of")).alias("keep_id"),
        F.coalesce("size_of", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col(names["row_no"]) == F.col("keep.no_of"))).alias("kept"),
        F.col(names["digest"]).alias("text_sha256"),
    )


def distinct(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row for each text."""
    rows, names = keyed(docs, docs.columns, text)
    found = groups(rows, names, doc_id)
    loser = (
        rows.select(F.col(names["digest"]), F.col(names["row_no"]).alias("drop_no"))
        .join(found, F.col(names["digest"]) == F.col("group_digest"))
        .where("drop_no != keep.no_of")
        .select("drop_no")
    )
    left = rows.join(loser, F.col(names["row_no"]) == F.col("drop_no"), "left_anti")
    return left.select(*[col(c) for c in docs.columns])
