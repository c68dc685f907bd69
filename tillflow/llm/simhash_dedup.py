"""Near-duplicates by SimHash, found by pigeonhole blocks.

Fingerprint: A-Z are lower-cased; every three-word shingle, repeats included, is hashed with
XXH64 (seed 42, which is Spark's own ``xxhash64``); a bit is set if over half of the hashes
have it.  Texts of fewer words have one shingle, the whole sequence; texts without words
have fingerprint zero.  The bits are counted by sums over exploded shingles, two counters
in each long, so nothing but counters is ever held for a document.

Links: fingerprints link at ``MAX_BITS`` (3) or fewer differing bits.  The 64 bits are cut
into five blocks.  Three differing bits spoil at most three of them, so a close pair shares
at least two whole blocks, and each distinct fingerprint is filed under its ten pairs of
blocks (25 or 26 bits).  Members of a bucket are compared bit by bit.

A bucket can be large: near copies differ in few bits.  Buckets of over ``CHUNK``
fingerprints are cut into chunks by a hash, and each pair of chunks is a row of its own,
so no task holds more than two chunks, and hot buckets are spread.  A pair of chunks gives
the edges of a spanning forest and not all its links: the same components with at most as
many edges as fingerprints.  Equal fingerprints count once.

Defined results: null texts are empty.  Rows without a doc_id get components like any
other; a component's id is its smallest doc_id that isn't null, or null without one.
Repeated rows are results of their own.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import ascii_lower, col, fresh, stored, text_of, total, words_of
from tillflow.llm.components import components

MAX_BITS = 3
#: First bit and width of each block.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
CHUNK = 1024


def _shingle_hashes(w: str) -> Column:
    three = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.xxhash64(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
    )
    return F.when(F.size(w) >= 3, three).when(
        F.size(w) > 0, F.array(F.xxhash64(F.concat_ws(" ", F.col(w))))
    )


def fingerprints(rows: DataFrame) -> DataFrame:
    """row_no, doc_id, fp (a long) of each row of ``rows`` (row_no, doc_id, text)."""
    low = 0x0000000100000001
    words = rows.select("row_no", "doc_id", words_of(ascii_lower(text_of())).alias("w"))
    hashes = words.select("row_no", "doc_id", F.explode_outer(_shingle_hashes("w")).alias("h"))
    pairs = [
        F.sum(F.shiftrightunsigned("h", b).bitwiseAND(F.lit(low))).alias(f"c{b}")
        for b in range(32)
    ]
    counted = hashes.groupBy("row_no", "doc_id").agg(F.count("h").alias("n"), *pairs)
    mask = (1 << 32) - 1
    bits = [
        F.when(2 * F.col(f"c{b}").bitwiseAND(F.lit(mask)) > F.col("n"), F.lit(1 << b)).otherwise(0)
        for b in range(32)
    ] + [
        F.when(2 * F.shiftrightunsigned(f"c{b}", 32) > F.col("n"),
               F.lit((1 << (b + 32)) - ((1 << 64) if b == 31 else 0))).otherwise(0)
        for b in range(32)
    ]
    return counted.select("row_no", "doc_id", total(bits).cast("long").alias("fp"))


def _keys(fp: Column) -> Column:
    """The bucket keys of a fingerprint: the number of a pair of blocks, and their bits."""
    block = [
        F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1)) for at, width in BLOCKS
    ]
    pairs = [(i, j) for i in range(len(BLOCKS)) for j in range(i)]
    return F.array(*[
        F.shiftleft(F.lit(k).cast("long"), 32)
        .bitwiseOR(F.shiftleft(block[i], 13)).bitwiseOR(block[j])
        for k, (i, j) in enumerate(pairs)
    ])


def _forest(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[list[int], list[int]]:
    """A spanning forest of the links between two chunks (or within one)."""
    nodes = a if same else np.concatenate([a, b])
    root = list(range(len(nodes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    left, right = [], []
    shift = 0 if same else len(a)
    for i in range(len(a)):
        near = np.flatnonzero(np.bitwise_count(a[i] ^ b) <= MAX_BITS)
        for j in near:
            if same and j <= i:
                continue
            x, y = find(i), find(int(j) + shift)
            if x != y:
                root[y] = x
                left.append(int(nodes[i]))
                right.append(int(b[j]))
    return left, right


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left: list[int] = []
        right: list[int] = []
        one, two = batch.column("one"), batch.column("two")
        (av, ao), (bv, bo) = [
            (c.values.to_numpy(zero_copy_only=False).view(np.uint64), c.offsets.to_numpy())
            for c in (one, two)
        ]
        same = batch.column("same").to_pylist()
        for k in range(batch.num_rows):
            a, b = av[ao[k] : ao[k + 1]], bv[bo[k] : bo[k + 1]]
            x, y = _forest(a, b, same[k])
            left += x
            right += y
        out = np.array([left, right], np.uint64).astype(np.int64)
        yield pa.record_batch({"a": out[0], "b": out[1]})


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) with the components of all links of the distinct longs in ``fp``."""
    filed = stored(prints.select("fp", F.explode(_keys(F.col("fp"))).alias("key")), "simhash-keys")
    sizes = filed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    chunks = (
        filed.join(sizes, "key")
        .withColumn("parts", F.ceil(F.col("n") / CHUNK).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .groupBy("key", "parts", "part")
        .agg(F.sort_array(F.collect_list("fp")).alias("members"))
    )
    whole = chunks.where("parts = 1").select(
        F.col("members").alias("one"), F.col("members").alias("two"), F.lit(True).alias("same")
    )
    cut = stored(chunks.where("parts > 1"), "simhash-chunks")
    first = cut.select("key", F.col("part").alias("part1"), F.col("members").alias("one"))
    second = cut.select("key", F.col("part").alias("part2"), F.col("members").alias("two"))
    # A chunk meets those of its own bucket, each with at most CHUNK members or so.
    across = first.join(second, "key").where("part1 <= part2").repartition("key", "part1", "part2")
    across = across.select("one", "two", (F.col("part1") == F.col("part2")).alias("same"))
    found = whole.mapInArrow(_verify, "a long, b long").union(
        across.mapInArrow(_verify, "a long, b long")
    )
    return found.distinct()


def labelled(rows: DataFrame) -> DataFrame:
    """row_no, doc_id, fp, root (a fingerprint), component_id for ``rows`` (row_no, doc_id, text)."""
    slim = stored(fingerprints(rows), "simhash-prints")
    rep = stored(slim.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    tree = rep.join(
        components(links(rep.select("fp"))).withColumnRenamed("node", "fp"), "fp", "left"
    ).select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = tree.groupBy("root").agg(F.min("least").alias("component_id"))
    return slim.join(tree.select("fp", "root").join(ids, "root"), "fp")


def assigned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (hex), component_id for each row."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"),
        col(doc_id).alias("doc_id"),
        col(text).alias("text"),
    )
    return labelled(rows).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def distinct(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id, nulls last."""
    (row_no,) = fresh(docs, "row_no")
    rows = stored(docs.withColumn(row_no, F.monotonically_increasing_id()), "simhash-rows")
    found = labelled(
        rows.select(F.col(row_no).alias("row_no"), col(doc_id).alias("doc_id"), col(text).alias("text"))
    )
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_no")))
    keep = found.groupBy("root").agg(first.alias("first")).select("first.row_no")
    return rows.join(
        keep.withColumnRenamed("row_no", row_no), row_no, "left_semi"
    ).select(*[col(c) for c in docs.columns])
