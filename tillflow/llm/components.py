"""Connected components of an undirected graph of long ids, by alternating stars.

Each round hangs every node's larger neighbours on its smallest one (large star) and then
its smaller ones (small star); the edges of a component end as a star around its smallest
node after a number of rounds that grows with the logarithm of its size.  A node with very
many neighbours is one row of a minimum that is summed before the shuffle, and a join whose
large partition can be split; no neighbourhood is gathered.  Each round is written below
``spark.checkpoint.dir``; the driver sees a count and a checksum of the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import stored

MOST_ROUNDS = 100


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
        F.struct(F.col("b").alias("u"), F.col("a").alias("v")),
    )).alias("e")).select("e.u", "e.v")


def _star(near: DataFrame, large: bool) -> DataFrame:
    least = near.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    hung = near.where("v > u") if large else near
    edges = hung.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    if not large:  # the node itself hangs on its smallest neighbour, too
        edges = edges.union(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return edges.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for each node of ``edges`` (a, b)."""
    near = edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges, before = stored(near.distinct(), "components"), None
    for _ in range(MOST_ROUNDS):
        edges = _star(_both_ways(edges), large=True)
        edges = _star(edges.select(F.col("b").alias("u"), F.col("a").alias("v")), large=False)
        edges = stored(edges, "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components are not settled after {MOST_ROUNDS} rounds")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
