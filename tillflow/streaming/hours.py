"""Hourly totals with bounded state and a side output of late rows.

Spark tracks the watermark of the stream and records it for each batch before the batch runs,
so a retry sees the same one.  It divides what a batch stores into three parts:

* ``open``: running totals of the hours that the watermark hasn't passed.  A batch takes over
  those of the batch before it, so they are at most the hours between the watermark and the
  newest row, however long the stream runs.
* ``closed``: totals of hours that the watermark has passed since, stored once.
* ``late``: totals of rows whose hour had ended by the watermark when they came, and of rows
  without a time.

Readers add the closed and the late rows and the open ones of each stream's last batch, so
totals are complete for rows in any order.
"""

from __future__ import annotations

import json
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.sources import files
from tillflow.streaming import pipelines

SUMS = ("transactions", "revenue")


def watermark_at(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark that the checkpoint has for a batch, in milliseconds; 0 before any row came."""
    text = files.read_text(spark, f"{checkpoint.rstrip('/')}/offsets/{batch_id}")
    if text is None:
        raise FileNotFoundError(f"{checkpoint} has no batch {batch_id}")
    return json.loads(text.splitlines()[1])["batchWatermarkMs"]


def maintain_hours(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    delay: str = "1 day",
    ts: str = "created_at",
    **trigger,
) -> StreamingQuery:
    """Start a stream of payments that keeps hourly totals in ``target``.

    Hours stay open until the newest row is ``delay`` past their end.
    """

    def feed(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = F.timestamp_millis(F.lit(watermark_at(spark, checkpoint, batch_id))).cast("timestamp_ntz")
        ended = F.coalesce(F.col("hour") + F.expr("INTERVAL 1 HOUR") <= mark, F.lit(True))
        name = pipelines.stream_id(checkpoint, spark)
        rows = pipelines.hourly_counts(batch, ts).withColumn(
            "part", F.when(ended, "late").otherwise("open")
        )
        if batch_id > 0:
            before = pipelines.written(spark, target, {name: batch_id - 1}).where("part = 'open'")
            carried = before.withColumn("part", F.when(ended, "closed").otherwise("open"))
            rows = rows.unionByName(carried.drop("stream", "batch_id"))
        pipelines.store_batch(_added(rows, "part", "hour"), target, name, batch_id)

    marked = stream.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", delay)
    return (
        marked.writeStream.foreachBatch(feed)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def hour_parts(spark: SparkSession, target: str) -> DataFrame:
    """hour, part, transactions, revenue: what counts of the stored rows."""
    last = pipelines.last_batches(spark, target)
    settled = pipelines.written(spark, target).where("part <> 'open'")
    still_open = pipelines.written(spark, target, last).where("part = 'open'")
    return _added(settled.unionByName(still_open), "hour", "part")


def hour_totals(spark: SparkSession, target: str) -> DataFrame:
    """hour, transactions, revenue over all rows, late ones too."""
    return _added(hour_parts(spark, target), "hour")


def _added(rows: DataFrame, *keys: str) -> DataFrame:
    """Sums of the totals; their type stays as it is over any number of batches."""
    sums = [F.sum(c).cast("decimal(38,2)" if c == "revenue" else "long").alias(c) for c in SUMS]
    return rows.groupBy(*keys).agg(*sums)
