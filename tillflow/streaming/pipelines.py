"""Streams that maintain views.

``foreachBatch`` may run a batch twice.  Each attempt writes a folder of its own and is then
entered in the ledger of the target, an empty file whose name says stream, batch and attempt.
Readers take the folders of the ledger, for each batch that of its last attempt: a repeated
batch counts once and half a batch doesn't count.  A stream goes by the id that Spark keeps in
its checkpoint, so a checkpoint that was wiped is a new stream, even at the same path, and
streams and backfills into one view don't meet.  Readers merge the batches;
:func:`compact_view` merges them for good.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.functions.times import yyyymm
from tillflow.operators.merges import latest_version
from tillflow.sources import files


#: What one batch takes by default.
BATCH_BYTES = 64 << 30


def stream_files(
    spark: SparkSession,
    path: str,
    schema,
    files_per_batch: int | None = None,
    bytes_per_batch: int = BATCH_BYTES,
) -> DataFrame:
    """Parquet files as a stream, where they lie.

    ``path`` is a folder, or a pattern of files and folders.  A batch takes files of about
    ``bytes_per_batch`` together, or ``files_per_batch`` files if that is given.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        return reader.option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return reader.option("maxBytesPerTrigger", bytes_per_batch).parquet(path)


def stream_id(checkpoint: str, spark: SparkSession | None = None) -> str:
    """The name of the stream that a checkpoint belongs to; backfills take any other name.

    It is the query's id, which the checkpoint holds from the first start on; before that, and
    without a session, a name that no stream has.
    """
    spark = spark or SparkSession.getActiveSession()
    text = files.read_text(spark, f"{checkpoint.rstrip('/')}/metadata") if spark else None
    if text is None:
        return "unstarted" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    return "s" + json.loads(text)["id"].replace("-", "")


def store_batch(
    rows: DataFrame, target: str, stream: str, batch_id: int, columns: Sequence[str] = ()
) -> None:
    """Write one attempt of a batch and enter it in the ledger in place of an earlier one."""
    spark, attempt = rows.sparkSession, "a" + uuid.uuid4().hex[:12]
    rows.write.partitionBy(*columns).parquet(_folder(target, stream, batch_id, attempt))
    earlier = [e for e in _ledger(spark, target) if e[:2] == (stream, batch_id)]
    files.write_text(spark, f"{target}/_ledger/{stream}.{batch_id}.{attempt}", "")
    for e in earlier:
        files.delete(spark, [f"{target}/_ledger/{'.'.join(map(str, e[:3]))}", _folder(target, *e[:3])])


def _folder(target: str, stream: str, batch_id: int, attempt: str) -> str:
    return f"{target}/stream={stream}/batch_id={batch_id}/attempt={attempt}"


def _ledger(spark: SparkSession, target: str) -> list[tuple[str, int, str, int]]:
    """stream, batch, attempt and time of each entry."""
    out = []
    for f in files.listing(spark, f"{target}/_ledger"):
        stream, batch_id, attempt = files.name_of(f.path).rsplit(".", 2)
        out.append((stream, int(batch_id), attempt, f.modified))
    return out


def written(spark: SparkSession, target: str, only: dict[str, int] | None = None) -> DataFrame:
    """The rows of all batches that the ledger of a target has, with stream and batch_id.

    ``only`` names one batch for each stream that is wanted.
    """
    last: dict[tuple[str, int], tuple[int, str]] = {}
    for stream, batch_id, attempt, at in _ledger(spark, target):
        if only is None or only.get(stream) == batch_id:
            last[stream, batch_id] = max(last.get((stream, batch_id), (0, "")), (at, attempt))
    if not last or only is not None and len(last) < len(only):
        raise FileNotFoundError(f"{only or 'no batch'}: not (all) stored in {target}")
    paths = [_folder(target, *key, attempt) for key, (_, attempt) in sorted(last.items())]
    return spark.read.option("basePath", target).parquet(*paths).drop("attempt")


def last_batches(spark: SparkSession, target: str) -> dict[str, int]:
    """The last batch of each stream that the ledger of a target has."""
    last: dict[str, int] = {}
    for stream, batch_id, _, _ in _ledger(spark, target):
        last[stream] = max(last.get(stream, 0), batch_id)
    return last


def write_delta(view, rows: DataFrame, root: str, batch_id: int, stream: str = "backfill") -> None:
    """Store what one batch of a stream adds to a view, replacing an earlier attempt."""
    delta = view.delta(rows)
    columns = []
    if view.month_of:
        delta = delta.withColumn("ym", yyyymm(view.month_of))
        columns = ["ym"]
    store_batch(delta, f"{root}/{view.name}", stream, batch_id, columns)


def maintain(
    stream: DataFrame,
    views: Sequence,
    root: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    **trigger,
) -> StreamingQuery:
    """Start a stream that feeds every view from each micro-batch.

    An exception in any view fails the query; after a restart the same batch
    runs again for all of them.  Stopping the query leaves the targets in place.
    """

    def feed(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        stream_name = stream_id(checkpoint, batch.sparkSession)
        if len(views) == 1:
            write_delta(views[0], rows, root, batch_id, stream_name)
            return
        # Several views read the batch; losing an executor only recomputes it.
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for view in views:
                write_delta(view, rows, root, batch_id, stream_name)
        finally:
            rows.unpersist()

    return (
        stream.writeStream.foreachBatch(feed)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def refresh(
    stream: DataFrame,
    views: Sequence,
    root: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Add what is new in the stream's source to every view, and return when it is stored.

    The checkpoint knows which files were taken, so a repeated refresh reads only new ones.
    """
    maintain(stream, views, root, checkpoint, prepare).awaitTermination()


def _of_batches(rows: DataFrame, up_to: int | dict[str, int]) -> Column:
    """Batches up to a number; for several streams a number for each of them."""
    if isinstance(up_to, dict):
        named = [(F.col("stream") == s) & (F.col("batch_id") <= n) for s, n in up_to.items()]
        return reduce(lambda a, b: a | b, named, F.lit(False))
    if rows.select("stream").distinct().limit(2).count() > 1:
        raise ValueError("several streams feed this view: name a batch for each of them")
    return F.col("batch_id") <= up_to


def _batches(spark: SparkSession, view, root: str) -> DataFrame:
    return written(spark, f"{root}/{view.name}")


def stored(
    spark: SparkSession, view, root: str, after_batch: int | dict[str, int] | None = None
) -> DataFrame:
    """Rows a view has stored, optionally only of batches after the given ones."""
    rows = _batches(spark, view, root)
    if after_batch is not None:
        rows = rows.where(~_of_batches(rows, after_batch))
    return rows.drop("stream")


def compact_view(
    spark: SparkSession, view, root: str, target: str, up_to: int | dict[str, int],
    partitions: int | None = None
) -> None:
    """Merge the batches up to ``up_to`` into a new folder.

    The source is left alone until readers have moved to
    :func:`compacted_and_new`, so a failed run loses nothing.
    """
    rows = _batches(spark, view, root)
    merged = view.merge(rows.where(_of_batches(rows, up_to)).drop("stream"))
    columns = []
    if view.month_of:
        merged = merged.withColumn("ym", yyyymm(view.month_of))
        columns = ["ym"]
    if partitions:
        merged = merged.repartitionByRange(partitions, *view.keys)
    merged.write.mode("overwrite").partitionBy(*columns).parquet(target)


def compacted_and_new(
    spark: SparkSession, view, root: str, target: str, up_to: int | dict[str, int]
) -> DataFrame:
    """States of a compacted folder and of the batches that came after it."""
    fresh = stored(spark, view, root, after_batch=up_to).drop("batch_id")
    return spark.read.parquet(target).unionByName(fresh, allowMissingColumns=True)


def joined_at_arrival(
    dimension: Callable[[], DataFrame], join: Callable[[DataFrame, DataFrame], DataFrame]
) -> Callable[[DataFrame], DataFrame]:
    """Preparation step that joins each batch with the dimension as it is now;
    rows stored earlier keep what they were joined with."""

    def prepare(batch: DataFrame) -> DataFrame:
        return join(batch, dimension())

    return prepare


def hourly_counts(rows: DataFrame, ts: str = "created_at") -> DataFrame:
    """Hourly totals of a batch."""
    return rows.groupBy(F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour")).agg(
        F.count("*").alias("transactions"), F.sum("amount").alias("revenue")
    )


def without_repeats(rows: DataFrame, keys: Sequence[str], version: str = "created_at") -> DataFrame:
    """The newest row of every key.

    Applied to each batch it thins out what is stored; applied to the stored rows it
    settles repeats of different batches.  Nothing is forgotten and no row is too late.
    """
    return latest_version(rows, keys, version)


def write_batches(
    stream: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    root: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Store what ``prepare`` makes of each batch; :func:`written` reads it."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        store_batch(prepare(batch), root, stream_id(checkpoint, batch.sparkSession), batch_id)

    return (
        stream.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
