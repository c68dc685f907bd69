"""Rows, files and bytes of stored tables."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.checks import positive
from tillflow.functions import money

FOOTER_SCHEMA = (
    "file string, file_bytes long, rows long, row_groups long, column string, "
    "compressed_bytes long, uncompressed_bytes long"
)


def per_file(df: DataFrame, partition: Column | str) -> DataFrame:
    """Rows and size of every file; only the partition key is read.

    A file that holds several partitions is an error, as its bytes belong to none of them.
    """
    meta = df.select(
        (F.col(partition) if isinstance(partition, str) else partition).alias("partition"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
    )
    key = F.struct("partition")  # in a struct, a null counts as a value
    files = meta.groupBy("file").agg(
        F.min(key).alias("low"),
        F.max(key).alias("high"),
        F.count("*").alias("rows"),
        F.max("bytes").alias("bytes"),
    )
    mixed = F.raise_error(F.concat(F.lit("file holds several partitions: "), F.col("file")))
    one = F.when(F.col("low").eqNullSafe(F.col("high")), F.col("low")["partition"])
    return files.select(one.otherwise(mixed).alias("partition"), "file", "rows", "bytes")


def partition_stats(df: DataFrame, partition: Column | str) -> DataFrame:
    """Rows, files and bytes per partition."""
    return (
        per_file(df, partition)
        .groupBy("partition")
        .agg(
            F.sum("rows").alias("rows"),
            F.count("*").alias("files"),
            F.sum("bytes").alias("bytes_on_disk"),
        )
        .withColumn("disk_size", money.readable_size("bytes_on_disk"))
        .orderBy("partition")
    )


def many_files(df: DataFrame, partition: Column | str, more_than: int = 10) -> DataFrame:
    """Partitions that consist of too many files."""
    positive("more_than", more_than)
    return (
        partition_stats(df, partition)
        .where(F.col("files") > more_than)
        .orderBy(F.desc("files"), "partition")
    )


def _uri(path: str) -> str:
    """Spark writes local files as ``file:/x``; a URI wants ``file:///x``."""
    if path.startswith("file:/") and not path.startswith("file://"):
        return "file://" + path[len("file:"):]
    return path


def _read_footers(batches: Iterator) -> Iterator:
    """Column sizes from Parquet footers; the data pages are not read."""
    import pandas as pd
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    for batch in batches:
        rows = []
        for path, size in zip(batch["path"], batch["length"]):
            filesystem, inner = pafs.FileSystem.from_uri(_uri(path))
            with filesystem.open_input_file(inner) as handle:
                meta = pq.ParquetFile(handle).metadata
            sizes: dict[str, list[int]] = {}
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                for c in range(group.num_columns):
                    chunk = group.column(c)
                    column = chunk.path_in_schema.split(".")[0]
                    entry = sizes.setdefault(column, [0, 0])
                    entry[0] += chunk.total_compressed_size
                    entry[1] += chunk.total_uncompressed_size
            for column, (packed, plain) in sizes.items():
                rows.append(
                    (path, size, meta.num_rows, meta.num_row_groups, column, packed, plain)
                )
        names = [f.split()[0] for f in FOOTER_SCHEMA.split(", ")]
        yield pd.DataFrame(rows, columns=names)


def footers(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """One row per file and column, from the footers of a folder or file."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "length")
    )
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "path").mapInPandas(_read_footers, FOOTER_SCHEMA)


def _ratio(plain: str, packed: str) -> Column:
    return F.round(F.try_divide(F.col(plain), F.col(packed)), 2)


def column_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Compressed and uncompressed size of every column."""
    return (
        footers(spark, path)
        .groupBy("column")
        .agg(
            F.sum("compressed_bytes").alias("compressed_bytes"),
            F.sum("uncompressed_bytes").alias("uncompressed_bytes"),
        )
        .withColumn("compression_ratio", _ratio("uncompressed_bytes", "compressed_bytes"))
        .withColumn("compressed_size", money.readable_size("compressed_bytes"))
        .withColumn("uncompressed_size", money.readable_size("uncompressed_bytes"))
        .orderBy(F.desc("compressed_bytes"), "column")
    )


def table_size(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Files, rows, size on disk and compression ratio of a table."""
    by_file = (
        footers(spark, path)
        .groupBy("file")
        .agg(
            F.max("file_bytes").alias("file_bytes"),
            F.max("rows").alias("rows"),
            F.sum("uncompressed_bytes").alias("plain"),
        )
    )
    return by_file.agg(
        F.count("*").alias("files"),
        F.sum("rows").alias("total_rows"),
        F.sum("file_bytes").alias("bytes_on_disk"),
        F.sum("plain").alias("uncompressed_bytes"),
    ).select(
        F.lit(name).alias("table"),
        "files",
        "total_rows",
        "bytes_on_disk",
        money.readable_size("bytes_on_disk").alias("disk_size"),
        _ratio("uncompressed_bytes", "bytes_on_disk").alias("compression_ratio"),
    )
