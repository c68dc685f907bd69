"""Partitioned Parquet tables: creation, inserts, partitions, compaction."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillflow.functions.times import week_start, yyyymm, yyyymmdd
from tillflow.sources import files, ledgers

MONTH = "ym"


# -- partition keys ---------------------------------------------------------


def monthly(ts: str) -> Column:
    return yyyymm(ts).alias(MONTH)


def daily(ts: str) -> Column:
    return yyyymmdd(ts).alias("ymd")


def weekly(ts: str) -> Column:
    return week_start(ts, "monday").alias("week")


# -- definition -------------------------------------------------------------


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def row_count(spark: SparkSession, table: str) -> int:
    return spark.table(table).count()


def create_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    location: str | None = None,
) -> None:
    """Create a Parquet table unless it exists; partition columns come last."""
    fields = [f for f in schema.fields if f.name not in partition_by]
    fields += [schema[p] for p in partition_by]
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in fields
    )
    by = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{by}{at}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def truncate_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


# -- rows in ----------------------------------------------------------------


def with_defaults(df: DataFrame, schema: StructType, defaults: dict[str, str]) -> DataFrame:
    """Columns of the schema, in its order and types.

    Missing and NULL values of columns that have a default get it; other
    missing columns must be nullable.
    """
    present = set(df.columns)
    columns = []
    for field in schema.fields:
        if field.name in defaults:
            default = F.expr(defaults[field.name])
            value = F.coalesce(F.col(field.name), default) if field.name in present else default
        elif field.name in present:
            value = F.col(field.name)
        elif field.nullable:
            value = F.lit(None)
        else:
            raise ValueError(f"column {field.name} has no value and no default")
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


#: Bytes of rows that :func:`clustered` sorts in one task; its files are no larger.
FILE_BYTES = 128 << 20


def planned_bytes(df: DataFrame) -> int | None:
    """What Spark expects the rows to take; None where it has no idea."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else None


def counted_bytes(df: DataFrame) -> int:
    """What the rows take in memory, by their number and the usual width of their types.

    Of rows that come straight from Parquet only the footers are read.
    """
    return df.count() * int(df._jdf.schema().defaultSize())


def clustered(
    df: DataFrame, order: Sequence[str], partitions: int | None = None, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, ready to be written.

    Ranges follow the row counts, so a month or user that holds a third of the
    rows is spread over a third of the tasks, files come out even, and their
    min/max statistics stay narrow.  The number of ranges is ``partitions``, or the
    planned bytes (of files: those that are read) or, if they are more, the counted bytes
    of the rows, divided by ``file_bytes``, whatever ``spark.sql.shuffle.partitions`` says:
    files can be far smaller than the rows that a task has to sort.  Rows of unknown size
    take that setting, and AQE merges small ranges.
    """
    if partitions is None and (size := planned_bytes(df)) is not None:
        partitions = max(1, -(-max(size, counted_bytes(df)) // file_bytes))
    ranged = (
        df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    )
    return ranged.sortWithinPartitions(*order)


def append(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> int:
    """Append by column name and return the number of rows written.

    The rows are counted while they are written, not in a second pass.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode("append").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return int(seen.get["rows"])


def insert_batch(
    spark: SparkSession,
    table: str,
    rows: Sequence[tuple],
    columns: Sequence[str],
    schema: StructType,
    defaults: dict[str, str] | None = None,
    month_of: str | None = None,
) -> int:
    """Append a small batch given by the caller; an empty batch writes nothing."""
    if not rows:
        return 0
    given = StructType([schema[c] for c in columns])
    df = with_defaults(spark.createDataFrame(list(rows), given), schema, defaults or {})
    return _append_monthly(df, table, month_of)


def insert_pandas(
    spark: SparkSession,
    table: str,
    frame,
    schema: StructType,
    defaults: dict[str, str] | None = None,
    month_of: str | None = None,
) -> int:
    """Append a pandas frame (sent through Arrow); an empty frame writes nothing."""
    if frame.empty:
        return 0
    df = with_defaults(spark.createDataFrame(frame), schema, defaults or {})
    return _append_monthly(df, table, month_of)


def _append_monthly(df: DataFrame, table: str, month_of: str | None) -> int:
    if month_of is None:
        return append(df, table)
    return append(df.withColumn(MONTH, yyyymm(month_of)), table, [MONTH])


def load_transactions(df: DataFrame, table: str, partitions: int | None = None) -> int:
    """Append payments sorted by user and time within months."""
    rows = df.withColumn(MONTH, yyyymm("created_at"))
    order = [MONTH, "user_id", "created_at", "transaction_id"]
    return append(clustered(rows, order, partitions), table, [MONTH])


def insert_select(df: DataFrame, table: str) -> None:
    """Append a query's result to an existing table, matching columns by name."""
    target = df.sparkSession.table(table)
    df.select(*target.columns).write.insertInto(table)


# -- partitions -------------------------------------------------------------


def _literal(value) -> str:  # noqa: ANN001
    """A partition value in SQL."""
    if value is None:
        return "NULL"
    if isinstance(value, int):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"DATE'{text}'" if isinstance(value, date) else f"'{text}'"


def _spec(partition: dict) -> str:
    return ", ".join(f"`{k}` = {_literal(v)}" for k, v in partition.items())


def partitions_of(spark: SparkSession, table: str, given: dict | None = None) -> list[dict]:
    """The partitions that a table has, with typed values; those that agree with ``given``.

    From the catalog, no data are read.  ``given`` may name some keys of several.
    """
    schema = spark.table(table).schema
    only = f" PARTITION ({_spec(given)})" if given else ""
    kinds = {"int": int, "bigint": int, "date": date.fromisoformat}
    out = []
    for row in spark.sql(f"SHOW PARTITIONS {table}{only}").collect():
        found = {}
        for part in row[0].split("/"):
            name, _, text = part.partition("=")
            kind = kinds.get(schema[name].dataType.simpleString(), str)
            found[name] = None if text == "__HIVE_DEFAULT_PARTITION__" else kind(unquote(text))
        out.append(found)
    return out


def drop_partition(spark: SparkSession, table: str, partition: dict) -> None:
    """Drop a partition, or all that some keys name (not every catalog drops these by itself)."""
    for whole in partitions_of(spark, table, partition):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(whole)})")


def _described(spark: SparkSession, what: str) -> str:
    """The location that DESCRIBE gives; of a partition its own comes first."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {what}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def location(spark: SparkSession, table: str) -> str:
    return _described(spark, table)


def partition_folder(spark: SparkSession, table: str, partition: dict) -> str:
    """Where the files of a partition lie, given by all its keys; without keys, of the table."""
    return _described(spark, f"{table} PARTITION ({_spec(partition)})" if partition else table)


def _each(spark: SparkSession, table: str, partition: dict) -> list[dict]:
    """The whole partitions that some keys name."""
    return partitions_of(spark, table, partition) if partition else [{}]


def partition_files(spark: SparkSession, table: str, partition: dict) -> list[str]:
    """The data files that a partition has now, or all partitions that some keys name."""
    return [
        f.path
        for whole in _each(spark, table, partition)
        for f in files.listing(spark, partition_folder(spark, table, whole))
    ]


def rows_of_files(spark: SparkSession, table: str, partition: dict, paths: Sequence[str]) -> DataFrame:
    """The rows of some files of a partition, with the columns of the table."""
    schema = spark.table(table).schema
    inner = StructType([f for f in schema.fields if f.name not in partition])
    rows = spark.read.schema(inner).parquet(*paths)
    fixed = {k: F.lit(v).cast(schema[k].dataType) for k, v in partition.items()}
    return rows.withColumns(fixed).select(*schema.names)


def move_partition(spark: SparkSession, table: str, archive: str, partition: dict) -> None:
    """Move the files of one partition to a table of the same columns; its own files stay.

    With some keys of several, all partitions that they name are moved by one plan.
    Files are renamed one by one, no row is rewritten, and a file is in one of the tables at
    any time.  The plan of a move is written beside the archive before its first file moves
    and closed after the last: a move that broke off is finished by the next one into the
    same archive (or :func:`resume_moves`), which then takes what has come to the source
    since.  Rows that arrive while a move runs are in files that aren't in its plan: they
    stay where they are.  The emptied partition stays in the catalog, as dropping it would
    delete files that are just being added.
    """
    if not table_exists(spark, archive):
        columns = spark.catalog.listColumns(table)
        keys = [c.name for c in columns if c.isPartition]
        create_table(spark, archive, spark.table(table).schema, keys)
    kinds = [{f.name: f.dataType for f in spark.table(t).schema.fields} for t in (table, archive)]
    if kinds[0] != kinds[1]:
        raise ValueError(f"{table} and {archive} have different columns")
    journal = moves_of(spark, archive)
    ledgers.resume(spark, journal)
    renames = []
    for whole in _each(spark, table, partition):
        if found := partition_files(spark, table, whole):
            spark.sql(f"ALTER TABLE {archive} ADD IF NOT EXISTS PARTITION ({_spec(whole)})")
            target = partition_folder(spark, archive, whole)
            renames += [(f, f"{target}/{files.name_of(f)}") for f in found]
    if renames:
        ledgers.carry_out(spark, journal, table, renames)
    for name in (table, archive):
        spark.catalog.refreshTable(name)


def moves_of(spark: SparkSession, archive: str) -> str:
    """The folder with the plans of moves into a table."""
    return f"{location(spark, archive)}/_moves"


def resume_moves(spark: SparkSession, archive: str) -> list[str]:
    """Finish moves into a table that broke off; their ids."""
    done = ledgers.resume(spark, moves_of(spark, archive))
    spark.catalog.refreshTable(archive)
    return done


def _side_table(table: str) -> str:
    return f"{table}_detached"


def detach_partition(spark: SparkSession, table: str, partition: dict) -> None:
    """Take a partition out of the table but keep its rows."""
    move_partition(spark, table, _side_table(table), partition)


def attach_partition(spark: SparkSession, table: str, partition: dict) -> None:
    """Bring a detached partition back."""
    move_partition(spark, _side_table(table), table, partition)


def compact(
    spark: SparkSession,
    table: str,
    partition: dict,
    merge: Callable[[DataFrame], DataFrame],
    order: Sequence[str],
    partitions: int | None = None,
) -> None:
    """Replace the files that a partition has now by files of their rows merged and sorted.

    Exactly the files that were read are replaced: files that inserts add meanwhile stay, and
    if one of those read is gone by then, nothing changes and the call fails.  The merged
    files are staged in a hidden folder of the table.  The exchange is written down before
    its first rename; one that broke off is finished by the next call.  With some keys of
    several, each partition that they name is merged by itself.
    """
    exchanges = f"{location(spark, table)}/_exchanges"
    for whole in _each(spark, table, partition):
        folder = partition_folder(spark, table, whole)
        record = f"{exchanges}/{'.'.join(f'{k}={v}' for k, v in whole.items()) or 'all'}.json"
        ledgers.finish_exchange(spark, record)
        read = partition_files(spark, table, whole)
        if read:
            staged = f"{exchanges}/{uuid.uuid4().hex}"
            merged = merge(rows_of_files(spark, table, whole, read))
            clustered(merged, order, partitions).drop(*whole).write.parquet(staged)
            ledgers.exchange(spark, record, folder, read, staged)
    spark.catalog.refreshTable(table)
