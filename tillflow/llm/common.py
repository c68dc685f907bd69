"""Pieces that several operators of this subpackage share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.session import discard_at_exit, shared_dir

#: What separates words: a space or a control character from tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, purpose: str, steps: list[str] | None = None) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor costs tasks that read these files again.  They are
    deleted when the application ends; ``steps`` gets the folder's path, to discard it sooner.
    """
    path = shared_dir(df.sparkSession, purpose)
    if steps is not None:
        steps.append(path)
    df.write.parquet(path)
    discard_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """The words of a text in their order."""
    return F.array_remove(F.split(text, SPACES), "")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its plain name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
