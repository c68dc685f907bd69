"""Named queries over the given tables and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillflow.session import configure

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None = None


class Registry:
    """Queries by name, each with its SQL where SQL can express the result."""

    def __init__(self) -> None:
        self.entries: dict[str, Entry] = {}

    def add(self, name: str, sql: str | None = None):
        def keep(run: Query) -> Query:
            if name in self.entries:
                raise ValueError(f"query {name} is registered twice")
            self.entries[name] = Entry(run, sql)
            return run

        return keep


def _configured(run: Query) -> Query:
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), str(sf_dir).rstrip("/"))

    return call


def _all() -> dict[str, Entry]:
    from tillflow.registry import analytics, engine, scalars, storage

    merged: dict[str, Entry] = {}
    for module in (analytics, scalars, engine, storage):
        overlap = merged.keys() & module.REGISTRY.entries.keys()
        if overlap:
            raise ValueError(f"queries registered twice: {sorted(overlap)}")
        merged.update(module.REGISTRY.entries)
    return merged


def queries() -> dict[str, Query]:
    return {name: _configured(entry.run) for name, entry in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: entry.sql for name, entry in _all().items() if entry.sql}
