"""Run a registered query in Spark and its SQL in DuckDB and compare them."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    """A comparable form that keeps the kind of the value."""
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, Decimal):
        return ("decimal", str(value.normalize() + 0))
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else repr(value + 0.0))
    if isinstance(value, dt.datetime):
        return ("time", value.replace(tzinfo=None).isoformat())
    if isinstance(value, dt.date):
        return ("date", value.isoformat())
    if isinstance(value, (list, tuple)):
        return ("list", tuple(plain(v) for v in value))
    if isinstance(value, dict):
        return ("dict", tuple(sorted((k, plain(v)) for k, v in value.items())))
    return (type(value).__name__, value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return names, sorted(out, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    return rows_of(columns, cur.fetchall())


def difference(spark_result, duck_result) -> str | None:
    """None when equal, otherwise a short description."""
    (sn, sr), (dn, dr) = spark_result, duck_result
    if sn != dn:
        return f"columns differ: {sn} / {dn}"
    if len(sr) != len(dr):
        return f"{len(sr)} rows / {len(dr)} rows"
    for i, (a, b) in enumerate(zip(sr, dr)):
        if a != b:
            return f"row {i} differs:\n  spark {a}\n  sql   {b}"
    return None
