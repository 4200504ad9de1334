"""Compares query results with DuckDB on the same files."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, Decimal):
        return str(value)
    return value


def _key(row):
    return tuple((value is not None, str(value)) for value in row)


def spark_rows(df: DataFrame) -> list[tuple]:
    names = sorted(df.columns)
    return sorted((tuple(_plain(row[n]) for n in names) for row in df.collect()), key=_key)


def duck_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[str], list[tuple]]:
    cursor = connection.execute(sql)
    described = cursor.description
    order = sorted(range(len(described)), key=lambda i: described[i][0])
    rows = [tuple(_plain(row[i]) for i in order) for row in cursor.fetchall()]
    return [described[i][0] for i in order], [str(described[i][1]) for i in order], sorted(rows, key=_key)


def spark_types(df: DataFrame) -> list[str]:
    return [TYPES.get(t, t.upper()) for _, t in sorted(df.dtypes)]


def difference(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both results agree in names, types and values, else the first difference."""
    names, types, expected = duck_rows(connection, sql)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} != {names}"
    if spark_types(df) != types:
        return f"types {[(n, a, b) for n, a, b in zip(names, spark_types(df), types) if a != b]}"
    actual = spark_rows(df)
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"{names}: {a} != {e}"
    return None
