"""Counts of missing values for every column of a table in one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _missing(field: T.StructField) -> str:
    name = "`" + field.name.replace("`", "``") + "`"
    if isinstance(field.dataType, T.StringType):
        return f"coalesce(trim({name}), '') = ''"
    return f"{name} IS NULL"  # a number, date or flag that is present is never blank text


def _quoted(name: str) -> str:
    """The name as the inside of a SQL string."""
    return name.replace("\\", "\\\\").replace("'", "\\'")


def column_profile(df: DataFrame, layer: str, table: str) -> DataFrame:
    """One row per column: type, position, rows of the table, NULL or blank cells.

    All counters sit in a single aggregate and are then spread into rows. They are written as SQL
    text, since a wide table needs many of them.
    """
    fields = df.schema.fields
    counters = df.selectExpr("count(*) AS row_count", *[f"count_if({_missing(f)}) AS c{i}" for i, f in enumerate(fields)])
    rows = ", ".join(
        f"'{_quoted(f.name)}', '{f.dataType.simpleString()}', '{'YES' if f.nullable else 'NO'}', {i + 1}, row_count, c{i}"
        for i, f in enumerate(fields)
    )
    columns = "column_name, data_type, nullable, ordinal_position, row_count, null_count"
    long = counters.selectExpr(f"stack({len(fields)}, {rows}) AS ({columns})")
    return long.select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "*")
