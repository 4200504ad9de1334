"""Exact distinct counts of several columns without tripling the rows.

Several ``countDistinct`` of one grouping make Spark expand every row once per counted column.
Here each column is grouped with the keys by itself, over a scan of these columns only, and the
narrow counts are joined on the keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """Two groupings: by keys and value, which shrinks a frequent pair before the shuffle, then by keys."""
    return df.groupBy(*keys, column).agg(F.lit(1).alias("__one")).groupBy(*keys).agg(F.count(column).alias(name))


def distinct_counts(df: DataFrame, keys: Sequence[str], counted: dict[str, str]) -> DataFrame:
    """Per key one count per column; ``counted`` maps columns to names. A NULL is not counted.

    Without keys, one row. Key columns that are NULL form a group of their own, as in a grouping.
    """
    parts = [_one(df, keys, column, name) for column, name in counted.items()]
    out = parts[0]
    for part in parts[1:]:
        if not keys:
            out = out.crossJoin(F.broadcast(part))  # one row each
            continue
        renamed = part.select(*[F.col(k).alias(f"__right_{k}") for k in keys], *[c for c in part.columns if c not in keys])
        same = [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys]
        out = out.join(renamed, same, "inner").drop(*[f"__right_{k}" for k in keys])
    return out
