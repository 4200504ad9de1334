"""Global ranks, running totals and exact percentiles without a single-partition window.

A window without PARTITION BY moves all rows into one task. Here the rows are range-partitioned
by the sort keys and checkpointed; each partition then only needs the total of the partitions
before it, one number per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazarlake.operators.workdir import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def _sorted_slices(df: DataFrame, order_by: Sequence[Column]) -> DataFrame:
    """Rows in global order with slice number and position; fixed by the checkpoint.

    The sort keys must be unique per row, so that no key can fill a slice.
    """
    slices = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    numbered = slices.withColumn("__id", F.monotonically_increasing_id())
    return materialize(numbered).withColumns(
        {
            "__slice": F.shiftright("__id", _ROW_BITS),
            "__place": F.col("__id") - F.shiftleft(F.shiftright("__id", _ROW_BITS), _ROW_BITS),
        }
    )


def _offsets(totals: DataFrame) -> DataFrame:
    """Total before each slice. One row per slice, so the window's single task stays small."""
    before = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("__slice", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before"))


def global_row_number(df: DataFrame, order_by: Sequence[Column], name: str) -> DataFrame:
    """1, 2, 3, … over all rows. ``order_by`` must end in a unique key."""
    rows = _sorted_slices(df, order_by)
    offsets = _offsets(rows.groupBy("__slice").agg(F.count("*").alias("__total")))
    ranked = rows.join(F.broadcast(offsets), "__slice")  # as many rows as shuffle partitions
    rank = F.col("__before") + F.col("__place") + 1
    return ranked.select(*df.columns, rank.cast("bigint").alias(name))


def running_total(df: DataFrame, order_by: Sequence[Column], weight: str, name: str) -> DataFrame:
    """Inclusive running sum of ``weight`` over all rows. ``order_by`` must end in a unique key."""
    rows = _sorted_slices(df, order_by)
    offsets = _offsets(rows.groupBy("__slice").agg(F.sum(weight).alias("__total")))
    inside = Window.partitionBy("__slice").orderBy("__place").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("__inside", F.sum(weight).over(inside))
    total = F.col("__before") + F.col("__inside")
    return summed.join(F.broadcast(offsets), "__slice").select(*df.columns, total.alias(name))


def exact_percentiles(df: DataFrame, metrics: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    """(metric, fraction, value): the smallest value with at least that share of rows at or below.

    Works on counts per distinct value, so a frequent value is one row; NULL is left out.
    """
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
        ).alias("m")
    ).select("m.*")
    counts = long.filter("value IS NOT NULL").groupBy("metric", "value").agg(F.count("*").alias("n"))
    running = running_total(counts, [F.col("metric"), F.col("value")], "n", "upto")
    spans = running.groupBy("metric").agg(
        F.max("upto").alias("last"), F.min(F.col("upto") - F.col("n")).alias("first")
    )
    wanted = spans.select(
        "metric", "last", "first", F.explode(F.array(*[F.lit(f) for f in fractions])).alias("fraction")
    ).withColumn(
        "target",
        F.col("first") + F.greatest(F.lit(1), F.ceil(F.col("fraction") * (F.col("last") - F.col("first")))),
    )
    # One row per metric and fraction: bounded by the two lists given by the caller.
    hits = running.join(F.broadcast(wanted), "metric").filter(F.col("upto") >= F.col("target"))
    return hits.groupBy("metric", "fraction").agg(F.min("value").alias("value"))
