"""A join that spreads frequent keys over many tasks.

A first, narrow pass counts rows per key of the left side. A key with more than ``share`` of all
rows is heavy, and there are fewer than ``1 / share`` of them, so their list is bounded by the
parameter and may be broadcast. Each heavy key is cut into so many salted parts that none holds
more than ``share`` of the rows; the few rows of the right side under that key are copied for each
part. All other keys join plainly, as part 0. NULL keys match nothing; if they are frequent they
are cut into parts as well, so that they do not meet in one task.

The salt is a hash of other columns, not a random number: a lost task gives the same rows again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the left side that one key may bring to one task.
SHARE = 0.01


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = SHARE) -> DataFrame:
    """(keys, __parts): keys with more than ``share`` of the rows, NULL among them, and their parts."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    most = counts.agg((F.sum("__n") * share).alias("__most"))
    compared = counts.crossJoin(F.broadcast(most)).filter(F.col("__n") > F.col("__most"))  # one row
    return compared.select(*keys, F.ceil(F.col("__n") / F.col("__most")).cast("int").alias("__parts"))


def _marked(df: DataFrame, heavy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """With the number of parts of the row's key, NULL if it is not heavy."""
    renamed = heavy.select(*[F.col(k).alias(f"__heavy_{k}") for k in keys], "__parts")
    same: Column = reduce(and_, [df[k].eqNullSafe(renamed[f"__heavy_{k}"]) for k in keys])
    # Fewer than 1 / share rows.
    return df.join(F.broadcast(renamed), same, "left").drop(*[f"__heavy_{k}" for k in keys])


def split_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    spread: Sequence[str] | None = None,
    share: float = SHARE,
) -> DataFrame:
    """``left`` joined with ``right`` on equal column names, heavy keys of ``left`` in parts.

    ``spread`` names the columns of ``left`` whose hash chooses the part; all of them by default.
    Rows that agree in these stay together. Only ``left`` and ``inner`` joins, whose rows belong
    to the left side, can be cut this way.
    """
    if how not in ("left", "inner"):
        raise ValueError("only left and inner joins can be split by the left side")
    heavy = heavy_keys(left, keys, share)
    part = F.when(F.col("__parts") > 1, F.pmod(F.xxhash64(*(spread or left.columns)), F.col("__parts"))).otherwise(0)
    cut = _marked(left, heavy, keys).withColumn("__part", part.cast("int")).drop("__parts")
    numbers = F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)
    copied = _marked(right, heavy, keys).withColumn("__part", F.explode(numbers)).drop("__parts")
    return cut.join(copied, [*keys, "__part"], how).drop("__part")
