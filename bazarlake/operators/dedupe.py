"""One row per key, always the same one.

Rows are ordered by ``order_by`` and then by all other columns, NULL first, so the kept row does
not depend on how the input is split or shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazarlake.operators.workdir import written

Order = Sequence[str | Column]


def _all_columns(df: DataFrame, keys: Sequence[str], order_by: Order | None) -> list[str | Column]:
    lead = list(order_by or [])
    return lead + [name for name in df.columns if name not in keys and name not in [c for c in lead if isinstance(c, str)]]


def keep_one(df: DataFrame, keys: Sequence[str], order_by: Order | None = None) -> DataFrame:
    """Keep the first row per key by a rank of 1.

    Spark limits each key to one row per task before the shuffle (WindowGroupLimit), so a key
    that holds a large part of the rows does not fill one task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*_all_columns(df, keys, order_by))
    return df.withColumn("__rank", F.row_number().over(ranked)).filter("__rank = 1").drop("__rank")


def keep_one_grouped(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """The same row from a grouping, by a minimum over a struct that is combined before the shuffle.

    Costs more per row than the rank, but as a grouping it tells Catalyst that the keys are
    unique: a left join with the result drops out of every query that does not read its columns.
    For tables on the right side of such joins.
    """
    first = F.min(F.struct(*_all_columns(df, keys, order_by))).alias("__first")
    best = df.groupBy(*keys).agg(first)
    return best.select(*[F.col(n) if n in keys else F.col(f"__first.{n}").alias(n) for n in df.columns])


def keep_one_packed(df: DataFrame, keys: Sequence[str], order_by: Order | None = None, packed: str = "record_hash") -> DataFrame:
    """``keep_one`` with a hash in lower-case hexadecimal text going through the shuffle as its bytes.

    They are half as long and sort like their text, so the same rows are kept.
    """
    kept = keep_one(df.withColumn(packed, F.unhex(packed)), keys, order_by)
    return kept.withColumn(packed, F.lower(F.hex(packed)))


#: Up to so many repeated keys are broadcast, eight bytes each.
MOST_REPEATED = 2_000_000


def keep_one_of_repeated(df: DataFrame, keys: Sequence[str], order_by: Order | None = None) -> DataFrame:
    """The same rows as ``keep_one``, but only rows whose key occurs more than once are shuffled whole.

    First the keys alone are counted, as 64-bit hashes, and the hashes that occur more than once are
    written. Rows without one of them have a key of their own and stay where they are; the others
    are ranked by their full keys, so two keys that share a hash cost a rank and no row. With more
    repeated hashes than can be broadcast all rows are ranked. Reads its input two or three times:
    for written tables whose rows are wide and whose keys seldom repeat.
    """
    marked = df.withColumn("__key", F.xxhash64(*keys))
    often = marked.groupBy("__key").agg(F.count("*").alias("n")).filter("n > 1").select("__key")
    repeated, n_repeated = written(often, "repeated")
    if n_repeated == 0:
        return df
    if n_repeated > MOST_REPEATED:
        return keep_one(df, keys, order_by)
    bounded = F.broadcast(repeated)  # at most MOST_REPEATED rows
    alone = marked.join(bounded, "__key", "left_anti").drop("__key")
    several = marked.join(bounded, "__key", "left_semi").drop("__key")
    return alone.unionByName(keep_one(several, keys, order_by))
