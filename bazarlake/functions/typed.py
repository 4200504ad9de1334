"""Text to typed values. Bad text gives NULL, also in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# Fixed value: the timestamp pattern of the review feed.
STRICT_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"


def to_int(name: str) -> Column:
    return F.col(name).try_cast("int").alias(name)


def to_double(name: str) -> Column:
    return F.col(name).try_cast("double").alias(name)


def to_money(name: str) -> Column:
    return F.col(name).try_cast(MONEY).alias(name)


def to_ts(name: str) -> Column:
    """Timestamp in any form Spark reads by itself."""
    return F.try_to_timestamp(name).alias(name)


def to_ts_strict(name: str) -> Column:
    """Timestamp in the review feed's pattern only."""
    return F.try_to_timestamp(F.col(name), F.lit(STRICT_TIMESTAMP)).alias(name)
