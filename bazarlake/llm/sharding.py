"""Shards by jump consistent hashing: the key and the number of shards decide, without a table.

With one shard more, about one key in (shards + 1) moves, and only into the new shard. Slots number
the rows of each shard from 0 without gaps: rows are checkpointed where they lie, each partition
counts its rows per shard, and a row's slot is the count before its partition plus its place in it.
So no shard and no frequent key is gathered in one task.

Defined cases: a null id is a key of its own, the same everywhere; a null text has no bytes and the
checksum of no bytes; rows that repeat an id share its shard and get a slot each; an empty table
gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazarlake.llm.common import utf8
from bazarlake.operators.workdir import materialize

SHARDS = 40
ROW_OVERHEAD = 16
_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below
_NULL_KEY = 0x9E3779B97F4A7C15


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The published jump consistent hash (Lamping and Veach) for an array of 64-bit keys."""
    state = keys.astype(np.uint64)
    # Neighbouring ids differ in few bits: spread them first, one to one.
    state = (state ^ (state >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    state = (state ^ (state >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    state ^= state >> np.uint64(31)
    shard = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.float64)
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = ahead[moving]
        state[moving] = state[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        steps = float(1 << 31) / ((state[moving] >> np.uint64(33)).astype(np.float64) + 1)
        ahead[moving] = np.floor((shard[moving] + 1) * steps)
        moving = moving[ahead[moving] < shards]
    return shard


def shard_column(key: Column, shards: int) -> Column:
    @F.arrow_udf("int")
    def placed(keys: pa.Array) -> pa.Array:
        filled = keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64).copy()
        filled[keys.is_null().to_numpy(zero_copy_only=False)] = np.uint64(_NULL_KEY)
        return pa.array(jump(filled, shards), pa.int32())

    return placed(key.cast("bigint"))


def sharded(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, size, checksum of the text, law, shard, slot, and the shard if there were one more."""
    placed = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(utf8(text)) + ROW_OVERHEAD).cast("bigint").alias("size"),
        F.crc32(utf8(text)).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_column(F.col(doc_id), shards).alias("shard"),
        shard_column(F.col(doc_id), shards + 1).alias("grown_shard"),
    )
    rows = materialize(placed.withColumn("row", F.monotonically_increasing_id())).withColumn("slice", F.shiftright("row", _ROW_BITS))
    counts = rows.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    # One row per shard and slice, so a shard's window stays small.
    earlier = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("row")) - 1
    numbered = rows.withColumn("place", place).join(before, ["shard", "slice"])
    return numbered.select(
        "doc_id", "size", "text_crc32", "law", "shard", (F.col("before") + F.col("place")).cast("bigint").alias("slot"), "grown_shard"
    )


def bytes_per_shard(assigned: DataFrame) -> DataFrame:
    """Rows, bytes and rows that a further shard would take, per shard."""
    return assigned.groupBy("shard").agg(
        F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"), F.count_if(F.col("grown_shard") != F.col("shard")).alias("n_moving")
    )
