"""Content hash and the columns that say where a row comes from."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BRONZE_LINEAGE = ("source_file", "ingestion_timestamp_utc", "pipeline_run_id", "record_hash")
SILVER_LINEAGE = ("silver_pipeline_run_id", "silver_processed_timestamp_utc")
GOLD_LINEAGE = ("gold_pipeline_run_id", "gold_processed_timestamp_utc")
LAYER_LINEAGE = {"bronze": BRONZE_LINEAGE, "silver": SILVER_LINEAGE, "gold": GOLD_LINEAGE}

# Fixed values of the content hash.
HASH_SEPARATOR = "||"
HASH_NULL = "∅"


def joined_hash(columns: Sequence[Column]) -> Column:
    """SHA-256 in hexadecimal of the columns joined by the separator."""
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *columns), 256)


def record_hash(names: Sequence[str]) -> Column:
    """Hash of a row's text; a traceability mark, not a key (two rows may share a text)."""
    return joined_hash([F.nvl(F.col(n).cast("string"), F.lit(HASH_NULL)) for n in names])


def _stamp(run_ts: datetime | None) -> Column:
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def with_bronze_lineage(
    df: DataFrame, source_file: str, run_id: str, run_ts: datetime | None = None
) -> DataFrame:
    return df.withColumns(
        {
            "source_file": F.lit(source_file),
            "ingestion_timestamp_utc": _stamp(run_ts),
            "pipeline_run_id": F.lit(run_id),
        }
    )


def _with_layer_lineage(
    df: DataFrame, names: tuple[str, str], run_id: str, run_ts: datetime | None
) -> DataFrame:
    run_column, time_column = names
    return df.withColumns({run_column: F.lit(run_id), time_column: _stamp(run_ts)})


def with_silver_lineage(df: DataFrame, run_id: str, run_ts: datetime | None = None) -> DataFrame:
    return _with_layer_lineage(df, SILVER_LINEAGE, run_id, run_ts)


def with_gold_lineage(df: DataFrame, run_id: str, run_ts: datetime | None = None) -> DataFrame:
    return _with_layer_lineage(df, GOLD_LINEAGE, run_id, run_ts)
