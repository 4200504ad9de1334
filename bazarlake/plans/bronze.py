"""Raw text plus lineage; nothing is cleaned, filled or removed here."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazarlake.functions.lineage import record_hash, with_bronze_lineage
from bazarlake.operators.keys import only_in
from bazarlake.sources.feeds import FEEDS, Feed
from bazarlake.sources.files import read_csv_text, write_table, written_row_count


def stamped(df: DataFrame, feed: Feed, run_id: str, run_ts: datetime | None = None) -> DataFrame:
    """A feed with source file, load time, run id and content hash."""
    marked = with_bronze_lineage(df, feed.file, run_id, run_ts)
    return marked.withColumn("record_hash", record_hash(feed.columns))


def ingest_bronze(
    spark: SparkSession, csv_path: str, feed: Feed, root: str, run_id: str, run_ts: datetime | None = None
) -> DataFrame:
    """Load one CSV into its bronze table; returns table name and rows written."""
    raw = read_csv_text(spark, csv_path, feed)
    write_table(stamped(raw, feed, run_id, run_ts), root, feed.table)
    return written_row_count(spark, root, feed.table)


def source_counts(bronze: dict[str, DataFrame]) -> DataFrame:
    """Rows per source file over all bronze tables."""
    parts = [df.groupBy("source_file").agg(F.count("*").alias("row_count")) for df in bronze.values()]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts


def expected_files(spark: SparkSession) -> DataFrame:
    """The manifest: nine rows, one per feed."""
    return spark.createDataFrame([(feed.file,) for feed in FEEDS.values()], "source_file string")


def manifest_gate(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Every expected or found source with its rows and ``present``, ``missing`` or ``extra``.

    A source without any row counts as missing.
    """
    present = expected.join(found, "source_file").withColumn("status", F.lit("present"))
    missing = only_in(expected, found, ["source_file"]).select(
        "source_file", F.lit(0).cast("bigint").alias("row_count"), F.lit("missing").alias("status")
    )
    extra = only_in(found, expected, ["source_file"]).withColumn("status", F.lit("extra"))
    return present.unionByName(missing).unionByName(extra)


def require_complete(gate: DataFrame) -> None:
    """Stop if a required source is missing, and name all of them: at most the manifest's rows."""
    missing = gate.filter("status = 'missing'").select("source_file").orderBy("source_file").collect()
    if missing:
        raise ValueError(f"{len(missing)} missing sources: " + ", ".join(row.source_file for row in missing))
