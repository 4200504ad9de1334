"""CSV and table scans, and the overwriting sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazarlake.sources.feeds import Feed


def read_csv_text(spark: SparkSession, path: str, feed: Feed, multiline: bool = False) -> DataFrame:
    """CSV with a header, every column as text.

    The declared schema saves a pass over the data. Without ``multiline`` a file is split among
    tasks, and a quoted line break ends the row, as in a plain CSV scan.
    """
    return spark.read.csv(
        path,
        schema=feed.schema,
        header=True,
        encoding="UTF-8",
        enforceSchema=False,
        multiLine=multiline,
    )


# Reasons for which a line is no record of the feed, and the columns that carry line and reason.
UNBALANCED_QUOTES, TOO_FEW_FIELDS, TOO_MANY_FIELDS = "unbalanced quotes", "too few fields", "too many fields"
SOURCE_TEXT, REJECT_REASON = "source_text", "reject_reason"
_QUOTED = r'"(?:[^"\\]|\\.|"")*"'


def _reason(text: Column, expected: int) -> Column:
    """Why a raw record does not have the expected fields; NULL if it does."""
    bare = F.regexp_replace(text, _QUOTED, "q")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return (
        F.when(F.contains(F.regexp_replace(bare, r"[^,\"]+\"", ""), F.lit('"')), UNBALANCED_QUOTES)
        .when(fields < expected, TOO_FEW_FIELDS)
        .when(fields > expected, TOO_MANY_FIELDS)
    )


def read_csv_checked(spark: SparkSession, path: str, feed: Feed, multiline: bool = False) -> DataFrame:
    """Every record of a CSV with a header: the feed's columns, the raw text and a reject reason.

    A record is rejected if its quotes do not close, or if it has more or fewer fields than the
    feed; its raw text is kept and its columns are what the parser made of it. No record is lost:
    lines that are empty, which the CSV scan skips too, and the header are the only others. Without
    ``multiline`` a record is a line, files are split among tasks, and a quoted line break leaves
    two rejected pieces; with it, a file is read by one task and such a record is whole.
    """
    schema = f"{feed.schema.simpleString()[7:-1].replace(':', ' ')}, {SOURCE_TEXT} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": SOURCE_TEXT, "columnPruning": "false"}
    if multiline:
        rows = spark.read.csv(path, schema=schema, header=True, encoding="UTF-8", enforceSchema=False, multiLine=True, **_known(options))
        reason = F.coalesce(_reason(F.col(SOURCE_TEXT), len(feed.columns)), F.lit(UNBALANCED_QUOTES))
        return rows.withColumn(REJECT_REASON, F.when(F.col(SOURCE_TEXT).isNotNull(), reason))
    line = F.regexp_replace("value", "^\uFEFF|\r$", "")
    lines = spark.read.text(path).select(line.alias("value")).filter((F.col("value") != "") & (F.col("value") != ",".join(feed.columns)))
    parsed = lines.select(F.from_csv("value", schema, {k: v for k, v in options.items() if k != "columnPruning"}).alias("r"), "value")
    reason = F.coalesce(
        _reason(F.col("value"), len(feed.columns)),
        F.when(F.col(f"r.{SOURCE_TEXT}").isNotNull(), UNBALANCED_QUOTES),
    )
    return parsed.select(*[F.col(f"r.{c}").alias(c) for c in feed.columns], F.col("value").alias(SOURCE_TEXT), reason.alias(REJECT_REASON))


def _known(options: dict[str, str]) -> dict[str, str]:
    """The options that ``csv`` takes by name."""
    return {k: v for k, v in options.items() if k in ("mode", "columnNameOfCorruptRecord")}


def write_csv_text(df: DataFrame, path: str) -> None:
    """Text columns as CSV, outer blanks kept."""
    df.write.csv(
        path, mode="overwrite", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


# Content hashes are hexadecimal text and most of a bronze table: this codec halves them, Spark's default does not.
COMPRESSION = "zstd"


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def write_table(df: DataFrame, root: str, table: str) -> None:
    """Replace the data and the schema of a table kept as parquet under ``root``."""
    df.write.mode("overwrite").parquet(table_path(root, table), compression=COMPRESSION)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(root, table))


def save_managed(df: DataFrame, name: str) -> None:
    """Replace a managed table of the session's catalog, schema included."""
    df.write.mode("overwrite").saveAsTable(name)


def written_row_count(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of a written table, from its files and not from the plan that made it."""
    return read_table(spark, root, table).agg(F.count("*").alias("row_count")).select(
        F.lit(table).alias("table_name"), "row_count"
    )
