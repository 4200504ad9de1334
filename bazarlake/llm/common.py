"""Small helpers that several of the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def utf8(text: str = "text") -> Column:
    """The text's bytes, empty for null; Python then need not decode it."""
    return text_or_empty(text).cast("binary")


def words_of(utf8_text: bytes) -> list[bytes]:
    """Lower-cased (A-Z only) words; on bytes, split() knows just the six ASCII white spaces."""
    return utf8_text.lower().split()


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: a lambda's variable is bound, not copied."""
    return F.element_at(F.transform(F.array(value), body), 1)


def row_of(docs: DataFrame) -> Column:
    """The whole row as one column, so that no helper column can clash with its names."""
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns])
