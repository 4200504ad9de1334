"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bazarlake.llm import cost_packing, line_dedup, minhash, quality_rules, toxicity
from bazarlake.llm.common import table
from bazarlake.operators.workdir import fresh_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.accepted(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity cut; the field is fitted on labelled documents of this stage."""
    return toxicity.clean_rows(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; a document that consists of nothing else stays, empty."""
    return line_dedup.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8."""
    return minhash.one_of_each(docs, width=5, percent=80)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their ids."""
    return cost_packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("toxicity", toxic),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("packing", packing),
]

#: A fitted model decides in the second stage and tokens come from a library: not expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the results between them are in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
