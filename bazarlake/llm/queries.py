"""One query for each operator, over its whole table and with the parameters of production."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from bazarlake.llm import (
    alignment,
    byte_quality,
    cost_packing,
    line_dedup,
    matrix_packing,
    minhash,
    nn_descent,
    quality_rules,
    segmentation,
    sharding,
    spelling,
    token_counts,
    toxicity,
)
from bazarlake.llm.common import table
from bazarlake.llm.sql import SQL

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.report(table(spark, sf_dir, "documents"))


def op2_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cost_packing.packed(table(spark, sf_dir, "documents"), TOKENIZER, with_ids=False)


def op3_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.linked(table(spark, sf_dir, "embeddings"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measured(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op8_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentation.sampled(table(spark, sf_dir, "documents"), PIECES, with_ids=False)


def op9_matrix_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix_packing.packed(table(spark, sf_dir, "documents"), TOKENIZER)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"), TOKENIZER)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_byte_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_quality.scored(docs, byte_quality.fit(docs, table(spark, sf_dir, "labels")))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"), TOKENIZER, PIECES)


QUERIES = {f.__name__: f for f in (
    op1_minhash_near_dedup, op2_cost_packing, op3_nn_descent, op4_toxicity, op5_sharding, op6_quality_rules,
    op7_line_dedup, op8_segmentation, op9_matrix_packing, op10_token_counts,
    op11_spelling_variants, op12_byte_quality, op13_token_alignment,
)} | {"pipeline": corpus_pipeline.run}

ORACLE_SQL = dict(SQL) | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
