"""Queries of this subpackage and their statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tradewharf.llm import (
    chat, conversation_repair, decontamination, html_text, mixing, near_dedup, pii, quality_rules, sharding, site_quality,
    token_shards, vector_codes, warc,
)
from tradewharf.llm.base import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.report(table(spark, sf_dir, "pages"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.report(table(spark, sf_dir, "documents"))


def op9_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(table(spark, sf_dir, "conversations"))


def op11_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.report(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(table(spark, sf_dir, "conversations"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


OPERATORS = (
    op1_decontamination, op2_sharding, op3_quality_rules, op4_html_extraction, op5_warc, op6_pii_surrogates,
    op7_mixing, op8_near_dedup, op9_site_quality, op10_chat, op11_token_shards, op12_conversation_repair, op13_vector_codes,
    pipeline,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": decontamination.SQL,
        "op3_quality_rules": quality_rules.SQL,
        "op5_warc": warc.SQL,
        "op10_chat": chat.SQL,
        "op7_mixing": mixing.SQL,
        "op13_vector_codes": vector_codes.SQL,
    }
