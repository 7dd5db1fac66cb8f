"""The corpus pipeline: documents to shuffled shards of a training mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``documents``;
the last adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewharf.llm import decontamination, mixing, near_dedup, quality_rules, sharding
from tradewharf.llm.base import Scratch, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the adaptive ones of their language and source."""
    return quality_rules.filter_documents(docs)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    return near_dedup.filter_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: documents as often as their source's budget takes them."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot in the seeded shuffle."""
    return sharding.assign(docs)


STAGES = [
    ("quality rules", keep_good),
    ("near-duplicates", keep_one_copy),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Near-duplicate components cannot be expressed in reasonable SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage returned is dropped once the next has read it."""
    scratch = Scratch(spark, "pipeline")
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if last:
            scratch.drop(last)
        last = name.replace(" ", "-")
    return docs
