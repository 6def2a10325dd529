"""A training corpus from documents: quality rules, near-duplicates, benchmark decontamination, mixing by source, sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.decontaminate import clean_documents
from plumbline.llm.ngram_join import representatives
from plumbline.llm.oracles import PIPELINE
from plumbline.llm.quality_rules import kept_documents
from plumbline.llm.sharding import sharded
from plumbline.llm.shared import importable, staged, table
from plumbline.llm.source_mix import mixture


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the risk-controlled rules reject."""
    return kept_documents(docs, table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    return representatives(docs)


def uncontaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole repetitions of the documents, near the target weights of their sources."""
    return mixture(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return sharded(docs).select("doc_id", "size", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


STAGES = [
    ("quality_rules", good_documents),
    ("ngram_join", distinct_documents),
    ("decontamination", uncontaminated_documents),
    ("source_mix", mixed_documents),
    ("sharding", shards),
]

ORACLE_SQL = PIPELINE


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is written and read again."""
    importable(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
