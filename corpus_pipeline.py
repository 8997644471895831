"""From raw documents to shards of a training mix, one operator a stage.

Quality rules drop what no language of the corpus resembles; of near duplicates (five-word
shingles, similarity 0.8) the least ``doc_id`` stays; documents that hold a benchmark item go;
the mix repeats or leaves out documents to meet its source targets, in training order; the
last stage gives every row a shard and a slot. Each stage works on all rows of the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierkit.llm import curriculum, decontaminate, near, quality, shards
from tierkit.llm.shared import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.filter_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.filter_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return curriculum.mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``shard`` and ``slot``, in place of columns of these names."""
    return shards.assign(docs, size=None, shard="shard", slot="slot")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Minwise trees and edit distances have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
