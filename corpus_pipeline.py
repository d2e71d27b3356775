"""The corpus pipeline: language identification, near-duplicates, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes each result as Parquet below
spark.checkpoint.dir and hands the next stage what it reads back. All stages but the last return the columns of
``documents``. Tables without rows pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vecloom.llm import decontaminate, langid, mixing, near_dedup, sharding
from vecloom.llm.staging import in_small_batches, staged, table
from vecloom.session import ship_package


@in_small_batches
def language_identification(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of which no language is likelier than all others together, go."""
    ship_package(spark)
    return langid.keep_identified(docs, langid.fit(docs))


@in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the document with the smallest doc_id stays."""
    ship_package(spark)
    return near_dedup.keep_one_of_each(docs)


@in_small_batches
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark windows go."""
    return decontaminate.remove_contaminated(docs, table(ship_package(spark), sf_dir, "benchmark"))


@in_small_batches
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out, or stand up to three times, so that sources reach their target weights."""
    ship_package(spark)
    return mixing.mix(docs)


@in_small_batches
def sharding_in_random_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its shard and its slot in the shard."""
    ship_package(spark)
    return sharding.shard_documents(docs)


STAGES = [
    ("language identification", language_identification),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mixing", source_mixing),
    ("sharding", sharding_in_random_order),
]

#: Language models, and the order numpy's generator gives, have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ship_package(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
