"""Corpus pipeline: toxicity, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All stages but the last return the columns of documents; the last one
returns the shard and slot of every row of the mix.

Cases, by stage: the operators' docstrings say what becomes of null and empty
texts, null ids, ties and repeated rows; an empty table runs through and gives an
empty result; extra columns of documents are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from huddle.llm import decontam, dedup, mixing, sharding, toxicity
from huddle.llm.common import stage_table
from huddle.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on the labels, does not reject."""
    ship_package(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.reject_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    ship_package(spark)
    return dedup.keep_one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    ship_package(spark)
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is drawn for its source's target, laid out shard by shard in shuffled order."""
    return mixing.mix_documents(docs, positions=False, layout=True)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return sharding.assign_shards(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The classifier has no SQL form. Tests hold the other stages against brute-force versions, the classifier's against its scores and labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage_table(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
