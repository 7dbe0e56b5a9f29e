"""The contract queries of the training-data operators: opN_<name>(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from huddle.session import ship_package


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from huddle.llm import quality
    return quality.quality_report(_docs(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op2_min_max_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from huddle.llm import dedup
    return dedup.near_duplicates(_docs(spark, sf_dir)).drop("text_key", "cid", "keeps_class")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from huddle.llm import secret_scan
    return secret_scan.scan_documents(_docs(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from huddle.llm import tokens
    return tokens.count_tokens(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from huddle.llm import mixing
    return mixing.mix_report(_docs(spark, sf_dir))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from huddle.llm import decontam
    return decontam.hit_report(_docs(spark, sf_dir), _table(spark, sf_dir, "benchmark")).drop("text_key")


def op7_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from huddle.llm import sharding
    return sharding.assign_shards(_docs(spark, sf_dir))


def op8_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from huddle.llm import rans
    from huddle.session import scratch_path
    return rans.round_trip(_docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"),
                           scratch_path(spark, "rans-files"), vocab=49_408)


def op9_vantage_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from huddle.llm import vptree
    vectors = _table(spark, sf_dir, "embeddings")
    return vptree.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op10_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    from huddle.llm import toxicity
    return toxicity.toxicity_report(_docs(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op11_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from huddle.llm import order_minhash
    return order_minhash.edit_report(_docs(spark, sf_dir))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from huddle.llm import variants
    return variants.variant_report(_docs(spark, sf_dir))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from huddle.llm import merkle
    return merkle.manifest(_docs(spark, sf_dir))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(ship_package(spark), sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _shipped(f) for k, f in globals().items() if k.startswith("op")}


def oracle_sql() -> dict[str, str]:
    from huddle.llm import oracle
    return oracle.ORACLES
