"""Sharding by proportional stratified interleaving (DataFrame functions only).

Rows are put in a seeded random order within their source; a row's fractional
rank is (rank - 1/2) / rows of the source. Ordered by that fraction, every
stretch of the table holds all sources in proportion, so cutting the order into
equal runs gives shards that match the mixture and differ by one row at most.

Scale: no rank is taken over a whole source or the whole table. Rows fall into
hash buckets (or buckets of the fraction, which are even by construction), are
ranked inside a bucket, and a prefix sum over the small table of bucket counts
turns that into the global rank. A source that holds a third of all rows
therefore still spreads over as many buckets as its size asks for. Texts are
never shuffled, only ids, sizes and checksums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from huddle.llm.common import hash60, id_key, source_key, stage_table

N_SHARDS = 40
SEED = 17
ROWS_PER_BUCKET = 4_000
MAX_BUCKETS = 1 << 17
LAW = "rows"


def global_rank(rows: DataFrame, strata: list[str], bucket: Column, order: list[str], out: str,
                count: str | None = None) -> DataFrame:
    """0-based rank of each row within ``strata`` by ``order``, where ``bucket`` is monotone in ``order``.

    Adds ``out`` and, on request, the number of rows of the stratum. Ties in
    ``order`` are rows that the caller holds interchangeable.
    """
    rows = rows.withColumn("__b", bucket)
    keys = [*strata, "__b"]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*strata).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("__n").over(Window.partitionBy(*strata))
    offsets = counts.select(*keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                            total.alias("__total"))
    inner = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    ranked = rows.withColumn("__in", inner).join(offsets, keys)
    cols = [c for c in rows.columns if c != "__b"]
    extra = [F.col("__total").alias(count)] if count else []
    return ranked.select(*cols, (F.col("__before") + F.col("__in")).cast("bigint").alias(out), *extra)


def _shard_keys(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), source_key(source_col).alias("__src"),
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32"),
        hash60(F.lit(seed), id_key(id_col, text_col)).alias("__h"))


def assign_shards(docs: DataFrame, n_shards: int = N_SHARDS, *, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", seed: int = SEED, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per input row.

    Law ``rows``: shard row counts differ by one at most; slot runs from 0 without
    gaps in each shard; grown_shard is null (it belongs to another law).

    Cases: a null or empty text has size 16 and checksum 0; a null source is a
    source of its own; rows with null ids are dealt by their text; repeated rows
    are separate rows, ordered by id, checksum and size (equal ones are
    interchangeable); with fewer rows than shards some shards are empty; an
    empty table gives an empty result. Extra columns are ignored.
    """
    total = docs.count()
    buckets = max(1, min(MAX_BUCKETS, -(-total // rows_per_bucket)))  # rows per bucket grow beyond that
    ties = ["doc_id", "text_crc32", "size"]
    rows = _shard_keys(docs, id_col, text_col, source_col, seed)
    in_source = F.floor(F.col("__h") * F.lit(buckets / 2.0 ** 60)).cast("int")
    ranked = global_rank(rows, ["__src"], in_source, ["__h", *ties], "__rank", count="__rows")
    ranked = ranked.withColumn("__f", (F.col("__rank") + F.lit(0.5)) / F.col("__rows")).drop("__rank", "__rows")
    ranked = stage_table(docs.sparkSession, ranked, "shard-ranks")  # read twice below: ids and numbers, no texts
    by_fraction = F.floor(F.col("__f") * F.lit(float(buckets))).cast("int")
    placed = global_rank(ranked, [], by_fraction, ["__f", "__src", "__h", *ties], "__pos")
    shard = F.expr(f"CAST(__pos * {n_shards} DIV {max(total, 1)} AS BIGINT)")
    first = F.expr(f"(__shard * {total} + {n_shards - 1}) DIV {n_shards}")
    return placed.withColumn("__shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), F.col("__shard").cast("int").alias("shard"),
        (F.col("__pos") - first).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
