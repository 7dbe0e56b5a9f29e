"""Global order without a task that sees all rows: ranges of a composite key.

``bounds`` cuts the rows into ranges of nearly equal row counts (Spark's range
partitioning finds them, ``RANGE_PARTS`` at most); ``range_of`` finds a row's range
by binary search, an expression of the scan. Ranks and neighbours are then taken
inside a range, and a prefix sum over the small table of ranges makes ranks global.
The key should hold all columns that tell rows apart: a hot first column is then
split like any other. Nulls come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

RANGE_PARTS = 4_096  # ranges at most; beyond ROWS_PER_RANGE * RANGE_PARTS rows a range grows
ROWS_PER_RANGE = 8_000


def bounds(rows: DataFrame, key: list[str], parts: int | None = None) -> list:
    """The smallest key of every range after the first: at most ``RANGE_PARTS`` - 1 of them, ascending.

    Each bound is the key of an existing row. The list is bounded, so it may travel in the plan.
    """
    keys = rows.select(*key)
    parts = parts or max(1, min(RANGE_PARTS, -(-keys.count() // ROWS_PER_RANGE)))
    if parts == 1:
        return []
    heads = (keys.repartitionByRange(parts, *key).groupBy(F.spark_partition_id().alias("p"))
             .agg(F.min(F.struct(*key)).alias("head")).orderBy("p"))
    return [r["head"] for r in heads.collect()][1:]


def bounds_column(rows: DataFrame, key: list[str], cuts: list) -> Column:
    """The bounds as a literal array of structs of the key's types."""
    types = dict(rows.dtypes)
    structs = [F.struct(*[F.lit(c[k]).cast(types[k]).alias(k) for k in key]) for c in cuts]
    return F.array(*structs)


def range_of(rows: DataFrame, key: list[str], cuts: list) -> Column:
    """The number of bounds at or below a row's key, from 0 to len(cuts), by binary search."""
    if not cuts:
        return F.lit(0)
    at, own, steps = bounds_column(rows, key, cuts), F.struct(*key), len(cuts).bit_length()

    def step(found: Column, s: Column) -> Column:
        tried = found + s
        return F.when((tried <= len(cuts)) & (F.get(at, tried - 1) <= own), tried).otherwise(found)
    return F.aggregate(F.array(*[F.lit(1 << b) for b in reversed(range(steps))]), F.lit(0), step)


def positions(rows: DataFrame, key: list[str], out: str) -> DataFrame:
    """0-based rank of every row by ``key``. Rows with equal keys are interchangeable to the caller."""
    cuts = bounds(rows, key)
    ranged = rows.withColumn("__range", range_of(rows, key, cuts))
    sizes = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    # at most RANGE_PARTS rows in this window
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*key)) - 1
    placed = ranged.withColumn("__in", inside).join(F.broadcast(sizes.select("__range", before.alias("__before"))), "__range")
    return placed.select(*rows.columns, (F.col("__before") + F.col("__in")).cast("bigint").alias(out))
