"""As-of join by merged ordering, and validity intervals of a changing value.

Both sides are put into one ordering per key and the last value before a row is
carried forward: one shuffle by key, no range condition, no row multiplied. A key's
rows are sorted in one task, so keys should be fine (an event's member, not a country).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def as_of_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, values: list[str],
               ties: list[str]) -> DataFrame:
    """``left`` with ``values`` of the newest ``right`` row of its key at or before its time; null where there is none.

    Of right rows with one key and time the first by ``ties`` counts. Rows without a time on the right never
    count; left rows without one get nulls.
    """
    asked = left.withColumn("__row", F.struct(*left.columns)).select(
        *keys, F.col(left_time).alias("__at"), F.lit(1).alias("__side"), F.lit(None).cast("int").alias("__tie"), "__row",
        *[F.lit(None).cast(right.schema[v].dataType).alias(f"__{v}") for v in values], F.lit(False).alias("__has"))
    order = F.row_number().over(Window.partitionBy(*keys, right_time).orderBy(*ties))
    known = right.where(F.col(right_time).isNotNull()).withColumn("__tie", order).where(F.col("__tie") == 1).select(
        *keys, F.col(right_time).alias("__at"), F.lit(0).alias("__side"), "__tie",
        F.lit(None).cast(asked.schema["__row"].dataType).alias("__row"), *[F.col(v).alias(f"__{v}") for v in values],
        F.lit(True).alias("__has"))
    before = Window.partitionBy(*keys).orderBy(F.col("__at").asc_nulls_first(), "__side").rowsBetween(Window.unboundedPreceding, 0)
    state = F.when(F.col("__has"), F.struct(*[F.col(f"__{v}").alias(v) for v in values]))
    carried = asked.unionByName(known).withColumn("__state", F.last(state, ignorenulls=True).over(before))
    out = carried.where(F.col("__side") == 1)
    return out.select("__row.*", *[F.col(f"__state.{v}").alias(v) for v in values])


def intervals(rows: DataFrame, keys: list[str], time: str, values: list[str], ties: list[str]) -> DataFrame:
    """(keys, values, valid_from, valid_to): while each row of a key was the newest; valid_to is null for the last one.

    Of rows with one key and time the first by ``ties`` counts; rows without a time never do.
    """
    w = Window.partitionBy(*keys, time).orderBy(*ties)
    first = rows.where(F.col(time).isNotNull()).withColumn("__n", F.row_number().over(w)).where(F.col("__n") == 1)
    following = F.lead(time).over(Window.partitionBy(*keys).orderBy(time))
    return first.select(*keys, *values, F.col(time).alias("valid_from"), following.alias("valid_to"))
