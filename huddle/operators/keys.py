"""Key operators: survivor per key, FK existence flags, orphans, latest flag.

The survivor of a key is ``row_number() = 1``, which Spark plans as a group limit
on both sides of the shuffle: each task sends at most one row per key, so a key
that holds a large share of the rows never lands whole in one task, and every
column is carried once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F


@dataclass(frozen=True)
class Order:
    """One sort key: column, direction and NULL placement."""
    column: str
    asc: bool = True
    nulls_last: bool = True


def asc(c: str, nulls_last: bool = True) -> Order:
    return Order(c, True, nulls_last)


def desc(c: str, nulls_last: bool = True) -> Order:
    return Order(c, False, nulls_last)


def sort_columns(order: list[Order]) -> list[Column]:
    out = []
    for o in order:
        c = F.col(o.column)
        if o.asc:
            out.append(c.asc_nulls_last() if o.nulls_last else c.asc_nulls_first())
        else:
            out.append(c.desc_nulls_last() if o.nulls_last else c.desc_nulls_first())
    return out


def first_per_key(df: DataFrame, keys: list[str], order: list[Order]) -> DataFrame:
    """Exactly one row per key: the first in ``order``; remaining ties are broken
    by the whole row, so the survivor is repeatable. Column order is kept."""
    named = {o.column for o in order} | set(keys)
    ties = [asc(c) for c in df.columns if c not in named]
    w = Window.partitionBy(*keys).orderBy(*sort_columns(order + ties))
    return df.withColumn("__first", F.row_number().over(w)).where(F.col("__first") == 1).drop("__first")


def dedupe_by_key(df: DataFrame, key: str, order: list[Order] | None = None) -> DataFrame:
    """One row per primary key. Default survivor: all other columns ascending,
    NULLs last (identical rows are the only full ties)."""
    order = order or [asc(c) for c in df.columns if c != key]
    return first_per_key(df, [key], order)


def distinct_keys(df: DataFrame, key: str, alias: str | None = None) -> DataFrame:
    """Distinct non-NULL key list (the build side of an FK probe)."""
    c = F.col(key)
    return df.select(c.alias(alias or key)).where(c.isNotNull()).distinct()


def fk_flag(df: DataFrame, key: str, ref: DataFrame, ref_key: str, flag: str) -> DataFrame:
    """``flag`` = TRUE when ``df[key]`` exists in ``ref[ref_key]``, else FALSE (never NULL).

    The reference side is reduced to distinct keys first; the join is a plain
    left equi-join, so AQE broadcasts it only when its measured size is small and
    splits skewed probe-side partitions otherwise.
    """
    r = distinct_keys(ref, ref_key, "__ref_key")
    return (df.join(r, F.col(key) == F.col("__ref_key"), "left")
              .withColumn(flag, F.col("__ref_key").isNotNull())
              .drop("__ref_key"))


def orphans(df: DataFrame, key: str, ref: DataFrame, ref_key: str) -> DataFrame:
    """Rows of ``df`` whose key has no match in ``ref`` (NULL keys included)."""
    r = distinct_keys(ref, ref_key, "__ref_key")
    return df.join(r, F.col(key) == F.col("__ref_key"), "left_anti")


def latest_flag(df: DataFrame, group: list[str], order: list[Order], id_col: str,
                name: str = "is_latest_response", among: Column | None = None) -> DataFrame:
    """TRUE on the first row per group in ``order`` (then ``id_col`` ascending).

    The winner of a group is picked on the narrow order columns (a group limit on
    both sides of the shuffle, so no group is gathered whole) and joined back on
    the unique ``id_col``, by which the rows are usually partitioned already. Rows
    outside ``among`` never win and get FALSE.
    """
    cand = df if among is None else df.where(among)
    full = order + [asc(id_col)]
    narrow = cand.select(*dict.fromkeys([*group, *(o.column for o in full)]))
    winners = first_per_key(narrow, group, full).select(F.col(id_col).alias("__winner"))
    return (df.join(winners, F.col(id_col) == F.col("__winner"), "left")
              .withColumn(name, F.col("__winner").isNotNull())
              .drop("__winner"))


def rank_one(df: DataFrame, partition: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row per partition (``row_number() = 1``; planned as a
    WindowGroupLimit on both sides of the shuffle)."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")
