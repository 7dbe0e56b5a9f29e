"""Validation checks: per-check flags, their AND, and a readable error text.

One generic function replaces the per-table copies of the same idiom. Flags are
three-valued: NULL input makes a flag NULL, ``NULL AND FALSE`` is FALSE, and the
error text lists only checks that are definitely FALSE.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from huddle.config import ERROR_SEPARATOR


@dataclass(frozen=True)
class Check:
    flag: str
    condition: Column
    message: str


def apply_checks(df: DataFrame, checks: list[Check], drop: tuple[str, ...] = (),
                 valid_col: str = "is_valid_record", error_col: str = "validation_error") -> DataFrame:
    """Add one flag per check, ``is_valid_record`` (AND of all) and ``validation_error``."""
    df = df.withColumns({c.flag: c.condition for c in checks})
    if drop:
        df = df.drop(*drop)
    valid = reduce(lambda a, b: a & b, [F.col(c.flag) for c in checks])
    df = df.withColumn(valid_col, valid)
    text = F.concat_ws(ERROR_SEPARATOR, *[F.when(~F.col(c.flag), F.lit(c.message)) for c in checks])
    return df.withColumn(error_col, F.when(~F.col(valid_col), text))


def validity_bucket(valid_col: str = "is_valid_record") -> Column:
    """'valid', 'invalid' or 'undetermined' (NULL validity)."""
    v = F.col(valid_col)
    return F.when(v, "valid").when(~v, "invalid").otherwise("undetermined")
