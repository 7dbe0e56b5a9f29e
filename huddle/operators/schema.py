"""Schema operators: cast to a declared schema, gate on an exact match, p_date."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _cast(c: Column, dtype: T.DataType) -> Column:
    # strings and TIMESTAMP_NTZ become TIMESTAMP through the session zone (UTC)
    return c.try_cast(dtype)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast every declared column (case-insensitive match, declared name kept);
    columns not in the schema pass through unchanged, in place.

    ``try_cast`` turns malformed values into NULL instead of failing the job
    under ANSI mode; ``cast_losses`` counts them.
    """
    declared = {f.name.lower(): f for f in schema.fields}
    cols = []
    for name in df.columns:
        f = declared.get(name.lower())
        cols.append(_cast(F.col(f"`{name}`"), f.dataType).alias(f.name) if f else F.col(f"`{name}`"))
    missing = [f.name for f in schema.fields if f.name.lower() not in {c.lower() for c in df.columns}]
    if missing:
        raise ValueError(f"missing declared columns: {missing}")
    return df.select(*cols)


def cast_losses(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: per declared column, values that were not NULL but failed the cast."""
    by_lower = {c.lower(): c for c in raw.columns}
    aggs = []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        if src is None:
            continue
        c = F.col(f"`{src}`")
        aggs.append(F.count_if(c.isNotNull() & _cast(c, f.dataType).isNull()).alias(f.name))
    return raw.agg(*aggs)


@dataclass(frozen=True)
class SchemaDiff:
    extra: tuple[str, ...]
    missing: tuple[str, ...]
    type_mismatch: tuple[str, ...]
    reordered: bool

    @property
    def ok(self) -> bool:
        return not (self.extra or self.missing or self.type_mismatch or self.reordered)

    def __str__(self) -> str:
        parts = []
        if self.extra:
            parts.append("extra: " + ", ".join(self.extra))
        if self.missing:
            parts.append("missing: " + ", ".join(self.missing))
        if self.type_mismatch:
            parts.append("type: " + ", ".join(self.type_mismatch))
        if self.reordered:
            parts.append("reordered")
        return "; ".join(parts)


def schema_diff(actual: T.StructType, expected: T.StructType) -> SchemaDiff:
    """Names compared case-insensitively; types and order must match exactly."""
    a = [(f.name.lower(), f.dataType) for f in actual.fields]
    e = [(f.name.lower(), f.dataType) for f in expected.fields]
    an, en = [n for n, _ in a], [n for n, _ in e]
    extra = tuple(n for n in an if n not in en)
    missing = tuple(n for n in en if n not in an)
    at, et = dict(a), dict(e)
    mismatch = tuple(n for n in en if n in at and at[n] != et[n])
    common_a = [n for n in an if n in en]
    common_e = [n for n in en if n in an]
    return SchemaDiff(extra, missing, mismatch, common_a != common_e)


class SchemaMismatch(ValueError):
    def __init__(self, entity: str, diff: SchemaDiff):
        super().__init__(f"schema mismatch for {entity}: {diff}")
        self.diff = diff


def gate(df: DataFrame, expected: T.StructType, entity: str = "input") -> DataFrame:
    """Raise with a readable diff unless ``df`` has exactly the declared schema."""
    d = schema_diff(df.schema, expected)
    if not d.ok:
        raise SchemaMismatch(entity, d)
    return df


def with_p_date(df: DataFrame, ts_col: str, name: str = "p_date") -> DataFrame:
    """Partition date of an entity: the calendar date of its timestamp (UTC)."""
    return df.withColumn(name, F.to_date(F.col(ts_col).cast("timestamp")))
