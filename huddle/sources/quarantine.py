"""CSV loads that lose no line: what cannot be read as declared goes to a second table.

A line is malformed when it has too few or too many fields, or when a value that is
not empty cannot be cast to its declared type. Malformed lines are kept with the reason
and the line itself: as delivered for a wrong field count, written out again from its
fields otherwise. ``line_account`` counts the files' lines independently of the parser,
so good rows plus quarantined ones can be held against what was delivered. Blank lines
and each file's header count as neither. A quoted field with a line break makes two
malformed lines, since files are split by line.

Tables: empty files give empty tables; NULLs and empty fields are good values; equal
lines are kept as often as they come.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from huddle import schemas
from huddle.operators import sinks
from huddle.operators.schema import gate, with_p_date
from huddle.sources.files import header_columns

CORRUPT = "__corrupt_line"
FIELDS = "field count"


def read_checked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Declared columns plus ``__reason`` (NULL: a good row) and ``__line`` (the malformed line).

    Header columns are matched by name without case; a missing declared column is an error, others are dropped.
    """
    names = header_columns(spark, path)
    by_lower = {n.lower(): n for n in names}
    missing = [f.name for f in schema.fields if f.name.lower() not in by_lower]
    if missing:
        raise ValueError(f"missing declared columns: {missing}")
    texts = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(CORRUPT, T.StringType())])
    # without column pruning, so that the field count is checked whichever columns a query reads
    df = (spark.read.schema(texts).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path))

    def source(f: T.StructField) -> Column:
        return F.col(f"`{by_lower[f.name.lower()]}`")
    lost = [F.when(source(f).isNotNull() & source(f).try_cast(f.dataType).isNull(), F.lit(f.name)) for f in schema.fields]
    bad_values = F.concat_ws(", ", *lost)
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit(FIELDS)).when(bad_values != "", F.concat(F.lit("value: "), bad_values))
    line = F.coalesce(F.col(CORRUPT), F.when(reason.isNotNull(), F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names]))))
    return df.select(*[source(f).try_cast(f.dataType).alias(f.name) for f in schema.fields],
                     reason.alias("__reason"), line.alias("__line"))


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("__reason").isNull()).drop("__reason", "__line")


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("__reason").isNotNull()).select(F.col("__reason").alias("reason"), F.col("__line").alias("line"))


def load_checked(spark: SparkSession, path: str, entity: str, target: str, quarantine: str, fmt: str = "parquet") -> None:
    """Load an entity's CSV into its p_date-partitioned raw table and its malformed lines into ``quarantine``.

    The load counts malformed lines as it goes; the files are read again for them only where there are some.
    Both tables are replaced; ``line_account`` over them tells whether every line arrived.
    """
    schema, _, ts_col, _ = schemas.ENTITIES[entity]
    checked = read_checked(spark, path, schema)
    seen = Observation()
    counted = checked.observe(seen, F.count_if(F.col("__reason").isNotNull()).alias("bad"))
    sinks.write_partitioned(with_p_date(gate(good_rows(counted), schema, entity), ts_col), target, "p_date", fmt=fmt)
    none = seen.get.get("bad") == 0
    sinks.write_full(spark.createDataFrame([], "reason string, line string") if none else quarantined(checked), quarantine, fmt)


def data_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row, ``lines``: the lines of all files that are not blank, less one header a file."""
    text = spark.read.text(path, recursiveFileLookup=True).where(F.trim("value") != "")
    files = text.groupBy(F.col("_metadata.file_path").alias("file")).agg((F.count(F.lit(1)) - 1).alias("n"))
    return files.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("lines"))


def line_account(spark: SparkSession, path: str, good: DataFrame, bad: DataFrame, entity: str) -> DataFrame:
    """One row: entity, lines, good, quarantined, balanced (every line is in one of the two tables)."""
    parts = [data_lines(spark, path).select("lines", F.lit(0).alias("good"), F.lit(0).alias("quarantined")),
             good.agg(F.count(F.lit(1)).alias("good")).select(F.lit(0).alias("lines"), "good", F.lit(0).alias("quarantined")),
             bad.agg(F.count(F.lit(1)).alias("quarantined")).select(F.lit(0).alias("lines"), F.lit(0).alias("good"), "quarantined")]
    total = reduce(DataFrame.unionByName, parts).agg(*[F.sum(c).cast("long").alias(c) for c in ("lines", "good", "quarantined")])
    return total.select(F.lit(entity).alias("entity"), "lines", "good", "quarantined",
                        (F.col("lines") == F.col("good") + F.col("quarantined")).alias("balanced"))
