"""JDBC sources: a projected full scan and a date-range incremental scan.

The projected query is passed as a table expression. Every read is split into parallel range queries, by the days of
an incremental scan or by a named column and its bounds.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, types as T


def select_sql(table: str, schema: T.StructType, date_column: str | None = None,
               start: str | None = None, end: str | None = None) -> str:
    cols = ", ".join(f.name for f in schema.fields)
    sql = f"SELECT {cols} FROM {table}"
    if date_column and start and end:
        # half-open range on the raw column keeps an index on it usable
        end_excl = (dt.date.fromisoformat(end) + dt.timedelta(days=1)).isoformat()
        sql += f" WHERE {date_column} >= '{start}' AND {date_column} < '{end_excl}'"
    return sql


def jdbc_options(url: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetchsize: int = 10_000) -> dict[str, str]:
    opts = {"url": url, "fetchsize": str(fetchsize)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    return opts


def split_options(date_column: str | None, start: str | None, end: str | None, partition_column: str | None,
                  lower: int | str | None, upper: int | str | None, num_partitions: int | None) -> dict[str, str]:
    """Spark's options for a read in parallel ranges; refuses a read through one connection."""
    if partition_column is None and date_column and start and end:
        days = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1
        partition_column, lower = date_column, start
        upper = (dt.date.fromisoformat(end) + dt.timedelta(days=1)).isoformat()
        num_partitions = num_partitions or min(days, 64)
    if partition_column is None or lower is None or upper is None:
        raise ValueError("a full scan needs partition_column, lower and upper to be read in parallel")
    return {"partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(num_partitions or 8)}


def read_jdbc(spark: SparkSession, options: dict[str, str], table: str, schema: T.StructType,
              date_column: str | None = None, start: str | None = None, end: str | None = None,
              partition_column: str | None = None, lower: int | str | None = None,
              upper: int | str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Full scan (no dates) or incremental scan (inclusive [start, end] days).

    A full scan has to name a numeric or date column and its bounds, so that it is
    read in parallel ranges; an incremental scan is split by its days.
    """
    sql = select_sql(table, schema, date_column, start, end)
    r = spark.read.format("jdbc").options(**options)
    split = split_options(date_column, start, end, partition_column, lower, upper, num_partitions)
    # partitioned reads need a table expression rather than ``query``
    return r.options(dbtable=f"({sql}) q", **split).load()
