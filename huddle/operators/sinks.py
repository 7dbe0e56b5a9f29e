"""Sinks: partitioned/full overwrite, dynamic partition overwrite, Type-1 upsert,
views. A *target* is a catalog table name, or a path when it contains '/'.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from huddle.session import scratch_path

# the overwrite mode of insertInto is a setting of the session, which steps running side by side share
_SESSION_MODE = threading.RLock()
STORED_CODEC = "zstd"  # of path tables and lists (session.STORED_FACTOR)
KEY_SUFFIX = "_id"


def is_path(target: str) -> bool:
    return "/" in target or target.startswith(("file:", "s3", "gs:", "abfs", "hdfs:"))


def plain_keys(columns: list[str]) -> dict[str, str]:
    """Parquet options: no dictionary for key columns.

    Nearly every key of a file is another one, so a dictionary of them saves nothing; building one for each of the
    many files that a task has open takes half of the write's time. All other columns keep theirs.
    """
    return {f"parquet.enable.dictionary#{c}": "false" for c in columns}


def read_target(spark: SparkSession, target: str, fmt: str = "parquet", schema: str | None = None,
                known: StructType | None = None) -> DataFrame:
    """The stored table. A path table that holds no file yet is read with its declared ``schema``; one whose
    schema is ``known`` for certain (the caller has just written it) is read without a look into its files."""
    if not is_path(target):
        return spark.table(target)
    if known is not None and fmt == "parquet":
        return spark.read.schema(known).parquet(target)
    try:
        return spark.read.format(fmt).load(target)
    except AnalysisException as e:
        if schema and e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return spark.read.format(fmt).schema(schema).load(target)
        raise


def target_exists(spark: SparkSession, target: str, fmt: str = "parquet") -> bool:
    """Whether the table is there. Only a path that is not found means absent; any
    other failure (permissions, a damaged file, a store that cannot be reached) is
    raised, so that nothing is ever overwritten because it could not be read."""
    if not is_path(target):
        return spark.catalog.tableExists(target)
    finish_swap(spark, target)
    fs, path = _file_system(spark, target)
    return fs.exists(path(target))  # raises for any failure but a path that is not found


def _file_system(spark: SparkSession, path: str):
    """(file system, path constructor) of a path, through Spark's own Hadoop client."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def finish_swap(spark: SparkSession, target: str) -> None:
    """Put the previous version back if a swap broke off between its two renames."""
    fs, path = _file_system(spark, target)
    old = path(f"{target.rstrip('/')}__previous")
    if not fs.exists(path(target)) and fs.exists(old):
        fs.rename(old, path(target))


def swap_in(spark: SparkSession, version: str, target: str) -> None:
    """Make a completely written version the table: two renames, no row is written again.

    The old version stays beside the table until the new one is in place, and
    ``finish_swap`` restores it if the job dies in between.
    """
    fs, path = _file_system(spark, target)
    old = path(f"{target.rstrip('/')}__previous")
    fs.delete(old, True)
    if not fs.rename(path(target), old) or not fs.rename(path(version), path(target)):
        finish_swap(spark, target)
        raise OSError(f"{version} could not take the place of {target}")
    fs.delete(old, True)
    spark.catalog.refreshByPath(target)


def drop_partitions(spark: SparkSession, target: str, column: str, values: list) -> None:
    """Remove whole partitions: in the catalog, or by their folders. None names the NULL partition of a path table."""
    if not is_path(target):
        for v in values:
            if v is not None:
                spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({column} = DATE '{v}')")
        spark.catalog.refreshTable(target)
        return
    fs, path = _file_system(spark, target)
    for v in values:
        fs.delete(path(f"{target}/{column}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}"), True)
    spark.catalog.refreshByPath(target)


def write_table(df: DataFrame, target: str, *, partition_by: str | list[str] | None = None,
                mode: str = "overwrite", dynamic: bool = False, fmt: str = "parquet",
                spark: SparkSession | None = None, rebalance: bool = True) -> None:
    """Overwrite (or append to) a table, optionally partitioned.

    ``rebalance=False`` writes the rows from where they are: no shuffle, a file per task and partition it has rows of.

    ``dynamic=True`` replaces only the partitions present in ``df`` (the daily
    incremental mode); other partitions stay untouched.
    """
    parts = [partition_by] if isinstance(partition_by, str) else (partition_by or [])
    spark = spark or df.sparkSession
    if parts and rebalance:
        # one shuffle on the partition columns so each task writes few
        # partition folders; AQE packs small dates and splits a hot one
        df = df.hint("rebalance", *parts)
    if dynamic and parts and not is_path(target) and spark.catalog.tableExists(target):
        # insertInto takes the overwrite mode from the session, not the writer
        key = "spark.sql.sources.partitionOverwriteMode"
        with _SESSION_MODE:
            prev = spark.conf.get(key, "static")
            spark.conf.set(key, "dynamic")
            try:
                df.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
            finally:
                spark.conf.set(key, prev)
        return
    w = df.write.format(fmt).mode(mode)
    if parts:
        w = w.partitionBy(*parts)
    if is_path(target):
        if fmt == "parquet":
            keys = plain_keys([c for c in df.columns if c.endswith(KEY_SUFFIX) and c not in parts])
            w = w.options(compression=STORED_CODEC, **keys)
        if parts:
            # explicit per write: a full load must drop partitions absent from df
            w = w.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        w.save(target)
    else:
        # saveAsTable overwrite replaces the whole table; writer options would be
        # stored as table properties and pin later inserts, so none are given
        w.saveAsTable(target)


def write_partitioned(df: DataFrame, target: str, partition_col: str = "p_date",
                      dynamic: bool = False, fmt: str = "parquet") -> None:
    write_table(df, target, partition_by=partition_col, dynamic=dynamic, fmt=fmt)


def write_full(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    write_table(df, target, fmt=fmt)


class DuplicateSourceKeys(ValueError):
    pass


def check_unique(df: DataFrame, key: str) -> None:
    """Fail like MERGE does when several source rows match one target row."""
    dup = df.groupBy(key).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise DuplicateSourceKeys(f"source has duplicate values of {key}")


def upsert_frame(target: DataFrame, source: DataFrame, key: str,
                 created_col: str = "etl_created_date") -> DataFrame:
    """Type-1 merge as a DataFrame: matched keys take every source column except
    ``created_col`` (kept from the target); new keys are inserted; target rows
    without a source row stay as they are. No delete branch.

    One full outer join on the key: each side is shuffled once, and keys are
    unique on both sides, so no key is hot.
    """
    cols = target.columns
    t = target.select(*[F.col(c).alias(f"__t_{c}") for c in cols])
    s = source.select(*[F.col(c).alias(f"__s_{c}") for c in cols])
    j = t.join(s, F.col(f"__t_{key}") == F.col(f"__s_{key}"), "full")
    from_source = F.col(f"__s_{key}").isNotNull()
    out = []
    for c in cols:
        if c == created_col:
            v = F.when(from_source, F.coalesce(F.col(f"__t_{c}"), F.col(f"__s_{c}"))).otherwise(F.col(f"__t_{c}"))
        else:
            v = F.when(from_source, F.col(f"__s_{c}")).otherwise(F.col(f"__t_{c}"))
        out.append(v.alias(c))
    return j.select(*out)


def ddl(df: DataFrame) -> str:
    """The schema as a DDL string, for reads that must not infer one."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def merge_sql(target: str, source_view: str, columns: list[str], key: str, created_col: str) -> str:
    sets = ", ".join(f"t.{c} = s.{c}" for c in columns if c != created_col)
    return (f"MERGE INTO {target} t USING {source_view} s ON t.{key} = s.{key} "
            f"WHEN MATCHED THEN UPDATE SET {sets} "
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) "
            f"VALUES ({', '.join('s.' + c for c in columns)})")


def upsert(spark: SparkSession, source: DataFrame, target: str, key: str,
           created_col: str = "etl_created_date", fmt: str = "parquet",
           partition_by: str | None = None, unique: bool = False, gone: DataFrame | None = None) -> None:
    """MERGE INTO ... WHEN MATCHED UPDATE (all but created) WHEN NOT MATCHED INSERT.

    Keys of ``gone`` (a frame of the key column, none of them in the source) are deleted.

    Table formats with MERGE get MERGE; a plain file table gets the same result
    written once beside it and swapped in, so it is whole at every moment. Source
    keys are checked unless the caller knows that they are ``unique``.
    """
    if not unique:
        check_unique(source, key)
    if not target_exists(spark, target, fmt):
        write_table(source, target, partition_by=partition_by, fmt=fmt)
        return
    if fmt in ("delta", "iceberg") and not is_path(target):
        view = f"__upsert_src_{uuid.uuid4().hex}"
        source.createOrReplaceTempView(view)
        spark.sql(merge_sql(target, view, source.columns, key, created_col))
        if gone is not None:
            gone.select(key).createOrReplaceTempView(view)
            spark.sql(f"MERGE INTO {target} t USING {view} s ON t.{key} = s.{key} WHEN MATCHED THEN DELETE")
        return
    stored = read_target(spark, target, fmt, ddl(source))
    if gone is not None:
        stored = stored.join(gone.select(key), key, "left_anti").select(*stored.columns)
    merged = upsert_frame(stored, source, key, created_col)
    if is_path(target):
        version = f"{target.rstrip('/')}__next-{uuid.uuid4().hex[:12]}"
        write_table(merged, version, partition_by=partition_by, fmt=fmt)
        swap_in(spark, version, target)
        return
    stage = scratch_path(spark, "upsert-stage")
    write_table(merged, stage, partition_by=partition_by, fmt=fmt)
    staged = read_target(spark, stage, fmt, ddl(source))
    write_table(staged, target, partition_by=partition_by, fmt=fmt)


def create_view(spark: SparkSession, view: str, source: str, fmt: str = "parquet",
                temp: bool | None = None) -> None:
    """CREATE OR REPLACE [TEMP] VIEW view AS SELECT * FROM source.

    Path sources can only back temporary views.
    """
    src = f"{fmt}.`{source}`" if is_path(source) else source
    temp = is_path(source) if temp is None else temp
    kind = "TEMPORARY VIEW" if temp else "VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {view} AS SELECT * FROM {src}")
