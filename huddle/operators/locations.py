"""Key locations: which partitions of a table have ever held a key.

A stored table (key, p_date), bucketed by key. A day's keys are joined with it without
a shuffle of the stored side: only the day's keys move, to the buckets. The partitions
found are then the only ones of the big table that are read. A table without a list is
scanned on its key column, and gets a complete list with the next write.

The list may say too much and never too little: a location is added before the rows
are written, and one that a row has left stays until the next rebuild. Too much costs
a partition that is read for nothing; the keys themselves are always looked up there.

Scale: a row of the list is a key and a date. Additions are dealt to the buckets
before they are written, so each adds one file a bucket and day; ``rebuild`` (every
full load) puts the files together again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from huddle.operators.sinks import STORED_CODEC, plain_keys

BUCKETS_CONF, MOST_BUCKETS = "spark.huddle.locationBuckets", 64


def default_buckets(spark) -> int:
    """The set number, else as many as shuffle partitions, 64 at most. With another number a list is made anew."""
    return int(spark.conf.get(BUCKETS_CONF, None) or min(MOST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def composite(*cols: str) -> Column:
    """One text for several key columns; null is a value of its own, and no two keys share a text."""
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("~")) for c in cols]
    return F.concat(*parts)


class Locations:
    """The location list of one key of one table of a warehouse."""

    def __init__(self, wh, table: str, *key: str, buckets: int | None = None):
        buckets = buckets or default_buckets(wh.spark)
        self.wh, self.spark, self.key, self.buckets = wh, wh.spark, key, buckets
        name = f"locations_{table}_{'_'.join(key)}_{buckets}"
        if wh.root:  # a path warehouse: the files lie beside its tables, the name belongs to its folder
            self.path = wh.target("clean", name)
            self.name = f"{name}_{hashlib.sha256(self.path.encode()).hexdigest()[:12]}"
        else:
            self.path, self.name = None, wh.target("clean", name)

    def _create(self) -> None:
        place = f" LOCATION '{self.path}'" if self.path else ""
        options = ", ".join(f"'{k}' '{v}'" for k, v in ({"compression": STORED_CODEC} | plain_keys(["key"])).items())
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (key STRING, p_date DATE) USING parquet OPTIONS ({options}) "
                       f"CLUSTERED BY (key) INTO {self.buckets} BUCKETS{place}")

    def exists(self) -> bool:
        if not self.path:
            return self.spark.catalog.tableExists(self.name)
        from huddle.operators.sinks import target_exists
        return target_exists(self.spark, self.path)

    def _text(self) -> Column:
        return F.col(self.key[0]).cast("string") if len(self.key) == 1 else composite(*self.key)

    def places(self, rows: DataFrame) -> DataFrame:
        """The distinct (key, p_date) of rows, by bucket. Equal places meet in their bucket, so rows are moved once."""
        places = rows.select(self._text().alias("key"), "p_date").where(F.col("key").isNotNull())
        return places.repartition(self.buckets, "key").distinct()

    def _write(self, rows: DataFrame, overwrite: bool) -> None:
        self._create()
        self.places(rows).write.insertInto(self.name, overwrite=overwrite)
        self.spark.catalog.refreshTable(self.name)

    def add(self, rows: DataFrame, stored: DataFrame) -> None:
        """Record the partitions of rows about to be written; a first list also covers the ``stored`` rows."""
        if self.exists():
            self._write(rows, overwrite=False)
        else:
            self.rebuild(stored.select(*self.key, "p_date").unionByName(rows.select(*self.key, "p_date")))

    def rebuild(self, rows: DataFrame) -> None:
        """Replace the list by the locations of all rows of the table."""
        self._write(rows, overwrite=True)

    def find(self, keys: DataFrame) -> DataFrame:
        """The distinct partition dates that have held one of the keys (a frame with the key columns)."""
        self._create()
        wanted = keys.select(self._text().alias("key")).where(F.col("key").isNotNull())
        return self.spark.table(self.name).join(wanted, "key", "left_semi").select("p_date").distinct()


def held_on(locations: Locations, keys: DataFrame) -> list | None:
    """The partition dates on which one of the keys may be stored; None where there is no list."""
    return [r[0] for r in locations.find(keys).collect()] if locations.exists() else None  # at most one row per day of data


def find_or_scan(locations: Locations, stored: DataFrame, keys: DataFrame) -> Column | None:
    """A condition on ``p_date`` that holds wherever one of the keys may be stored; None where there is no list."""
    from huddle.sources.catalog import on_dates
    dates = held_on(locations, keys)
    return None if dates is None else on_dates(dates)
