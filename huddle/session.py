"""Session helpers: the settings every job relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings the jobs are written against. AQE re-plans joins from runtime sizes
# (broadcast only when a shuffle stage is measured small), splits skewed join
# partitions and coalesces small shuffle partitions.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# bytes of a file in Spark's default codec to those in the codec of stored tables, about
FILE_FACTOR, STORED_FACTOR = "spark.sql.sources.fileCompressionFactor", 1.6
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
# a join side whose shuffled partitions are all measured this small is hashed, so that neither side is sorted
HASH_SIDE, HASH_BYTES = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB"
# of whole texts or sets 10,000 rows are tens of MB, which the executor and its worker hold at once for every core
BATCH_BYTES, MOST_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def build_session(master: str | None = None, app: str = "huddle",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session for tests, benchmarks and local runs (UI off)."""
    b = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the jobs need on an existing session.

    Timestamps are UTC by contract, so the zone is pinned; the other settings
    are only raised where the session leaves them off.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        if spark.conf.get(k, "true") != "true":
            spark.conf.set(k, "true")
    # stored files are zstd: without this a scan looks smaller than it is and its rows are broadcast unmeasured
    if float(spark.conf.get(FILE_FACTOR, "1.0")) < STORED_FACTOR:
        spark.conf.set(FILE_FACTOR, str(STORED_FACTOR))
    # a task that writes several days keeps their files open in place of sorting (and spilling) its rows
    if int(spark.conf.get(OPEN_FILES, "0")) < 1:
        spark.conf.set(OPEN_FILES, "128")
    if spark.conf.get(HASH_SIDE, "0").rstrip("bB") == "0":
        spark.conf.set(HASH_SIDE, HASH_BYTES)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext  # not available on Spark Connect sessions
    except Exception:  # noqa: BLE001
        return None


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for staged tables and lineage cuts.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only a
    local-mode session without one gets a fresh temp folder (tests).
    """
    sc = _context(spark)
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None and sc.getCheckpointDir():
        d = os.path.dirname(sc.getCheckpointDir().rstrip("/"))
    if not d:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="huddle-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - core confs may be read-only at runtime
            pass
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/huddle/{name}-{uuid.uuid4().hex[:12]}"


def together(spark: SparkSession, *steps: Callable) -> list:
    """Run steps that do not depend on each other at the same time; their results in order.

    A daily run is some hundred small jobs whose time is mostly planning and scheduling, so jobs that wait for
    nothing are submitted side by side. All steps have ended when this returns or raises (the first error, in order).
    """
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        # wrapped one by one: each thread needs a copy of the local properties for itself
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [r.result() for r in running]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers, once per application, and bound the batches they are handed.

    Needed where the package is neither installed on the executors nor given with
    ``--py-files``: Spark's file server hands a zip of the sources to each of them.
    """
    spark.conf.set(BATCH_BYTES, str(MOST_BYTES))
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        import zipfile
        root = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="huddle-src-"), "huddle.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for n in sorted(names):
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.join("huddle", os.path.relpath(full, root)))
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)
    return spark
