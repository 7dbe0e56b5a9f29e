"""Secret scans over an incremental blob ledger.

Every version of every document is addressed by the SHA-256 of its text (its
blob). The ledger, a table in a shared folder, holds one row per scanned blob and
rule version with all findings. A run scans only blobs that the ledger lacks for
the current rule version, each once however many rows hold it, appends them, and
joins the findings back to all rows by blob.

Scale: the ledger is anti-joined on the blob id, so a daily run moves the new
texts only. Equal texts are combined before the shuffle (a group of copies that
holds a third of all rows leaves one text per task), and the join back is on
narrow rows, where adaptive execution splits a hot blob. An append is committed
whole or not at all; a rerun after a failure scans what is still missing.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from huddle.llm.common import batches
from huddle.session import scratch_path

RULES = "base-1"
# The rules
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
ASSIGN_HINTS = ("passw", "secret", "token", "api")
LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
_IS_HEX = bytes(120 if c in b"0123456789abcdef" else 32 for c in range(256))
_HEX_RUN = b"x" * MIN_HEX

FINDINGS = "blob string, rules string, n_assign bigint, n_access bigint, n_hex bigint, spans string"


def find_secrets(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every finding, in order; code points, end exclusive.

    Cheap tests for the words and character runs that a match needs come first;
    they never exclude a match.
    """
    found = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if _HEX_RUN in text.encode("utf-8", "surrogatepass").translate(_IS_HEX):
        # a run of hex digits is one match, so only runs of the least length need to be looked for
        found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def _scan(it):
    for b in batches(it):
        rows = [find_secrets(t) for t in b.column(2).to_pylist()]
        n = [pa.array([sum(k == want for _, k, _ in r) for r in rows], pa.int64()) for want in range(3)]
        spans = pa.array([",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in r) for r in rows], pa.string())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *n, spans],
                                         names=["blob", "rules", "n_assign", "n_access", "n_hex", "spans"])


def blobs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id and content address."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.sha2(text.cast("binary"), 256).alias("blob"), text.alias("text"))


def open_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger, created empty where there is none."""
    spark.createDataFrame([], FINDINGS).write.mode("ignore").parquet(ledger)
    return spark.read.schema(FINDINGS).parquet(ledger)


def scan_unseen(spark: SparkSession, versions: DataFrame, ledger: str, rules: str = RULES) -> None:
    """Scan the blobs that the ledger lacks for this rule version and append their findings."""
    known = open_ledger(spark, ledger).where(F.col("rules") == rules).select("blob")
    unseen = versions.select("blob", "text").join(known, "blob", "left_anti").dropDuplicates(["blob"])
    found = unseen.select("blob", F.lit(rules).alias("rules"), "text").mapInArrow(_scan, FINDINGS)
    found.write.mode("append").parquet(ledger)


def scan_documents(docs: DataFrame, *, ledger: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                   rules: str = RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, blob: one row per input row.

    ``ledger`` is the folder of the ledger table (a fresh one in the shared folder
    without it). Cases: a null text is an empty one; texts without findings have
    zero counts, empty spans and the hash of the empty string; repeated rows share
    a blob and get its findings each; an empty table gives an empty result. Extra
    columns are ignored.
    """
    spark = docs.sparkSession
    ledger = ledger or scratch_path(spark, "secret-ledger")
    versions = blobs(docs, id_col, text_col)
    scan_unseen(spark, versions, ledger, rules)
    # a rerun of a failed job, or two runs at once, may have written a blob twice
    known = open_ledger(spark, ledger).where(F.col("rules") == rules).drop("rules").dropDuplicates(["blob"])
    return versions.drop("text").join(known, "blob", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("spans").cast("binary"), 256).alias("base_sha256"),
        "spans", "blob")
