"""Benchmark decontamination by winnowing.

Of the 6-word hashes in every run of five (that is, in every window of ten words)
the smallest is the window's fingerprint. Two equal windows have equal
fingerprints, so every shared span of ten words is guaranteed to meet.

1. The benchmark's windows give fingerprints and exact 128-bit window hashes. The
   fingerprints are also folded into a bitmap of fixed size.
2. Every document is cut into words and its windows' fingerprints are looked up in
   the bitmap; only windows that hit it leave the task, as rows (row, start,
   fingerprint, window hash). Their number follows the contaminated text, not the corpus.
3. Those rows join the benchmark's distinct windows on the fingerprint and, to
   extend the hit over the whole window, on the exact hash. Overlapping windows of
   a document are united to count its hit words; items are joined per distinct window.

Items of one to nine words are one window of their own length, with its whole hash
as fingerprint. The bitmap only spares work: with a larger benchmark it lets more
rows through and the join still decides, so the plan has no size switch. A window
that very many documents share is one benchmark row against many document rows,
which adaptive execution splits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from huddle.llm.common import (SlotFilter, WORD_BYTES, batches, gram_hashes, hash_memo, hash_words, row_hashes,
                               slot_filter, stage_table, text_bytes, text_key)

WINDOW = 10
GRAM = 6


def word_hashes(text: bytes, memo) -> np.ndarray:
    return hash_words(text.translate(WORD_BYTES).split(), memo)


def fingerprints(words: np.ndarray, window: int) -> np.ndarray:
    """The fingerprint of each run of ``window`` words: its smallest 6-word hash, or for short
    windows the hash of all its words."""
    if window < WINDOW:
        return gram_hashes(words, window, seed=100 + window)
    grams = gram_hashes(words, GRAM)
    n = len(grams) - (window - GRAM)
    if n <= 0:
        return np.empty(0, np.uint64)
    low = grams[:n]
    for j in range(1, window - GRAM + 1):
        low = np.minimum(low, grams[j:j + n])
    return low


def window_hash(words: np.ndarray, starts: np.ndarray, window: int) -> list[bytes]:
    """128-bit hashes of the windows at ``starts``."""
    if not len(starts):
        return []
    pieces = words[starts[:, None] + np.arange(window)]
    both = np.stack([row_hashes(pieces, 201), row_hashes(pieces, 302)], axis=1)
    return [r.tobytes() for r in both]


def item_windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_id, len, fp, win: every window of every item."""
    rows = items.select(F.col(id_col).alias("item_id"), F.coalesce(text_bytes(text_col), F.lit(b"")).alias("t"))

    def run(it):
        memo = hash_memo()
        for b in batches(it, 256):
            ids, lens, fps, wins = [], [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = word_hashes(t, memo)
                k = min(WINDOW, len(w))
                if not k:
                    continue
                fp = fingerprints(w, k)
                ids += [i] * len(fp)
                lens += [k] * len(fp)
                fps.append(fp)
                wins += window_hash(w, np.arange(len(fp)), k)
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, b.schema.field(0).type), pa.array(lens, pa.int32()), pa.array(np.concatenate(fps).view(np.int64)),
                     pa.array(wins, pa.binary())], names=["item_id", "len", "fp", "win"])

    return rows.mapInArrow(run, f"item_id {rows.schema['item_id'].dataType.simpleString()}, len int, fp bigint, win binary")


def document_windows(docs: DataFrame, id_col: str, text_col: str, bitmap: bytes, lengths: list[int]) -> DataFrame:
    """One row per document: row_id, doc_id, n_words and the windows that pass the bitmap."""
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).alias("doc_id"),
                       F.coalesce(text_bytes(text_col), F.lit(b"")).alias("t"), text_key(text_col).alias("text_key"))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)  # 2^20 bytes
    hit_type = pa.list_(pa.struct([("start", pa.int32()), ("len", pa.int32()), ("fp", pa.int64()), ("win", pa.binary())]))

    def run(it):
        memo, passes = hash_memo(), SlotFilter(shared.value)
        for b in batches(it, 1024):
            n, hits = [], []
            for t in b.column(2).to_pylist():
                w = word_hashes(t, memo)
                n.append(len(w))
                found = []
                for k in lengths:
                    fp = fingerprints(w, k)
                    at = np.flatnonzero(passes(fp))
                    if len(at):
                        found += [{"start": s, "len": k, "fp": f, "win": h} for s, f, h in
                                  zip(at.tolist(), fp[at].view(np.int64).tolist(), window_hash(w, at, k))]
                hits.append(found or None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array(n, pa.int64()), pa.array(hits, hit_type)],
                                             names=["row_id", "doc_id", "text_key", "n_words", "hits"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"row_id bigint, doc_id {id_type}, text_key string, n_words bigint, "
                                "hits array<struct<start:int,len:int,fp:bigint,win:binary>>")


def hit_report(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: one row per input row.

    Cases: null and empty texts have no words and no hits; items without words match
    nothing; repeated items count by distinct item id, and a null item id is not
    counted; repeated rows and null document ids are rows of their own; an empty
    benchmark leaves all documents clean; an empty table gives an empty result.
    Texts of any length are compared whole. Extra columns are ignored.
    """
    spark = docs.sparkSession
    windows = stage_table(spark, item_windows(benchmark, item_id_col, item_text_col), "benchmark-windows")
    bitmap = slot_filter(windows, "fp")
    lengths = sorted(r["len"] for r in windows.select("len").distinct().collect())  # at most ten
    # staged: the windows are read twice below and row ids must stay the same
    found = stage_table(spark, document_windows(docs, id_col, text_col, bitmap, lengths), "document-windows")
    cand = found.where("hits IS NOT NULL").select("row_id", F.explode("hits").alias("h")).select("row_id", "h.*")
    distinct = windows.groupBy("len", "fp", "win").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    real = cand.join(distinct, ["len", "fp", "win"])
    spans = real.groupBy("row_id").agg(
        F.array_sort(F.collect_list(F.struct("start", "len"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    union = F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")), lambda acc, s: F.struct(
        F.greatest(acc["end"], s["start"] + s["len"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), s["start"] + s["len"] - F.greatest(acc["end"], s["start"]))).cast("bigint").alias("n")))
    hits = spans.select("row_id", union["n"].alias("n_hit"), "items")
    none = F.array().cast("array<string>")
    items = F.coalesce("items", none)
    return found.drop("hits").join(hits, "row_id", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), "text_key")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents without a benchmark window, with all their columns."""
    report = hit_report(docs, benchmark, id_col=id_col, text_col=text_col, item_id_col=item_id_col, item_text_col=item_text_col)
    bad = report.where("contaminated").select(F.col("text_key").alias("__key")).distinct()
    keyed = docs.select(F.struct("*").alias("__row"), text_key(text_col).alias("__key"))
    return keyed.join(bad, "__key", "left_anti").select("__row.*")
