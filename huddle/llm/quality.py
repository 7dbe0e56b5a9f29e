"""Quality scores by nearest-neighbour voting in a latent-semantic space.

1. Terms: all words, hashed (short and longer ones into ranges of their own), the whole
   shapes of all words (as in ``Aa!!``), pairs of neighbouring shapes, and bins of a text's own ratios (distinct words, repeats of
   the previous word, short words, distinct lines, word length, size). Labels, language, source and id are never terms.
2. Inverse document frequencies come from all documents (one pass, one partial
   histogram of ``DIM`` numbers per task).
3. Up to ``MAX_LABELLED`` labelled rows (the documented bound of the fit; half of
   them of each class if there are that many, chosen by a hash of the id) give the
   latent-semantic axes: a truncated SVD of their weighted term matrix.
4. Broadcast: idf, axes and the labelled vectors, at most ``MAX_LABELLED`` x ``AXES``
   numbers. Every document is projected, and exact cosine products with all
   labelled vectors are taken in blocks of documents. The ``NEIGHBOURS`` nearest
   vote with their similarity, corrected for the classes' shares of the sample.

Scale: one pass for the frequencies, one for the scores, no shuffle of texts; all
driver work is on the bounded sample.
"""

from __future__ import annotations

import math
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from huddle.llm.common import Memo, batches, bounded_sample, held_out, text_bytes

# term buckets: short words, word shapes, pairs of shapes, longer words, bins of the text's ratios
WORD_DIM, SHAPES, PAIRS, LONG_DIM, BINS = 4096, 1024, 2900, 4096, 66
LONG_AT = WORD_DIM + SHAPES + PAIRS
BIN_DIM = LONG_AT + LONG_DIM
DIM = BIN_DIM + BINS
SHORT_WORD = 5  # bytes; longer words are an open class, whose collisions are kept off the short ones
AXES = 64
MAX_LABELLED = 6000
NEIGHBOURS = 25
BIN_WEIGHT = 4.0
SEED = 11

# letters of one case and digits become one character each; other ASCII characters stay
_SHAPE = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 0x80 else 48 if 48 <= c <= 57 else c for c in range(256))


def shapes(text: bytes) -> list[bytes]:
    """The shapes of a text's words: runs of letters and digits are cut to one."""
    out = text.translate(_SHAPE)
    for c in (b"a", b"A", b"0"):
        while c * 2 in out:
            out = out.replace(c * 2, c)
    return out.split()


class Terms:
    """Texts to sparse term vectors (bucket numbers and weights before idf); one per Python worker."""

    def __init__(self):
        self.words = Memo(lambda w: xxhash.xxh64_intdigest(w) % WORD_DIM if len(w) <= SHORT_WORD
                          else LONG_AT + xxhash.xxh64_intdigest(w) % LONG_DIM)
        self.shapes = Memo(lambda s: xxhash.xxh32_intdigest(s) % SHAPES)

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        words = text.lower().split()
        n = len(words)
        short = sum(len(w) <= SHORT_WORD for w in words)
        shape = np.fromiter(map(self.shapes.__getitem__, shapes(text)), np.int64, n)
        pair = WORD_DIM + SHAPES + (shape[:-1] * 31 + shape[1:]) % PAIRS
        ids, tf = np.unique(np.concatenate([np.fromiter(map(self.words.__getitem__, words), np.int64, n),
                                            WORD_DIM + shape, pair]), return_counts=True)
        lines = [x for x in text.split(b"\n") if x]
        again = sum(map(eq, words, islice(words, 1, None)))
        ratios = ((len(set(words)) / n if n else 0.0), (again / n if n else 0.0), (short / n if n else 0.0),
                  (len(set(lines)) / len(lines) if lines else 0.0), (min(1.0, len(text) / n / 20) if n else 0.0),
                  min(1.0, math.log1p(n) / 12))
        bins = np.array([BIN_DIM + 11 * i + int(10 * r) for i, r in enumerate(ratios)], np.int64)
        return np.concatenate([ids, bins]), np.concatenate([1.0 + np.log(tf), np.full(len(bins), BIN_WEIGHT)])


def weighted(terms: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and unit-length idf weights of one text."""
    ids, tf = terms
    w = tf * idf[ids]
    norm = np.sqrt((w * w).sum())
    return ids, w / norm if norm else w


def project(rows: list[tuple[np.ndarray, np.ndarray]], axes: np.ndarray) -> np.ndarray:
    """Unit latent vectors of weighted texts."""
    out = np.stack([w.astype(np.float32) @ axes[ids] for ids, w in rows]) if rows else np.zeros((0, axes.shape[1]), np.float32)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(norm > 0, norm, 1)


def latent_axes(rows: list[tuple[np.ndarray, np.ndarray]], k: int, seed: int = SEED) -> np.ndarray:
    """The leading right singular vectors of the sample's term matrix, by block power iteration."""
    x = np.zeros((len(rows), DIM), np.float32)
    for i, (ids, w) in enumerate(rows):
        np.add.at(x[i], ids, w.astype(np.float32))
    k = max(1, min(k, len(rows), DIM))
    q = np.random.default_rng(seed).standard_normal((DIM, min(DIM, k + 16))).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ vt.T)[:, :k].astype(np.float32)


def vote(cos: np.ndarray, labels: np.ndarray, class_weight: np.ndarray, prior: float, k: int = NEIGHBOURS) -> np.ndarray:
    """Similarity-weighted share of label 1 among the k nearest; the prior where nothing is similar."""
    k = min(k, cos.shape[1])
    near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
    w = np.maximum(np.take_along_axis(cos, near, 1), 0).astype(np.float64) ** 4 * class_weight[labels[near]]
    total = w.sum(axis=1)
    return np.where(total > 0, (w * (labels[near] == 1)).sum(axis=1) / np.where(total > 0, total, 1), prior)


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and the number of documents."""
    def run(it):
        terms, df, n = Terms(), np.zeros(DIM, np.int64), 0
        for b in batches(it, 1024):
            for t in b.column(0).to_pylist():
                df[terms(t)[0]] += 1
            n += b.num_rows
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([*used.tolist(), -1], pa.int32()), pa.array([*df[used].tolist(), n], pa.int64())],
                                         names=["term", "n"])

    rows = docs.select(F.coalesce(text_bytes(text_col), F.lit(b"")).alias("t")).mapInArrow(run, "term int, n bigint")
    df, total = np.zeros(DIM, np.int64), 0
    for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect():  # at most DIM + 1 rows
        if r["term"] < 0:
            total = r["n"]
        else:
            df[r["term"]] = r["n"]
    return df, total


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
        label_col: str = "quality", max_labelled: int = MAX_LABELLED, axes: int = AXES, seed: int = SEED) -> dict:
    """idf over all documents; axes, vectors and labels of the bounded labelled sample."""
    df, total = document_frequencies(docs, text_col)
    idf = np.log((1.0 + total) / (1.0 + df)) + 0.1
    sample, share = bounded_sample(docs, labels, id_col, text_col, label_id_col, label_col, max_labelled, seed)

    def run(it):
        terms = Terms()
        for b in batches(it, 1024):
            rows = [terms(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0].astype("<i4").tobytes() for r in rows], pa.binary()),
                 pa.array([r[1].astype("<f4").tobytes() for r in rows], pa.binary()), b.column(1), b.column(2)],
                names=["ids", "tf", "label", "h"])

    got = sample.mapInArrow(run, "ids binary, tf binary, label int, h bigint").toArrow().sort_by("h")
    rows = [weighted((np.frombuffer(i, "<i4").astype(np.int64), np.frombuffer(t, "<f4").astype(np.float64)), idf)
            for i, t in zip(got.column("ids").to_pylist(), got.column("tf").to_pylist())]
    labels_ = got.column("label").to_numpy()
    basis = latent_axes(rows, axes, seed) if rows else np.zeros((DIM, 1), np.float32)
    counts = np.array([(labels_ == 0).sum(), (labels_ == 1).sum()]) * share
    prior = float(counts[1] / counts.sum()) if counts.sum() else 0.5
    return {"idf": idf, "axes": basis, "vectors": project(rows, basis), "labels": labels_, "weight": share, "prior": prior}


def score_documents(docs: DataFrame, model: dict, *, id_col: str = "doc_id", text_col: str = "text",
                    neighbours: int = NEIGHBOURS, block: int = 256) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per input row.

    ``score`` is the weighted share of label 1 among the nearest labelled vectors.
    Cases: null and empty texts have only their ratio bins as terms and are scored
    by them; without labelled rows every score is 0.5; repeated rows score alike;
    null ids are not held out; an empty table gives an empty result. Extra columns
    are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.coalesce(text_bytes(text_col), F.lit(b"")).alias("t"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_LABELLED x AXES + DIM x (AXES + 1) numbers

    def run(it):
        m, terms = shared.value, Terms()
        for b in batches(it, block):
            if len(m["labels"]):
                near = project([weighted(terms(t), m["idf"]) for t in b.column(2).to_pylist()], m["axes"])
                p = vote(near @ m["vectors"].T, m["labels"], m["weight"], m["prior"], neighbours)
            else:
                p = np.full(b.num_rows, 0.5)
            p = np.clip(p, 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, fit(docs, labels))
