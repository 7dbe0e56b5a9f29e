"""Toxicity by a classifier chain.

Categories, predicted in this order: ``dense`` (a toxic text whose rate of
indicator words is at or above the median of toxic texts), ``repeated`` (a toxic
text with three indicator words or more) and ``toxic`` (the label). The labels
table has one toxic flag; the first two categories are derived from it and from
the indicators learned below.

1. Up to ``MAX_LABELLED`` labelled rows, half of them toxic if there are so many,
   are taken by a hash of the id (the documented bound of the fit), from rows whose
   crc32(id) mod 3 is not 1; the rest is held out.
2. Terms are words and word beginnings of 4 to 8 bytes. Their document counts in
   toxic and clean rows of the sample are summed in Spark, by fold. Every term that is
   more frequent in toxic rows with a chi-square of ``SIGNIFICANT`` is kept: no number
   of terms is fixed, the list grows with the lexicon and is bounded by the sample.
3. One ridge logistic model per category, on sparse rows. The model of a category sees
   the terms and the probabilities of all earlier categories; for training those are
   out-of-fold predictions (``FOLDS`` folds by hash). A fold's models use the terms, the
   indicators and the derived categories of the other folds alone, so a later model
   learns from earlier outputs as unsure as they will be on new texts.
4. Scoring is one pass over all documents with the term list and three weight
   vectors; row by row, whole texts, no shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from huddle.llm.common import (HASH_ENTRIES, WORD_BYTES, Memo, batches, bounded_sample, held_out, stage_table, text_bytes)

CATEGORIES = ("dense", "repeated", "toxic")
PREFIXES = (4, 5, 6, 7, 8)
SIGNIFICANT = 6.63  # chi-square of one degree of freedom at 0.01: rare words of a large lexicon still reach it
MIN_ROWS = 4
FOLDS = 5
MAX_LABELLED = 12_000
COUNTED = 150_000  # counts of terms that a task holds at once; Spark adds them up
RIDGE = 1.0
REPEATED = 3
SEED = 29
THRESHOLD = 0.5


def word_terms(word: bytes) -> list[bytes]:
    """A word (marked by its end) and its beginnings."""
    return [word + b"$", *(word[:n] for n in PREFIXES if len(word) >= n)]


def text_terms(text: bytes) -> set[bytes]:
    out = set()
    for w in set(text.translate(WORD_BYTES).split()):
        out.update(word_terms(w))
    return out


def significant(a, b, na: float, nb: float):
    """Whether terms of ``a`` of ``na`` toxic and ``b`` of ``nb`` clean rows tell a toxic text (columns or arrays)."""
    enough = SIGNIFICANT * (a + b) * (na + nb - a - b + 1.0) * na * nb
    return (a + b >= MIN_ROWS) & (a * nb > b * na) & ((na + nb) * (a * (nb - b) - b * (na - a)) ** 2 >= enough)


class Terms:
    """The chosen terms with, for the whole sample (row 0) and for the sample without fold f (row f + 1),
    which of them are significant and which are indicators: at least ten times as frequent in toxic rows."""

    def __init__(self, terms: list[bytes], a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray):
        """Counts by fold: ``a`` and ``b`` are terms by folds, ``na`` and ``nb`` rows by fold."""
        some = np.zeros(len(terms), bool)
        used, strong = [], []
        for f in range(-1, len(na)):
            own = [x.sum(-1) - (x[..., f] if f >= 0 else 0) for x in (a, b, na, nb)]
            use = significant(*own)
            used.append(use)
            strong.append(use & (own[0] >= 10 * (own[1] + 0.5)))
            some |= use
        order = np.flatnonzero(some)
        self.terms = [terms[i] for i in order]
        self.used, self.strong = np.array(used)[:, order], np.array(strong)[:, order]


def select_terms(sample: DataFrame) -> Terms:
    """Every term that is significant in the sample, or in the sample without one of its folds."""

    def run(it):
        from collections import Counter
        counts = Counter()
        for b in batches(it, 256):
            for t, y, f in zip(*(c.to_pylist() for c in b.columns)):
                counts.update([(x, f, y) for x in text_terms(t)])
            if len(counts) > COUNTED:
                yield _counts(counts)
                counts = Counter()
        yield _counts(counts)

    fold = F.pmod("h", F.lit(FOLDS)).alias("fold")
    counts = sample.select("t", "label", fold).mapInArrow(run, "term binary, fold bigint, label bigint, n bigint")
    cells = [F.sum(F.when((F.col("fold") == f) & (F.col("label") == y), F.col("n")).otherwise(0)).alias(f"{'ba'[y]}{f}")
             for y in (1, 0) for f in range(FOLDS)]
    counts = counts.groupBy("term").agg(*cells)
    rows = {(r["fold"], r["label"]): r["n"] for r in sample.groupBy(fold, "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    na, nb = (np.array([rows.get((f, y), 0) for f in range(FOLDS)], float) for y in (1, 0))
    a, b = ([F.col(f"{c}{f}").cast("double") for f in range(FOLDS)] for c in "ab")

    def without(f: int):
        return [sum(x for i, x in enumerate(c) if i != f) for c in (a, b, na.tolist(), nb.tolist())]
    got = counts.where(reduce(or_, [significant(*without(f)) for f in range(-1, FOLDS)])).orderBy("term").toArrow()
    a, b = (np.stack([got.column(f"{c}{f}").to_numpy() for f in range(FOLDS)], axis=1).astype(float) for c in "ab")
    return Terms([bytes(t) for t in got.column("term").to_pylist()], a, b, na, nb)


def _counts(counts) -> pa.RecordBatch:
    keys = list(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.binary()), pa.array([k[1] for k in keys], pa.int64()),
         pa.array([k[2] for k in keys], pa.int64()), pa.array(counts.values(), pa.int64())], names=["term", "fold", "label", "n"])


class Features:
    """Texts to the chosen terms they hold, and indicator words by part of the sample."""

    def __init__(self, terms: list[bytes], strong: np.ndarray | None = None):
        index = {t: i for i, t in enumerate(terms)}
        self.strong = strong

        def find(word: bytes):
            """(terms of the word, parts of the sample in which one of them is an indicator)"""
            got = [i for i in map(index.get, word_terms(word)) if i is not None]
            if not got:
                return None
            return np.array(got), None if strong is None else strong[:, got].any(axis=1).astype(np.int64)

        # a bound method here would keep the memo of an ended task until Python's collector runs
        self.memo = Memo(find, HASH_ENTRIES)

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, int]:
        """(terms in ascending order, their counts, indicator words by part, words)"""
        words = text.translate(WORD_BYTES).split()
        found = [f for f in map(self.memo.__getitem__, words) if f]
        hits = None if self.strong is None else sum((f[1] for f in found), np.zeros(len(self.strong), np.int64))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), hits, len(words)
        return *np.unique(np.concatenate([f[0] for f in found]), return_counts=True), hits, len(words)


class Rows:
    """Sparse rows: columns and values of row i at ``start[i]:start[i + 1]``. What is made beside them is made
    for some BLOCK entries at a time: the driver fits in little more memory than the rows themselves take."""

    BLOCK = 1 << 16  # arrays of half a MB, which malloc gives out again; larger ones are mapped anew each time

    def __init__(self, start: np.ndarray, cols: np.ndarray, vals: np.ndarray, n: int):
        self.start, self.cols, self.vals, self.n = start, cols, vals, n

    @staticmethod
    def of(x) -> Rows:
        if isinstance(x, Rows):
            return x
        r, c = np.nonzero(x)
        return Rows(np.concatenate([[0], np.cumsum(np.bincount(r, minlength=len(x)))]), c, x[r, c], x.shape[1])

    @staticmethod
    def of_terms(start: np.ndarray, terms: np.ndarray, tf: np.ndarray, words: np.ndarray, n: int) -> Rows:
        """Log counts (columns 0 to n - 1) and rates (n to 2n - 1) of the terms, and the log length (2n)."""
        at = 2 * start + np.arange(len(start))
        cols, vals = np.empty(at[-1], np.int32), np.empty(at[-1], np.float32)
        out = Rows(at, cols, vals, 2 * n + 1)
        for i, j in out.blocks():
            own, size = slice(start[i], start[j]), np.diff(start[i:j + 1])
            first = np.arange(start[i], start[j]) + np.repeat(at[i:j] - start[i:j], size)
            second = first + np.repeat(size, size)
            cols[first], vals[first] = terms[own], np.log1p(tf[own])
            cols[second], vals[second] = terms[own] + n, np.minimum(3.0, tf[own] * 50.0 / np.repeat(words[i:j], size))
        cols[at[1:] - 1], vals[at[1:] - 1] = 2 * n, np.log1p(words) / 10
        return out

    def __len__(self) -> int:
        return len(self.start) - 1

    def blocks(self):
        """The rows in runs of up to BLOCK entries, or one longer row: first row and the one after the last."""
        i = 0
        while i < len(self):
            j = max(i + 1, int(np.searchsorted(self.start, self.start[i] + self.BLOCK, "right")) - 1)
            yield i, j
            i = j

    def sums(self, of) -> np.ndarray:
        """For each row the sum of what ``of`` gives for its entries, which it is handed as a slice."""
        out = np.zeros(len(self))
        for i, j in self.blocks():
            first, end = self.start[i:j], self.start[j]
            some = first < self.start[i + 1:j + 1]
            if some.any():
                out[i:j][some] = np.add.reduceat(of(slice(first[0], end)), first[some] - first[0])
        return out

    def take(self, rows: np.ndarray, used: np.ndarray | None = None) -> Rows:
        """These rows, with the entries of used columns only."""
        whole = np.diff(self.start)
        size = whole if used is None else self.sums(lambda at: used[self.cols[at]].astype(np.int64)).astype(np.int64)
        start = np.concatenate([[0], np.cumsum(size[rows])])
        out = Rows(start, np.empty(start[-1], self.cols.dtype), np.empty(start[-1], self.vals.dtype), self.n)
        for i, j in out.blocks():
            own = whole[rows[i:j]]
            at = np.arange(own.sum()) + np.repeat(self.start[:-1][rows[i:j]] - np.cumsum(own) + own, own)
            if used is not None:
                at = at[used[self.cols[at]]]
            out.cols[start[i]:start[j]], out.vals[start[i]:start[j]] = self.cols[at], self.vals[at]
        return out

    def dot(self, v: np.ndarray) -> np.ndarray:
        return self.sums(lambda at: self.vals[at] * v[self.cols[at]])

    def tdot(self, u: np.ndarray, squared: bool = False) -> np.ndarray:
        """The product of ``u`` with the rows, or with the squares of their values."""
        out = np.zeros(self.n)
        for i, j in self.blocks():
            at = slice(self.start[i], self.start[j])
            vals = self.vals[at] * self.vals[at] if squared else self.vals[at]
            out += np.bincount(self.cols[at], weights=vals * np.repeat(u[i:j], np.diff(self.start[i:j + 1])), minlength=self.n)
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x, y: np.ndarray, w: np.ndarray, ridge: float = RIDGE, steps: int = 20,
                 more: np.ndarray | None = None) -> np.ndarray:
    """Weights (further columns and the intercept last) of a ridge logistic regression over sparse or dense rows,
    by Newton steps solved with preconditioned conjugate gradients."""
    x = Rows.of(x)
    side = np.ones((len(x), 1)) if more is None else np.concatenate([more, np.ones((len(x), 1))], axis=1)
    d = x.n + side.shape[1]
    beta, penalty = np.zeros(d), np.full(d, ridge)
    penalty[-1] = 1e-3

    def forth(v):
        return x.dot(v[:x.n]) + side @ v[x.n:]

    def back(u):
        return np.concatenate([x.tdot(u), side.T @ u])

    def loss(v, z):
        return float((w * (np.logaddexp(0, z) - y * z)).sum() + (penalty * v * v).sum() / 2)

    z = forth(beta)
    for _ in range(steps):
        p = sigmoid(z)
        grad = back(w * (p - y)) + penalty * beta
        if not grad.any():
            break
        curve = w * np.maximum(p * (1 - p), 1e-4)
        scale = penalty + np.concatenate([x.tdot(curve, squared=True), (side * side).T @ curve])
        step, rest = np.zeros(d), -grad
        lead = rest / scale
        way, rho = lead, rest @ lead
        stop = 0.05 * np.sqrt(rest @ rest)
        for _ in range(60):
            bent = back(curve * forth(way)) + penalty * way
            size = rho / (way @ bent)
            step, rest = step + size * way, rest - size * bent
            if np.sqrt(rest @ rest) <= stop:
                break
            lead = rest / scale
            rho, before = rest @ lead, rho
            way = lead + (rho / before) * way
        now, move, ahead = loss(beta, z), 1.0, forth(step)
        while move > 1e-4 and loss(beta + move * step, z + move * ahead) > now:
            move /= 2
        beta, z = beta + move * step, z + move * ahead
        if np.abs(move * step).max(initial=0) < 1e-3:
            break
    return beta


def logits(x, beta: np.ndarray, more: np.ndarray | None = None) -> np.ndarray:
    x = Rows.of(x)
    out = x.dot(beta[:x.n]) + beta[-1]
    return out if more is None else out + more @ beta[x.n:-1]


def fit_chain(x, labels: np.ndarray, weight: np.ndarray, folds: np.ndarray, parts: dict | None = None) -> list[np.ndarray]:
    """One weight vector per category; labels has one column per category, in chain order.

    ``parts`` gives for a fold the columns and the labels that its models may use, which come from the other folds.
    """
    x = Rows.of(x)
    betas, earlier = [], np.zeros((len(x), 0))
    for c in range(labels.shape[1]):
        betas.append(fit_logistic(x, labels[:, c].astype(float), weight, more=earlier))
        if c + 1 < labels.shape[1]:
            held = np.zeros(len(x))
            for f in np.unique(folds):
                used, own = parts[f] if parts else (None, labels)
                rest, fold = np.flatnonzero(folds != f), np.flatnonzero(folds == f)
                if not len(rest):  # a sample of one fold: nothing else to learn from
                    held[fold] = sigmoid(logits(x, betas[-1], earlier))
                    continue
                beta = fit_logistic(x.take(rest, used), own[rest, c].astype(float), weight[rest], more=earlier[rest])
                held[fold] = sigmoid(logits(x.take(fold, used), beta, earlier[fold]))
            earlier = np.concatenate([earlier, held[:, None]], axis=1)
    return betas


def chain_scores(x, betas: list[np.ndarray]) -> np.ndarray:
    """Probabilities, one column per category."""
    x = Rows.of(x)
    out = np.zeros((len(x), 0))
    for beta in betas:
        out = np.concatenate([out, sigmoid(logits(x, beta, out))[:, None]], axis=1)
    return out


def category_labels(label: np.ndarray, hits: np.ndarray, words: np.ndarray, among: np.ndarray | None = None) -> np.ndarray:
    """The categories of the rows; the median rate is that of the toxic rows ``among`` (all)."""
    toxic = label == 1
    rate = hits / np.maximum(words, 1)
    own = toxic & (hits > 0) if among is None else toxic & (hits > 0) & among
    median = np.median(rate[own]) if own.any() else np.inf
    return np.stack([toxic & (hits > 0) & (rate >= median), toxic & (hits >= REPEATED), toxic], axis=1)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
        label_col: str = "toxic", max_labelled: int = MAX_LABELLED, seed: int = SEED) -> dict:
    """The model: chosen terms and the weights of the chain, fitted on the bounded sample."""
    sample, share = bounded_sample(docs, labels, id_col, text_col, label_id_col, label_col, max_labelled, seed)
    sample = stage_table(docs.sparkSession, sample, "toxicity-sample")
    chosen = select_terms(sample)

    def run(it):
        feats = Features(chosen.terms, chosen.strong)
        for b in batches(it, 512):
            rows = [feats(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([r[i] for r in rows], pa.list_(pa.int32())) for i in (0, 1, 2)),
                 pa.array([r[3] for r in rows], pa.int64()), b.column(1), b.column(2)],
                names=["terms", "tf", "hits", "words", "label", "h"])

    got = sample.select("t", "label", "h").mapInArrow(
        run, "terms array<int>, tf array<int>, hits array<int>, words bigint, label int, h bigint").toArrow()
    if not got.num_rows:
        return {"terms": chosen.terms, "betas": []}
    got = got.sort_by([("h", "ascending"), ("words", "ascending"), ("label", "ascending")])  # the same fit however the rows arrive
    col = {c: got.column(c).to_numpy() for c in ("words", "label", "h")}
    lists = {c: got.column(c).combine_chunks() for c in ("terms", "tf", "hits")}
    start = np.concatenate([[0], np.cumsum(lists["terms"].value_lengths().to_numpy())]).astype(np.int64)
    flat = {c: v.flatten().to_numpy() for c, v in lists.items()}
    x = Rows.of_terms(start, flat["terms"], flat["tf"], col["words"], len(chosen.terms))
    hits = flat["hits"].reshape(len(start) - 1, -1)
    del got, lists, flat  # the rows hold all of it
    pa.default_memory_pool().release_unused()
    folds = col["h"] % FOLDS
    y = category_labels(col["label"], hits[:, 0], col["words"])
    parts = {f: (np.concatenate([chosen.used[f + 1]] * 2 + [[True]]), category_labels(col["label"], hits[:, f + 1], col["words"], folds != f))
             for f in np.unique(folds)}
    betas = fit_chain(x, y, share[col["label"]], folds, parts)
    return {"terms": chosen.terms, "betas": betas}


def _scorer(model: dict):
    feats, n = Features(model["terms"]), len(model["terms"])

    def score(texts: list[bytes]) -> np.ndarray:
        if not model["betas"]:
            return np.zeros((len(texts), len(CATEGORIES)))
        rows = [feats(t) for t in texts]
        start = np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])]).astype(np.int64)
        terms, tf = (np.concatenate([np.zeros(0, np.int64), *(r[i] for r in rows)]) for i in (0, 1))
        return chain_scores(Rows.of_terms(start, terms, tf, np.array([r[3] for r in rows]), n), model["betas"])
    return score


def score_documents(docs: DataFrame, model: dict, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, toxic, p_dense, p_repeated: one row per input row.

    ``score`` is the probability of the last category, ``predicted`` is 1 and ``toxic``
    true from 0.5 on. Cases: null and empty texts have no terms and get the score of
    such texts; a model fitted without labelled rows scores 0; repeated rows score
    alike; null ids are not held out; an empty table gives an empty result. Extra
    columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.coalesce(text_bytes(text_col), F.lit(b"")).alias("t"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(it):
        score = _scorer(shared.value)
        for b in batches(it, 512):
            p = score(b.column(2).to_pylist())
            bad = p[:, -1] >= THRESHOLD
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(p[:, -1]), pa.array(bad.astype(np.int32)), pa.array(bad),
                 pa.array(p[:, 0]), pa.array(p[:, 1])],
                names=["doc_id", "held_out", "score", "predicted", "toxic", "p_dense", "p_repeated"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, "
                                "predicted int, toxic boolean, p_dense double, p_repeated double")


def reject_toxic(docs: DataFrame, model: dict, *, text_col: str = "text") -> DataFrame:
    """The documents that the model does not reject, with all their columns. Row by row, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(it):
        score = _scorer(shared.value)
        for b in batches(it, 512):
            texts = [(t or "").encode() for t in b.column(place).to_pylist()]
            yield b.filter(pa.array(score(texts)[:, -1] < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, fit(docs, labels))
