"""Quality and toxicity: held-out accuracy, independence of labels, edges."""

import gc
import tracemalloc
import weakref
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from huddle.llm import quality, toxicity
from tests.llm.conftest import edge_rows

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def data(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def accuracy(rows, labels, column):
    truth = {r["doc_id"]: r[column] for r in labels.collect()}
    pairs = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(pairs) > 50
    return np.mean([a == b for a, b in pairs])


def test_quality_on_held_out_rows(spark, data):
    docs, labels = data
    rows = quality.quality_report(docs, labels).collect()
    assert len(rows) == docs.count() and all(r.held_out == held(r.doc_id) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert accuracy(rows, labels, "quality") >= 0.97
    # held-out labels have no influence
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1,
                                                  1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.quality_report(docs.repartition(5), flipped).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-5 for r in rows)


def test_toxicity_on_held_out_rows(spark, data):
    docs, labels = data
    rows = toxicity.toxicity_report(docs, labels).collect()
    assert len(rows) == docs.count() and all(r.held_out == held(r.doc_id) for r in rows)
    assert all(r.predicted == int(r.score >= 0.5) == int(r.toxic) for r in rows)
    assert accuracy(rows, labels, "toxic") >= 0.95
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    clean = [r.predicted for r in rows if truth.get(r.doc_id) == 0]
    assert np.mean(clean) <= 0.01


def test_chain_feeds_out_of_fold_predictions():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 6))
    first = (x[:, 0] + 0.3 * rng.standard_normal(400)) > 0
    second = first & (x[:, 1] > 0)
    betas = toxicity.fit_chain(x, np.stack([first, second], axis=1), np.ones(400), np.arange(400) % 5)
    assert [len(b) for b in betas] == [7, 8]  # the second model also sees the first one's output
    p = toxicity.chain_scores(x, betas)
    alone = toxicity.sigmoid(toxicity.logits(x, toxicity.fit_logistic(x, second.astype(float), np.ones(400))))
    assert ((p[:, 1] >= 0.5) == second).mean() >= ((alone >= 0.5) == second).mean() - 0.01


@pytest.mark.parametrize("lexicon", [10, 100, 600])
def test_toxic_recall_with_small_and_large_lexicons(spark, lexicon):
    """Three words of the lexicon among forty others: every toxic word counts, however many there are."""
    rng = np.random.default_rng(lexicon)
    words = np.array(["".join(chr(97 + c) for c in w) for w in rng.integers(0, 26, (3000 + lexicon, 7))])
    label = rng.integers(0, 2, 6000)
    texts = [" ".join([*words[rng.integers(0, 3000, 40)], *(words[3000 + rng.integers(0, lexicon, 3)] if y else [])]) for y in label]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, y in enumerate(label)], "doc_id bigint, toxic int")
    held = [(r.predicted, label[r.doc_id]) for r in toxicity.toxicity_report(docs, labels).collect() if r.held_out]
    assert np.mean([p for p, y in held if y]) >= 0.9
    assert np.mean([p for p, y in held if not y]) <= 0.05


def test_terms_equal_plain_counts(spark):
    """Significance by part of the sample, against counts of the rows of each part."""
    rng = np.random.default_rng(2)
    vocabulary = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(400):
        y = i % 2
        rows.append((" ".join(rng.choice(vocabulary[:20] if y and rng.random() < 0.9 else vocabulary, 4)).encode(), y, i * 7))
    chosen = toxicity.select_terms(spark.createDataFrame(rows, "t binary, label int, h bigint"))
    for part in range(-1, toxicity.FOLDS):
        own = [(toxicity.text_terms(t), y) for t, y, h in rows if h % toxicity.FOLDS != part]
        na, nb = sum(y for _, y in own), sum(1 - y for _, y in own)
        want, strong = set(), set()
        for term in set().union(*(t for t, _ in own)):
            a, b = (sum(term in t and y == c for t, y in own) for c in (1, 0))
            if a + b >= toxicity.MIN_ROWS and a * nb > b * na and toxicity.SIGNIFICANT <= (na + nb) * (
                    a * (nb - b) - b * (na - a)) ** 2 / ((a + b) * (na + nb - a - b + 1) * na * nb):
                want.add(term)
                strong |= {term} if a >= 10 * (b + 0.5) else set()
        assert {t for t, u in zip(chosen.terms, chosen.used[part + 1]) if u} == want
        assert {t for t, u in zip(chosen.terms, chosen.strong[part + 1]) if u} == strong
    assert chosen.used.any(axis=1).all()


def test_an_ended_task_leaves_no_memo():
    """Workers live on, so a task's words must go with its last reference, without Python's collector."""
    gc.disable()
    try:
        feats = toxicity.Features([b"abcd"])
        feats(b"abcdef xyz")
        memo = weakref.ref(feats.memo)
        del feats
        assert memo() is None
    finally:
        gc.enable()


def test_the_fit_makes_little_beside_its_rows(monkeypatch):
    """300,000 terms of 3,000 rows: products, parts and the rows themselves, which are 5 MB, without tens of MB beside them."""
    rng = np.random.default_rng(5)
    n, each = 3_000, 100
    start, terms = np.arange(n + 1) * each, rng.integers(0, 500, n * each).astype(np.int32)
    tf, words = rng.integers(1, 9, n * each).astype(np.int32), rng.integers(100, 900, n)
    used, v, u = rng.random(1001) < 0.8, rng.standard_normal(1001), rng.standard_normal(n)
    whole = toxicity.Rows.of_terms(start, terms, tf, words, 500)
    monkeypatch.setattr(toxicity.Rows, "BLOCK", 1 << 12)
    tracemalloc.start()
    rows = toxicity.Rows.of_terms(start, terms, tf, words, 500)
    part = rows.take(np.arange(0, n, 2), used)
    got = rows.dot(v), rows.tdot(u), rows.tdot(u, squared=True)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 10e6
    assert (rows.cols == whole.cols).all() and (rows.vals == whole.vals).all() and (got[0] == whole.dot(v)).all()
    assert np.allclose(got[1], whole.tdot(u)) and np.allclose(got[2], np.bincount(whole.cols, whole.vals ** 2 * np.repeat(u, 201)))
    plain = [[(c, x) for c, x in zip(whole.cols[a:b], whole.vals[a:b]) if used[c]] for a, b in zip(whole.start[:-1:2], whole.start[1::2])]
    assert [len(p) for p in plain] == np.diff(part.start).tolist()
    assert [e for p in plain for e in p] == list(zip(part.cols, part.vals))


def test_sparse_rows_and_fit_equal_dense_ones():
    rng = np.random.default_rng(8)
    start, tf = np.array([0, 2, 2, 5]), np.array([1, 4, 2, 1, 9])
    rows = toxicity.Rows.of_terms(start, np.array([0, 3, 1, 2, 3]), tf, np.array([5, 0, 700]), 4)
    dense = np.zeros((3, 9))
    for i, t, n, words in ((0, 0, 1, 5), (0, 3, 4, 5), (2, 1, 2, 700), (2, 2, 1, 700), (2, 3, 9, 700)):
        dense[i, t], dense[i, 4 + t] = np.log1p(n), min(3.0, n * 50 / words)
    dense[:, 8] = np.log1p([5, 0, 700]) / 10
    v, u = rng.standard_normal(9), rng.standard_normal(3)
    assert np.allclose(rows.dot(v), dense @ v) and np.allclose(rows.tdot(u), dense.T @ u)
    used = rng.random(9) < 0.5
    assert np.allclose(rows.take(np.array([2, 0]), used).dot(v), (dense[[2, 0]] * used) @ v)
    x = rng.standard_normal((300, 5)) * (rng.random((300, 5)) < 0.4)
    y, w = (x[:, 0] + 0.5 * rng.standard_normal(300) > 0).astype(float), rng.uniform(0.5, 2, 300)
    beta = toxicity.fit_logistic(x, y, w)
    z = np.concatenate([x, np.ones((300, 1))], axis=1)
    slope = z.T @ (w * (toxicity.sigmoid(z @ beta) - y)) + np.array([1, 1, 1, 1, 1, 1e-3]) * beta
    assert np.abs(slope).max() < 1e-2  # where the penalised likelihood is flat


@pytest.mark.parametrize("first", ["a", "\u0430"])
def test_quality_that_shows_only_in_longer_words(spark, first):
    """Two vocabularies of lower-case words of one length and shape, Latin and Cyrillic."""
    rng = np.random.default_rng(5)
    words = np.array(["".join(chr(ord(first) + c) for c in w) for w in rng.integers(0, 26, (400, 8))])
    label = rng.integers(0, 2, 900)
    texts = [" ".join(words[y * 200 + rng.integers(0, 200, 40)]) for y in label]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, y in enumerate(label)], "doc_id bigint, quality int")
    assert accuracy(quality.quality_report(docs, labels).collect(), labels, "quality") >= 0.95


def test_shapes_are_whole():
    same = b"a-0-a-0-a-0-a-0-a-"
    terms = quality.Terms()
    assert set(terms(same + b"A")[0].tolist()) != set(terms(same + b"0")[0].tolist())
    assert terms.shapes[same + b"A"] != terms.shapes[same + b"0"]


def test_vote_weights_by_similarity():
    cos = np.array([[0.9, 0.1, 0.1], [0.1, 0.9, 0.1], [-1.0, -1.0, -1.0]])
    p = quality.vote(cos, np.array([1, 0, 0]), np.ones(2), 0.3, 3)
    assert p[0] > 0.9 and p[1] < 0.1 and p[2] == 0.3


@pytest.mark.parametrize("module,column", [(quality, "quality"), (toxicity, "toxic")])
def test_edges(spark, edge, empty, module, column):
    report = module.quality_report if module is quality else module.toxicity_report
    labels = spark.createDataFrame([(i, i % 2) for i in range(14)] + [(None, 1), (3, None), (4, 0)], f"doc_id bigint, {column} int")
    rows = report(edge, labels).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert report(edge, labels.limit(0)).count() == len(edge_rows())
    assert report(empty, labels).count() == 0 and report(empty, labels.limit(0)).count() == 0


def test_reject_keeps_columns_and_rows(spark, edge, empty):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.fit(edge, labels)
    kept = toxicity.reject_toxic(edge, model)
    assert kept.schema == edge.schema
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, edge.collect()))
    assert toxicity.reject_toxic(empty, model).count() == 0
