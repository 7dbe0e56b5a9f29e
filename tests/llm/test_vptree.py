"""Vantage-point trees against brute force."""

import numpy as np
import pytest

from huddle.llm import vptree


def brute(rows, queries, k):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q in queries:
        if q not in ok:
            continue
        c = [(-float(vptree.exact_cosine(ok[q][None], v[None])[0]), i) for i, v in ok.items() if i != q and len(v) == len(ok[q])]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(c)[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((12, 16))
    v = centre[rng.integers(0, 12, 900)] + 0.3 * rng.standard_normal((900, 16))
    v[100:400] = v[100]  # a large group of copies
    rows = [(i, x.astype(np.float32).tolist()) for i, x in enumerate(v)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [None] + [1.0] * 15),
             (904, [float("inf")] + [1.0] * 15), (905, [1.0, 2.0]), (906, [2.0, 1.0]), (None, v[5].tolist()), rows[7]]
    rows = [(i, None if x is None else [None if y is None else float(np.float32(y)) for y in x]) for i, x in rows]
    return rows, spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(5)


def run(df, queries, k=5, **kw):
    return sorted(tuple(r) for r in vptree.nearest(df, df.where(f"vec_id % {queries} = 0"), k, **kw).collect())


@pytest.mark.parametrize("shard_rows,leaf_rows", [(8192, 256), (120, 16)])
def test_exact_with_factor_one(vectors, shard_rows, leaf_rows):
    rows, df = vectors
    want = brute(rows, [i for i in range(907) if i % 50 == 0], 5)
    got = run(df, 50, shard_rows=shard_rows, leaf_rows=leaf_rows)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], atol=1e-12, rtol=0)


def test_relaxed_factor_prunes_and_keeps_recall(vectors):
    rows, df = vectors
    unit = np.array([v for i, v in rows[:900]])
    unit = unit / np.linalg.norm(unit, axis=1)[:, None]
    pairs = {}
    for factor in (1.0, 0.5):
        s = vptree.Search(unit, unit[:60], 6, 5, factor)
        s.walk(vptree.build_tree(unit, 16), np.arange(60))
        pairs[factor] = s.leaf_pairs
    assert pairs[0.5] < pairs[1.0] <= 60 * 900
    want = {r[:3:2] for r in brute(rows, range(0, 907, 50), 5)}
    got = {r[:3:2] for r in run(df, 50, factor=0.8, leaf_rows=16)}
    assert len(want & got) >= 0.9 * len(want)


def test_few_candidates_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0])], "vec_id bigint, embedding array<double>")
    assert run(df, 50) == [(0, 1, 2, 1.0), (0, 2, 1, 0.0)]
    assert vptree.nearest(df.limit(0), df.limit(0)).count() == 0
    assert vptree.nearest(df, df.limit(0)).count() == 0


@pytest.mark.parametrize("leaf_rows", [256, 16])
def test_many_near_equal_and_scaled_vectors(spark, leaf_rows):
    """Far more near-ties than k: only the exact cosine, then the id, orders them."""
    rng = np.random.default_rng(11)
    base = rng.standard_normal((2, 16)).astype(np.float32)
    noisy = np.nextafter(base[0], rng.choice([-9, 9], (120, 16)).astype(np.float32))
    scaled = base[1] * rng.uniform(0.1, 9, (120, 1)).astype(np.float32)
    signs = rng.choice([-1.0, 1.0], (300, 6)) @ np.eye(6, 16)
    v = np.concatenate([noisy, scaled, base[1] * 2.0 ** np.arange(-20, 20)[:, None], signs * rng.integers(1, 9, (300, 1))])
    rows = [(int(i), [float(np.float32(y)) for y in x]) for i, x in zip(rng.permutation(len(v)), v)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(4)
    got = run(df, 5, leaf_rows=leaf_rows, shard_rows=300)
    want = brute(rows, range(0, len(v), 5), 5)
    wrong = len({r[:3] for r in want} - {r[:3] for r in got})
    assert wrong == 0, f"{wrong} of {len(want)} neighbours are wrong"


def test_an_id_with_many_vectors_takes_one_place(spark):
    rows = [(1, [1.0, i / 1000]) for i in range(40)] + [(i, [1.0, float(i)]) for i in range(2, 9)] + [(0, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert [r[:3] for r in run(df, 50)] == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (0, 4, 4), (0, 5, 5)]


def test_queries_keep_their_best_from_tree_to_tree():
    """A later tree costs far fewer exact scores than the first one, and leaves are met by many queries at once."""
    rng = np.random.default_rng(4)
    vec, queries = (rng.standard_normal((n, 8)).astype(np.float32) for n in (4000, 600))
    s = vptree.Search(vec, queries, 6, 5, 1.0)
    scores = []
    for base in range(0, 4000, 1000):
        s.walk(vptree.build_tree(vptree.normalised(vec[base:base + 1000]), 32), np.arange(600), base)
        scores.append(s.exact_pairs - sum(scores))
    assert max(scores[1:]) < scores[0] / 2
    cos = vptree.normalised(queries) @ vptree.normalised(vec).T
    assert s.row.tolist() == np.argsort(-cos, axis=1)[:, :6].tolist()


def test_a_tree_is_unpacked_once_for_many_queries(spark, vectors):
    """Trees are copied for each block of queries and queries for each part of the shards, not for each shard."""
    _, df = vectors
    rows = vptree.usable_rows(df, "vec_id", "embedding").where("size(v) = 16").cache()
    assert rows.schema["v"].dataType.elementType.typeName() == "float"
    found = vptree.classes(rows, 5).cache()
    trees = vptree.plant_trees(found, 60, 16)
    q, t = vptree.to_parts(found, trees, rows, 60, 300)
    blocks = -(-rows.count() // 300)
    parts = q.select("part").distinct().count()
    assert blocks == 4 and parts <= 4 * 4 and q.count() == parts * rows.count()
    assert t.count() == blocks * trees.count() and t.select("dim", "block", "shard").distinct().count() == t.count()


@pytest.mark.parametrize("cast", ["float", "double"])
def test_parts_of_several_trees_are_exact(spark, vectors, monkeypatch, cast):
    rows, df = vectors
    monkeypatch.setattr(vptree, "TASKS_PER_CORE", 1)
    df = df.withColumn("embedding", df["embedding"].cast(f"array<{cast}>"))
    got = run(df, 5, shard_rows=12, leaf_rows=4, query_block=90)
    want = brute(rows, [i for i in range(907) if i % 5 == 0], 5)
    assert [r[:3] for r in got] == [r[:3] for r in want]
