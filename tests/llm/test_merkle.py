"""Merkle manifest against a tree built in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from huddle.llm import merkle as M
from huddle.llm import order as O
from tests.llm.conftest import edge_rows, frame


def h(s):
    return hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()


def f(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return h("".join(f(v) for v in (r[0], r[3], r[2], r[4], text)))


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        row = out[-1]
        out.append([h("".join(row[i:i + arity])) for i in range(0, len(row), arity)])
    return out


def steps(tree, at, arity):
    for row in tree[:-1]:
        first = at - at % arity
        yield "".join(row[first:at]), "".join(row[at + 1:first + arity])
        at //= arity


def brute(rows, arity=3):
    """Sorted (doc_id, leaf, subroot, root, proof, folded, verified); rows are (id, text, lang, source, n_chars)."""
    by_source = defaultdict(list)
    for r in rows:
        bent = r[1]
        if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
            bent = r[1].replace("\n", "")
        by_source[r[3]].append(((r[0] is not None, r[0] or 0), leaf(r, r[1]), leaf(r, bent), r[0]))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        by_source[s].sort(key=lambda x: x[:3])
        trees.append(levels([x[1] for x in by_source[s]], arity))
    top = levels([t[-1][0] for t in trees], arity)
    out = []
    for i, s in enumerate(names):
        for at, (_, lf, bent, doc) in enumerate(by_source[s]):
            path = [*steps(trees[i], at, arity), *steps(top, i, arity)]
            acc = bent
            for before, after in path:
                acc = h(before + acc + after)
            out.append((doc is not None, doc or 0, lf, trees[i][-1][0], top[-1][0], h("".join(b + a for b, a in path)),
                        acc, acc == top[-1][0]))
    return sorted(out)


def got(df):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified)
                  for r in df.collect())


@pytest.mark.parametrize("arity", [3, 2])
def test_manifest_equals_plain_tree(spark, arity):
    rng = random.Random(5)
    # one source with a third of the rows, sources of one to twelve rows, null source, ids out of order
    sources = ["hot"] * 60 + [f"s{k}" for k in range(12) for _ in range(k + 1)] + ["é", None, None, "", "Z"]
    ids = rng.sample(range(-500, 5000), len(sources))
    rows = [(ids[i], rng.choice(["a\nb", "plain", "", None, "x\n\ny", "é\n"]), rng.choice(["en", None]), s, i)
            for i, s in enumerate(sources)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    out = got(M.manifest(df, arity=arity))
    assert out == brute(rows, arity)
    assert any(r[-1] for r in out) and not all(r[-1] for r in out)


def test_edges(spark, edge, empty):
    rows = [r[:5] for r in edge_rows()]  # repeated rows, null ids, null everything, very long text, clashing columns
    assert got(M.manifest(edge)) == brute(rows)
    assert M.manifest(empty).count() == 0
    assert M.manifest(empty).columns == M.manifest(edge).columns
    one = frame(spark, ["just one"])
    r = M.manifest(one).first()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof_sha256 == h("") and r.verified


def test_positions_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(O, "ROWS_PER_RANGE", 7)
    rng = random.Random(8)
    rows = [(rng.choice([None, 1, 1, 1, 2, 9, -4]), rng.choice([None, "", "a", "é", "b"]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "a bigint, b string, c int").repartition(3)
    assert len(O.bounds(df, ["a", "b", "c"])) > 20
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode(), r[2]))
    out = {r.c: r.at for r in O.positions(df, ["a", "b", "c"], "at").collect()}
    assert [out[r[2]] for r in want] == list(range(300))
