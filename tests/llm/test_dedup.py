"""Min-max hashing against all pairs."""

import random

import numpy as np

from huddle.llm import dedup
from tests.llm.conftest import edge_rows, frame


def shingles(text):
    w = (text or "").encode().translate(dedup.LOWER).split()
    k = min(5, len(w))
    return frozenset(tuple(w[a:a + k]) for a in range(len(w) - k + 1)) if w else frozenset()


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                n = len(sets[i] & sets[j])
                if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                    root[find(i)] = find(j)
    small = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            small[find(i)] = min(d, small.get(find(i), d))
    return sorted(((d, len(sets[i]), small.get(find(i)), d == small.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def run(df, **kw):
    return sorted((tuple(r)[:4] for r in dedup.near_duplicates(df, **kw).collect()), key=repr)


def families(rng):
    """Families of copies from light to heavy edits, chains, shared passages, exact copies."""
    def text(n):
        return [f"{rng.choice('abcdefgh')}{rng.randrange(900)}" for _ in range(n)]

    out = []
    for f in range(4):
        base = text(rng.randrange(40, 90))
        for _ in range(40):
            w = list(base)
            for _ in range(rng.randrange(0, 7)):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
            out.append(" ".join(w))
    chain = text(100)
    for i in range(25):  # neighbours are linked, the ends are not
        out.append(" ".join(chain))
        chain = chain[3:] + text(3)
    passage = text(30)
    for _ in range(60):  # a common passage makes nobody a copy
        out.append(" ".join(text(12) + passage + text(12)))
    for _ in range(50):
        out.append("the very SAME text five words and more")
    out += ["short one", "Short One", "short", "", " "] + [" ".join(text(50)) for _ in range(60)]
    rng.shuffle(out)
    return out


def test_components_equal_all_pairs(spark):
    texts = families(random.Random(12))
    assert run(frame(spark, texts)) == brute(list(enumerate(texts)))


def test_exact_settlement_alone_finds_every_link(spark):
    """Without the central rounds the prefix join has to find all cross-component pairs."""
    texts = families(random.Random(13))
    assert run(frame(spark, texts), rounds=0) == brute(list(enumerate(texts)))


def test_sketch_is_unbiased():
    rng = np.random.default_rng(0)
    a, b = dedup.permutations()
    pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    agree = [(dedup.sketch(np.sort(pool[:300]), a, b) == dedup.sketch(np.sort(pool[100:]), a, b)).mean()]
    for _ in range(30):
        pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        agree.append((dedup.sketch(np.sort(pool[:300]), a, b) == dedup.sketch(np.sort(pool[100:]), a, b)).mean())
    assert abs(np.mean(agree) - 0.5) < 0.03  # similarity 200 / 400
    assert (dedup.sketch(pool[:300], a, b)[:64] <= dedup.sketch(pool[:300], a, b)[64:]).all()


def test_prefix_holds_a_shared_shingle():
    for n in range(1, 200):
        need = -(-75 * n // 100)
        assert dedup.prefix_length(n) == n - need + 1


def test_edges(spark, edge, empty):
    rows = [(r[0], r[1]) for r in edge_rows()]
    assert run(edge) == brute(rows)
    assert dedup.near_duplicates(empty).count() == 0
    kept = dedup.keep_one_per_group(edge)
    assert kept.columns == edge.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    # repeated rows with words and copies go; rows without words all stay
    want = [r for r in dict.fromkeys(rows) if shingles(r[1]) and r[1] != "two  WORDS"] + [r for r in rows if not shingles(r[1])]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert dedup.keep_one_per_group(empty).count() == 0


def test_a_round_reads_the_open_buckets_of_the_round_before(spark, monkeypatch):
    read = {}

    def spy(session, df, name, stage=dedup.stage_table):
        read.setdefault(name, []).append({f.split("/huddle/")[-1].rsplit("-", 1)[0].split("/")[0] for f in df.inputFiles()})
        return stage(session, df, name)
    monkeypatch.setattr(dedup, "stage_table", spy)
    words = [f"w{i}" for i in range(60)]
    # two chains of near copies, so that buckets stay open after the first round
    rows = [(c * 10 + i, " ".join(words[:i] + [f"c{c}x{i}"] + words[i + 1:])) for c in range(2) for i in range(0, 10, 3)]
    dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert not any("dedup-members" in name for names in read["dedup-pairs"] for name in names)
    assert len(read["dedup-open"]) > 1 and not any("dedup-members" in n for names in read["dedup-open"][1:] for n in names)


def test_workers_are_handed_bounded_batches(spark):
    """Sets of 400 kB: a batch holds some MB of them, not all that a task has."""
    def run(it):
        import pyarrow as pa
        for b in it:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "size"])

    sets = spark.range(0, 60, 1, 1).selectExpr("cast(repeat(cast(id % 10 as string), 400000) as binary) AS t")
    got = sets.mapInArrow(run, "rows bigint, size bigint").collect()
    assert sum(r["rows"] for r in got) == 60
    assert max(r["size"] for r in got) <= 8 << 20
