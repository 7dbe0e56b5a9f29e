"""Sharding and mixing against brute force, laws and SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from huddle.llm import mixing, oracle, queries, sharding
from tests.conftest import SF001
from tests.llm.conftest import frame


def law_holds(rows, n_shards):
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r.slot)
    counts = [len(shards.get(s, [])) for s in range(n_shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())
    assert {r.law for r in rows} <= {"rows"} and all(r.grown_shard is None for r in rows)


def test_shards_match_the_mixture(spark):
    rng = random.Random(1)
    sources = ["hot" if rng.random() < 0.5 else f"s{rng.randrange(6)}" for _ in range(997)]
    docs = frame(spark, [f"text {i % 40}" for i in range(997)], sources)
    rows = sharding.assign_shards(docs, 10, rows_per_bucket=50).collect()
    law_holds(rows, 10)
    total, by = Counter(sources), defaultdict(Counter)
    for r in rows:
        by[r.shard][sources[r.doc_id]] += 1
        text = f"text {r.doc_id % 40}".encode()
        assert r.size == len(text) + 16 and r.text_crc32 == zlib.crc32(text)
    for s, n in total.items():
        assert all(abs(by[k][s] - n / 10) <= 1.5 for k in range(10)), s
    again = sharding.assign_shards(docs.repartition(7), 10, rows_per_bucket=400).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}


def brute_shards(rows, n_shards=sharding.N_SHARDS, seed=sharding.SEED):
    """(id, text, source) rows -> sorted (id, shard, slot)."""
    groups, order = defaultdict(list), []
    for i, t, s in rows:
        t = (t or "").encode()
        groups["~null" if s is None else "=" + s].append((h60(seed, id_text(i, t.decode())), -1 if i is None else i, zlib.crc32(t), len(t)))
    for s, own in groups.items():
        order += [((k + 0.5) / len(own), s, *r) for k, r in enumerate(sorted(own))]
    n, out = len(rows), []
    for pos, r in enumerate(sorted(order)):
        shard = pos * n_shards // n
        out.append((r[3], shard, pos - -(-shard * n // n_shards)))
    return sorted(out)


def test_sharding_brute_force(spark, edge):
    docs = frame(spark, [f"t{i}" for i in range(300)], [f"s{i % 7}" if i % 11 else None for i in range(300)])
    for d in (docs, edge):
        got = sharding.assign_shards(d, 8, rows_per_bucket=37).collect()
        want = brute_shards([(r.doc_id, r.text, r.source) for r in d.collect()], 8)
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.shard, r.slot) for r in got) == want


def test_sharding_edges(spark, edge, empty):
    rows = sharding.assign_shards(edge, 4).collect()
    assert len(rows) == edge.count()
    law_holds(rows, 4)
    assert all(r.size == 16 and r.text_crc32 == 0 for r in rows if r.doc_id in (0, 1))
    assert sharding.assign_shards(empty, 4).count() == 0
    law_holds(sharding.assign_shards(edge.limit(3), 40).collect(), 40)


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """The contract's loop: share, stop at the cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed |= {s: float(cap * sizes[s]) for s in over}


def test_mix_targets_and_draws(spark):
    rng = random.Random(5)
    sources = [rng.choice(["a", "b", "b", "b", "b", "c", None, "tiny"]) if i else "tiny" for i in range(600)]
    sources = ["a" if s == "tiny" and i > 3 else s for i, s in enumerate(sources)]
    texts = [" ".join(["w"] * rng.randrange(0, 60)) for _ in range(600)]
    rows = mixing.mix_report(frame(spark, texts, sources)).collect()
    assert len(rows) == 600
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r.size == len(texts[r.doc_id].split()) and r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        sizes[sources[r.doc_id]] += r.size
        taken[sources[r.doc_id]] += r.taken
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[sources[r.doc_id]] and abs(r.target - want[sources[r.doc_id]]) < 1e-6 * max(1, r.target)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 60, (s, taken[s], want[s])


def brute_split(quotas, n_shards, seed=mixing.SEED):
    """The tree in plain Python: quotas by source key -> running counts by shard."""
    total = sum(quotas.values())

    def split(draws, lo, hi, level):
        if hi - lo == 1:
            return {lo: Counter(s for s, _ in draws)}
        mid = (lo + hi) // 2
        draws = sorted(draws, key=lambda d: (h60(seed, "tree", level, *d), *d))
        cut = mid * total // n_shards - lo * total // n_shards
        return split(draws[:cut], lo, mid, level + 1) | split(draws[cut:], mid, hi, level + 1)

    parts = split([(s, i) for s, q in quotas.items() for i in range(q)], 0, n_shards, 0)
    return {s: np.cumsum([parts[j][s] for j in range(n_shards)]).tolist() for s in quotas}


def h60(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def id_text(i, text):
    return str(i) if i is not None else "~null" + hashlib.md5((text or "").encode()).hexdigest()


def brute_mix(rows, n_shards=mixing.N_SHARDS, seed=mixing.SEED, blocks=mixing.BLOCKS):
    """(id, text, source) rows -> for each row its size and the shards that draw it, by pass."""
    rows = [(id_text(i, t), "~null" if s is None else "=" + s, len(re.findall(mixing.WORD, t or ""))) for i, t, s in rows]
    sizes, words = Counter(), defaultdict(Counter)
    at = [(s, h60(seed, i) % blocks) for i, s, _ in rows]
    for (s, b), (_, _, n) in zip(at, rows):
        sizes[s] += n
        words[s][b] += n
    targets = brute_targets({None if s == "~null" else s: n for s, n in sizes.items()}) if sum(sizes.values()) else {}
    drawn = {}
    for s in sizes:
        target = targets.get(None if s == "~null" else s, 0.0)
        order = sorted(words[s], key=lambda b: (h60(seed, "block", s, b), b))
        passes = int(target // sizes[s]) if sizes[s] else 0
        left = rest = target - passes * sizes[s]
        once, upto = [], 0
        for b in order:
            upto += words[s][b]
            if rest > 0 and upto <= rest:
                once.append(b)
                left = rest - upto
        others = [(abs(left - words[s][b]), k, b) for k, b in enumerate(order) if b not in set(once) and abs(left - words[s][b]) < left]
        once += [min(others)[2]] if others else []
        drawn[s] = order * passes + [b for b in order if b in set(once)]
    upto = brute_split({s: len(d) for s, d in drawn.items()}, n_shards, seed)
    shards = defaultdict(list)
    for s, d in drawn.items():
        for i, b in enumerate(d):
            shards[s, b].append(sum(u <= i for u in upto[s]))
    return [(n, shards[x]) for x, (_, _, n) in zip(at, rows)]


def split(spark, quotas, shards, seed=mixing.SEED):
    df = spark.createDataFrame(list(quotas.items()), "__src string, __q bigint")
    return {r["__src"]: r["__upto"] for r in mixing.split_quotas(df, shards, sum(quotas.values()), seed).collect()}


@pytest.mark.parametrize("shards", [1, 2, 7, 16])
def test_splitting_tree_is_exact(spark, shards, monkeypatch):
    quotas = {"=a": 1, "=b": 17, "=c": 400, "=d": 33, "~null": 2000}
    monkeypatch.setattr(mixing, "DRAWS_PER_BUCKET", 300)
    upto = split(spark, quotas, shards, 9)
    assert upto == brute_split(quotas, shards, 9)
    out = np.diff(np.array([[0, *upto[s]] for s in quotas]), axis=1)
    assert out.shape == (5, shards) and (out >= 0).all() and out.sum(axis=1).tolist() == list(quotas.values())
    assert out.sum(axis=0).max() - out.sum(axis=0).min() <= 1
    assert split(spark, {"=none": 0}, shards) == {}


def test_splitting_tree_follows_the_hypergeometric_law():
    """Mean and variance of a shard's part; 75 and 75 * 0.25 * 300 / 399 for a quarter of 300 and 100."""
    parts = [brute_split({"=a": 300, "=b": 100}, 4, s)["=a"][0] for s in range(300)]
    assert abs(np.mean(parts) - 75) < 1.5 and 9 < np.var(parts) < 20


def test_mix_brute_force(spark, edge):
    rng = random.Random(8)
    sources = [rng.choice(["hot", "hot", "hot", "b", None, "c"]) for _ in range(500)]
    texts = [" ".join(["w"] * rng.randrange(0, 40)) for _ in range(500)]
    plain = frame(spark, texts, sources)
    nulls = spark.createDataFrame([(None, f"no id {i} " * (i % 5), "b") for i in range(60)], "doc_id bigint, text string, source string")
    for docs in (plain, plain.select("doc_id", "text", "source").unionByName(nulls), edge.select("doc_id", "text", "source")):
        rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        want = Counter((i, n, n * len(s), ",".join(map(str, s))) for (i, _, _), (n, s) in zip(rows, brute_mix(rows)))
        assert Counter((r.doc_id, r.size, r.taken, r.shards) for r in mixing.mix_report(docs).collect()) == want
        drawn = Counter((i, p, x) for (i, _, _), (_, s) in zip(rows, brute_mix(rows)) for p, x in enumerate(s))
        assert Counter((r.doc_id, r.mix_pass, r.mix_shard) for r in mixing.mix_documents(docs).collect()) == drawn


def test_layout_keeps_pieces_whole_and_shuffled(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE_WORDS", 100)
    docs = frame(spark, ["w " * (i % 9 + 1) for i in range(600)], [f"s{i % 3}" for i in range(600)])
    mixed = mixing.mix_documents(docs, 4, layout=True)
    parts = mixed.rdd.glom().collect()
    rows = [r for p in parts for r in p]
    words = sum(len(r.text.split()) for r in rows)
    pieces = -(-words // 400)
    assert pieces > 3
    where = defaultdict(set)
    for k, p in enumerate(parts):
        at = [(r.mix_shard, r.mix_order) for r in p]
        assert at == sorted(at)
        for s, o in at:
            where[s, int(o * pieces / 2 ** 60)].add(k)
    assert len(where) == 4 * pieces and all(len(v) == 1 for v in where.values())
    assert Counter((r.doc_id, r.mix_shard, r.mix_pass, r.mix_order) for r in rows) == Counter(
        (r.doc_id, r.mix_shard, r.mix_pass, r.mix_order) for r in mixing.mix_documents(docs.repartition(3), 4).collect())
    again = mixing.mix_documents(mixed, 4)  # its own columns come in again
    assert again.columns == mixed.columns


def test_mixed_documents_hold_every_draw(spark):
    texts = [" ".join(["w"] * (i % 9 + 1)) for i in range(400)]
    docs = frame(spark, texts, [f"s{i % 3}" for i in range(400)])
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix_report(docs).collect()}
    mixed = mixing.mix_documents(docs, 8)
    assert mixed.columns[:5] == docs.columns
    rows = mixed.collect()
    assert Counter(r.doc_id for r in rows) == Counter({k: v for k, v in taken.items() if v})
    assert {r.mix_shard for r in rows} <= set(range(8))
    assert len({(r.doc_id, r.mix_pass) for r in rows}) == len(rows)  # a pass draws a document once, in one shard


def test_mixing_edges(spark, edge, empty):
    rows = mixing.mix_report(edge).collect()
    assert len(rows) == edge.count() and all(r.taken == 0 for r in rows if not r.size)
    assert mixing.mix_report(empty).count() == 0 and mixing.mix_documents(empty).count() == 0
    blank = frame(spark, ["", None, " "])
    assert [r.target for r in mixing.mix_report(blank).collect()] == [0.0] * 3
    assert set(edge.columns) < set(mixing.mix_documents(edge).columns)


def test_mix_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF001}/documents.parquet'")
    cur = con.execute(oracle.ORACLES["op5_mix_sources"])
    cols = [d[0] for d in cur.description]
    want = sorted(tuple(r[cols.index(c)] for c in sorted(cols)) for r in cur.fetchall())
    df = queries.queries()["op5_mix_sources"](spark, SF001)
    assert sorted(map(tuple, df.select(*sorted(df.columns)).collect())) == want


def test_empty_documents_are_drawn_as_often_as_the_cap_allows(spark):
    """A source at its cap has three whole passes and nothing left over, also for its documents without words."""
    rows = [(i, "a", "w " * 3 if i < 20 else "") for i in range(220)] + [(1000 + i, "b", "w " * 900) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    targets = {r.source_size: r.target for r in mixing.mix_report(docs).collect()}
    assert targets[60] == 180
    drawn = {r.doc_id: r["count"] for r in mixing.mix_documents(docs).groupBy("doc_id").count().collect()}
    assert all(drawn[i] == 3 for i in range(220)) and max(drawn.values()) == 3
