"""Spelling variants against a plain comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from huddle.llm import variants as V
from tests.llm.conftest import edge_rows, frame


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def near(a, b):
    """Exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, least=3):
    """Sorted (word, form, root, n, n_near, form_n); rows are (id, text)."""
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = 1 if doc is None else zlib.crc32(f"{doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 5:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= least}
    links = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, ws in links.items():
        best = min(ws, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(links[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=repr)


def misspelt(rng, n, letters="abé"):
    """Words over few letters, so that nearly all have near words; frequencies fall off steeply."""
    words = ["".join(rng.choices(letters, k=rng.randrange(4, 9))) for _ in range(n)]
    weights = [1 / (i + 1) for i in range(n)]
    return [" ".join(w.upper() if rng.random() < .1 else w for w in rng.choices(words, weights, k=120)) for _ in range(60)]


@pytest.mark.parametrize("block", [512, 7])
def test_variants_equal_all_pairs(spark, block):
    texts = misspelt(random.Random(7), 400) + ["ÀBCDE àbcde àbcde abcdé", "x" * 300 + " " + "x" * 299, "x" * 300, "x" * 300]
    texts += ["x" * 299] * 7 + ["y" * 254 + " " + "y" * 255 + " " + "y" * 256] * 3
    out = got(V.variant_report(frame(spark, texts), block=block))
    want = brute(list(enumerate(texts)))
    assert out == want
    assert any(r[1] and r[1] != r[2] for r in want) and max(r[4] for r in want) > 5


def test_hot_beginning(spark):
    """A third of all words share a beginning: its group is cut into blocks and still whole."""
    rng = random.Random(8)
    words = list({"prefi" + "".join(rng.choices("abcdefg", k=4)) for _ in range(500)} | {"".join(rng.choices("abc", k=6)) for _ in range(300)})
    texts = [" ".join(rng.sample(words, 400)) for _ in range(12)]
    assert got(V.variant_report(frame(spark, texts), block=20)) == brute(list(enumerate(texts)))
    blocks = V.tiles(V.word_counts(frame(spark, texts)), 20).groupBy("m", "side", "half", "ti", "tj").count()
    assert blocks.agg({"count": "max"}).first()[0] < 100


def test_long_chain(spark):
    words = ["b" * k for k in range(5, 12)]
    texts = [" ".join(w for i, w in enumerate(words) for _ in range(3 * 3 ** i))] * 2
    out = got(V.variant_report(frame(spark, texts)))
    assert out == brute(list(enumerate(texts)))
    rows = {r[0]: r[1:3] for r in out}
    assert rows["b" * 5] == ("b" * 6, "b" * 11) and rows["b" * 11] == (None, "b" * 11)


def test_edges(spark, edge, empty):
    rows = [(r[0], r[1]) for r in edge_rows()]
    assert got(V.variant_report(edge, min_count=1)) == brute(rows, 1)
    assert got(V.variant_report(edge)) == brute(rows)
    assert V.variant_report(empty).count() == 0
    assert V.variant_report(frame(spark, ["no repeated words here"])).count() == 0
