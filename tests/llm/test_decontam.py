"""Winnowing against a scan for every window."""

import hashlib
import random
import re

from huddle.llm import decontam
from tests.llm.conftest import edge_rows, frame, words

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def cut(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item_id, text in items:
        w = cut(text)
        k = min(10, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[a:a + k]), set()).add(None if item_id is None else str(item_id))
    lengths = {len(k) for k in windows}
    out = []
    for doc_id, text in docs:
        w, hit, seen = cut(text), set(), set()
        for k in lengths:
            for a in range(len(w) - k + 1):
                if (got := windows.get(tuple(w[a:a + k]))) is not None:
                    seen |= {x for x in got if x is not None}
                    hit.update(range(a, a + k))
        text_of = ",".join(sorted(seen))
        out.append((doc_id, len(w), len(hit), len(seen), hashlib.sha256(text_of.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def run(docs, items):
    return sorted((tuple(r)[:6] for r in decontam.hit_report(docs, items).collect()), key=repr)


def test_every_window_is_found(spark):
    rng = random.Random(6)
    items = [(i, " ".join(words(rng, rng.randrange(0, 40)))) for i in range(40)] + [(40, "Tiny item"), (41, "!!"), (42, None)]
    items += [(100 + i, items[5][1]) for i in range(3)]  # items that share their windows
    texts = []
    for i in range(400):
        w = words(rng, rng.randrange(0, 120))
        if i % 3 == 0:
            src = cut(rng.choice(items)[1])
            n = rng.randrange(5, 30)
            a = rng.randrange(max(1, len(src)))
            w[3:3] = src[a:a + n]
        texts.append(rng.choice([" ", ", ", "\n"]).join(x.upper() if rng.random() < 0.2 else x for x in w))
    texts += ["A tiny ITEM, here", "tiny", "item tiny"] + [items[7][1]] * 30
    idf = spark.createDataFrame(items, "item_id bigint, text string")
    assert run(frame(spark, texts), idf) == brute(list(enumerate(texts)), items)
    kept = decontam.drop_contaminated(frame(spark, texts), idf)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean = {r[0] for r in brute(list(enumerate(texts)), items) if not r[5]}
    assert {r.doc_id for r in kept.collect()} == clean


def test_edges(spark, edge, empty):
    rows = [(r[0], r[1]) for r in edge_rows()]
    items = [(1, "one"), (2, "a b c d e"), (None, "two words"), (3, rows[8][1][:200]), (3, rows[8][1][:200]), (4, "漢字")]
    idf = spark.createDataFrame(items, "item_id bigint, text string")
    assert run(edge, idf) == brute(rows, items)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert run(edge, none) == brute(rows, [])
    assert decontam.hit_report(empty, idf).count() == 0
    assert decontam.drop_contaminated(edge, none).count() == edge.count()
    assert decontam.drop_contaminated(edge, idf).columns == edge.columns
