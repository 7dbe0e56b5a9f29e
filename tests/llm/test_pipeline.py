"""The pipeline's stages on their own input: toxicity against its scores and the labels, the others against brute force."""

from collections import Counter

import pytest

import corpus_pipeline as P
from huddle.llm import toxicity
from huddle.llm.common import stage_table
from tests.conftest import SF001
from tests.llm.test_decontam import brute as leaks
from tests.llm.test_dedup import brute as groups, shingles
from tests.llm.test_sharding_mixing import brute_mix, brute_shards


@pytest.fixture(scope="module")
def stages(spark):
    """(input rows, output rows) of every stage over sf0.001."""
    docs, out = spark.read.parquet(f"{SF001}/documents.parquet"), {}
    for name, f in P.STAGES:
        before, cols = docs.collect(), docs.columns
        docs = stage_table(spark, f(spark, docs, SF001), f"t-{name}")
        out[name] = (before, docs.collect(), cols, docs.columns)
    return out


def test_names_order_and_columns(stages):
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert all(s[2] == s[3] for name, s in stages.items() if name != "sharding")


def test_toxicity(spark, stages):
    before, after, _, _ = stages["toxicity"]
    docs = spark.createDataFrame(before)
    scores = {r.doc_id: r.score for r in toxicity.score_documents(
        docs, toxicity.fit(docs, spark.read.parquet(f"{SF001}/labels.parquet"))).collect()}
    assert sorted(r.doc_id for r in after) == sorted(i for i, s in scores.items() if s < 0.5)
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    lost = [i for i, s in scores.items() if s >= 0.5 and truth.get(i) == 0]
    assert len(lost) <= 0.02 * len(before)


def test_near_duplicates(stages):
    before, after, _, _ = stages["near_duplicates"]
    want = {d for d, _, _, kept in groups([(r.doc_id, r.text) for r in before]) if kept}
    assert sorted(r.doc_id for r in after) == sorted(want)
    assert all(shingles(r.text) or r.doc_id in want for r in before)


def test_decontamination(spark, stages):
    before, after, _, _ = stages["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    want = {r[0] for r in leaks([(r.doc_id, r.text) for r in before], items) if not r[5]}
    assert sorted(r.doc_id for r in after) == sorted(want)


def test_mixing(stages):
    before, after, _, _ = stages["mixing"]
    drawn = brute_mix([(r.doc_id, r.text, r.source) for r in before])
    want = Counter({r.doc_id: len(s) for r, (_, s) in zip(before, drawn) if s})
    assert Counter(r.doc_id for r in after) == want and max(want.values()) <= 3
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_sharding(stages):
    before, after, _, _ = stages["sharding"]
    assert sorted((r.doc_id, r.shard, r.slot) for r in after) == brute_shards([(r.doc_id, r.text, r.source) for r in before])


def test_run_with_nulls_and_clashing_columns(spark, edge, tmp_path):
    edge.write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, f in P.STAGES:
        cols, docs = docs.columns, stage_table(spark, f(spark, docs, str(tmp_path)), f"n-{name}")
        assert docs.columns == cols or name == "sharding"
    assert docs.count() > 0


def test_run_on_empty_tables(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
