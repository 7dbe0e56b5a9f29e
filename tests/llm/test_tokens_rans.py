"""Token counts and rANS files against the tokenizers library."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from huddle.llm import rans, tokens
from huddle.llm.pretokens import PreTokenizer
from huddle.session import scratch_path
from tests.llm.conftest import edge_rows, frame

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PIECES = ["a", "B", "é", " ", " ", "  ", "\n", "'s", "'S", "'", "12", "<|endoftext|>", "<|", "!", "\t", "\x1c", "\x85", "\xa0",
          "…", "ß", "Σ", "一", "あ", "​", "²", "½", "́", "😀", "ö", "'re", "\x00", "İ", "ǅ", "ʼ", "\r\n", "я", "가"]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_chunked_encoding_equals_the_library(path):
    rng, pre, enc, count = random.Random(4), PreTokenizer(path), rans.Encoder(path, "<u4"), tokens.Counts(path)
    for _ in range(3000):
        text = "".join(rng.choices(PIECES[:rng.choice((12, len(PIECES)))], k=rng.randrange(14)))
        want = pre.whole(text)
        assert count(text) == len(want), repr(text)
        if path == WORD:
            assert np.frombuffer(enc(text), "<u4").tolist() == want, repr(text)


def test_counts(spark, edge, empty):
    pre = PreTokenizer(BYTE)
    got = sorted((tuple(r) for r in tokens.count_tokens(edge, BYTE).collect()), key=repr)
    want = sorted(((r[0], len((r[1] or "").encode()), n, n > 512) for r in edge_rows() for n in [len(pre.whole(r[1] or ""))]), key=repr)
    assert got == want
    assert tokens.count_tokens(empty, BYTE).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 1023, 1025, 70_000])
def test_block_round_trip_and_checkpoints(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 49_408).astype("<u2")
    table = rans.FrequencyTable(rans.scale_counts(np.bincount(ids, minlength=49_408) + (rng.random(49_408) < 0.1)))
    assert int(table.freq.sum()) == 1 << 16
    payload, points = rans.encode_block(ids, table, lanes=64, every=16)
    assert (rans.decode_block(payload, points, n, table, 64) == ids).all()
    width = 16 + 4 * 64
    for i in range(len(points) // width):  # every part decodes from its checkpoint alone
        part = rans.decode_steps(payload, points[i * width:(i + 1) * width], n, (i + 1) * 16, table, 64)
        assert (part == ids[i * 16 * 64:(i + 1) * 16 * 64]).all()


def test_single_symbol_block():
    table = rans.FrequencyTable(rans.scale_counts(np.bincount([1], minlength=10)))
    payload, points = rans.encode_block(np.ones(500, "<u2"), table, lanes=8)
    assert (rans.decode_block(payload, points, 500, table, 8) == 1).all()


def expected(rows):
    pre, at, out = PreTokenizer(WORD), 0, []
    for doc_id, text in rows:
        ids = pre.whole(text or "") + [1]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_files_round_trip(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["Alpha", "beta,", "42", "Gämma", "<|endoftext|>", "x"], k=rng.randrange(300))) for _ in range(150)]
    path = scratch_path(spark, "t-rans")
    got = rans.round_trip(frame(spark, texts), WORD, path, vocab=49_408).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected(list(enumerate(texts)))
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.agg(F.sum("n_symbols")).first()[0] == sum(r.n_tokens for r in got)


def test_files_edges(spark, edge, empty):
    got = rans.round_trip(edge, WORD, scratch_path(spark, "t-rans"), vocab=49_408).collect()
    assert len(got) == edge.count()
    assert sorted((r.doc_id is not None, r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (d is not None, d, n, c) for d, _, n, c in expected([(r[0], r[1]) for r in edge_rows()]))
    ends = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    in_order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert in_order == sorted(in_order, key=lambda d: (d is not None, d))
    assert rans.round_trip(empty, WORD, scratch_path(spark, "t-rans"), vocab=49_408).count() == 0


def test_damage_is_found(spark):
    path = scratch_path(spark, "t-rans")
    rans.encode_files(frame(spark, ["some text to spoil"] * 5), WORD, path, vocab=49_408)
    blocks = spark.read.parquet(f"{path}/blocks")
    bad = scratch_path(spark, "t-rans-bad")
    blocks.withColumn("ids_crc", F.col("ids_crc") + 1).write.parquet(f"{bad}/blocks")
    spark.read.parquet(f"{path}/table").write.parquet(f"{bad}/table")
    with pytest.raises(Exception, match="damaged"):
        rans.decode_files(spark, bad, 49_408).count()


def test_words_of_letters_skip_the_pattern_and_the_coder_stays_in_32_bits():
    encode = rans.Encoder(WORD, "<u2")
    words, text = encode.pre.pattern, "Alpha gämma beta Gämma"

    class Unused:
        def findall(self, chunk):
            raise AssertionError(chunk)
    encode.pre.pattern = Unused()
    try:
        got = encode(text)
    finally:
        encode.pre.pattern = words
    assert list(np.frombuffer(got, "<u2")) == encode.pre.whole(text)
    only = rans.FrequencyTable(rans.scale_counts(np.array([0, 9, 0])))  # one symbol holds all 2^16 slots
    assert only.freq.dtype == only.start.dtype == only.slot_place.dtype == np.uint32 and int(only.freq[1]) == 1 << 16
    ids = np.ones(5000, np.uint16)
    assert np.array_equal(rans.decode_block(*rans.encode_block(ids, only), len(ids), only), ids)


@pytest.mark.parametrize("limit", [5_000, 50])
def test_a_worker_holds_a_word_once(monkeypatch, limit):
    """Words alone, beside marks and inside other chunks: one table of at most ``limit`` entries, the library's ids."""
    enc = rans.Encoder(WORD, "<u2")
    enc.plain._limit, enc.pre = limit, PreTokenizer(WORD)
    for w in map("wor{}".format, map("".join, itertools.product("abcdefghij", repeat=3))):
        text = f"{w} {w}, {w}'s ({w}) {w}"
        assert np.frombuffer(enc(text), "<u2").tolist() == enc.pre.whole(text)
    held = [k for t in (enc.plain, enc.spaced, enc.pre._pieces) for k in t]
    assert len(held) == len(set(held)) <= limit
