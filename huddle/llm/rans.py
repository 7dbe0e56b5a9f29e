"""Token-ID files coded with a static range asymmetric numeral system (rANS).

One frequency table, counted over all documents, is shared by every block. A
block is a run of whole documents in ascending order of id; its ids are dealt to
``lanes`` interleaved coders that step together (one NumPy operation per step
moves all lanes). Blocks are independent; each carries checkpoints (the lane
states and the stream position every ``CHECKPOINT_STEPS`` steps) so that its
parts can be decoded apart, and CRC-32 sums of the stream and of the ids.

Coder: 32-bit states in [2^16, 2^32), 16-bit words, frequencies that sum to
2^16; every symbol of the vocabulary in use has a frequency of at least 1, so any
text can be coded. Encoding runs from the last step to the first, decoding
forward; a step emits its lanes' words in lane order.

Files: one Parquet row per block (header fields, payload, checkpoints, document
index), written by Spark's committer, so a lost executor leaves no partial block
and any reader that Spark has can fetch single blocks.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from huddle.llm.common import batches, stage_table
from huddle.llm.pretokens import ChunkMemo, WordMemo, pretokenizer

END_ID = 1
SCALE_BITS = 16
LANES = 1024
BLOCK_SYMBOLS = 1 << 18
CHECKPOINT_STEPS = 128
LOW = np.uint32(1 << 16)

BLOCK_SCHEMA = ("part int, block int, n_symbols bigint, lanes int, payload binary, checkpoints binary, "
                "stream_crc bigint, ids_crc bigint, doc_ids array<{id}>, lengths array<bigint>")


class FrequencyTable:
    """Static frequencies that sum to 2^16: cumulative starts, and by slot its symbol, frequency and place in it.

    No step of the coder leaves 32 bits, so all tables have that width.
    """

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint32)
        self.start = np.zeros(len(freq), np.uint32)
        self.start[1:] = np.cumsum(self.freq)[:-1]
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
        self.slot_freq = self.freq[self.symbol]
        self.slot_place = np.arange(len(self.symbol), dtype=np.uint32) - self.start[self.symbol]


def scale_counts(counts: np.ndarray) -> np.ndarray:
    """Integer frequencies with sum 2^16, at least 1 for every symbol that occurs."""
    total, size = int(counts.sum()), 1 << SCALE_BITS
    used = counts > 0
    if int(used.sum()) > size:
        raise ValueError("more symbols than slots")
    if not total:
        freq = np.zeros(len(counts), np.int64)
        freq[:1] = size
        return freq
    spare = size - int(used.sum())
    freq = used.astype(np.int64) + (counts.astype(np.float64) * spare / total).astype(np.int64)
    freq[int(counts.argmax())] += size - int(freq.sum())
    return freq


def encode_block(ids: np.ndarray, table: FrequencyTable, lanes: int = LANES,
                 every: int = CHECKPOINT_STEPS) -> tuple[bytes, bytes]:
    """(payload, checkpoints) of a block of ids. The payload is the words in decoding order; a
    checkpoint is a step, a position in the words and all lane states before that step."""
    steps = -(-len(ids) // lanes)
    state = np.full(lanes, LOW, np.uint32)
    half = np.uint32(16)
    freq, start = table.freq[ids], table.start[ids]
    words: list[np.ndarray] = []
    marks: list[tuple[int, int, np.ndarray]] = []
    written = 0
    for step in range(steps - 1, -1, -1):
        f = freq[step * lanes:(step + 1) * lanes]
        x = state[:len(f)]
        high = x >> half
        over = high >= f  # such a state renormalises first
        out = x[over]
        words.append(out.astype("<u2"))
        written += len(out)
        x = np.where(over, high, x)
        q = x // f
        state[:len(f)] = (q << half) + (x - q * f) + start[step * lanes:(step + 1) * lanes]
        if step % every == 0:
            marks.append((step, written, state.astype("<u4")))
    payload = b"".join(w.tobytes() for w in reversed(words))
    points = b"".join(np.array([step, written - at], "<u8").tobytes() + st.tobytes() for step, at, st in reversed(marks))
    return payload, points


def decode_steps(payload: bytes, checkpoint: bytes, n_symbols: int, upto: int, table: FrequencyTable,
                 lanes: int = LANES) -> np.ndarray:
    """Ids of the steps from a checkpoint up to (not including) step ``upto``."""
    step, at = (int(v) for v in np.frombuffer(checkpoint, "<u8", 2))
    state = np.frombuffer(checkpoint, "<u4", lanes, 16).astype(np.uint32)
    words = np.frombuffer(payload, "<u2")
    low16, half = np.uint32(0xFFFF), np.uint32(16)
    upto = min(upto, -(-n_symbols // lanes))
    out = np.empty(max(0, min(upto * lanes, n_symbols) - step * lanes), np.uint32)
    done = 0
    for t in range(step, upto):
        n = min(lanes, n_symbols - t * lanes)
        x = state[:n]
        slot = x & low16
        out[done:done + n] = table.symbol[slot]
        done += n
        x = table.slot_freq[slot] * (x >> half) + table.slot_place[slot]
        need = np.flatnonzero(x < LOW)
        if len(need):
            x[need] = (x[need] << half) | words[at:at + len(need)]
            at += len(need)
        state[:n] = x
    return out


def decode_block(payload: bytes, checkpoints: bytes, n_symbols: int, table: FrequencyTable, lanes: int = LANES) -> np.ndarray:
    """All ids of a block, from its first checkpoint on."""
    return decode_steps(payload, checkpoints, n_symbols, 1 << 62, table, lanes) if n_symbols else np.empty(0, np.uint32)


class Encoder:
    """Texts to little-endian id bytes; each distinct chunk is encoded once per worker.

    A worker keeps its tables for all tasks to come, beside the coders', so there is one table for a file of words only.
    """

    def __init__(self, path: str, dtype: str):
        self.pre, self.dtype = pretokenizer(path), dtype
        letter = {"<u2": "H", "<u4": "I"}[dtype]
        pack = lambda ids: struct.pack(f"<{len(ids)}{letter}", *ids)
        if self.pre.words_only:
            self.plain = WordMemo(lambda c: self.pre.pattern.findall(c), lambda p: pack(self.pre.encode_pretoken(p)))
        else:
            self.plain = ChunkMemo(lambda c: pack(self.pre.encode_chunk(c)))
        self.spaced = ChunkMemo(lambda c: pack(self.pre.encode_chunk(" " + c)))
        self.pack = pack

    def __call__(self, text: str) -> bytes:
        parts = self.pre.parts(text)
        if parts is None:
            return self.pack(self.pre.whole(text))
        if self.pre.words_only and len(parts) == 1:  # nearly every text of such a file
            return b"".join(map(self.plain.__getitem__, self.pre.chunks(parts[0])[0]))
        out = []
        for part in parts:
            if isinstance(part, int):
                out.append([self.pack([part])])
            else:
                plain, spaced = self.pre.chunks(part)
                out += [map(self.plain.__getitem__, plain), map(self.spaced.__getitem__, spaced)]
        return b"".join(chain.from_iterable(out))


@lru_cache(maxsize=4)
def encoder(path: str, dtype: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path, dtype)


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, wide: bool) -> DataFrame:
    """doc_id and the packed ids of every row (16 bits each, or 32 for large vocabularies)."""
    dtype = "<u4" if wide else "<u2"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(it):
        encode, end = encoder(tokenizer_path, dtype), np.array([END_ID], dtype).tobytes()
        for b in batches(it, 1024):
            ids = [encode(t) + end for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def symbol_counts(tokens: DataFrame, vocab: int, wide: bool) -> np.ndarray:
    """How often each id occurs in all documents: one partial histogram per task."""
    dtype = "<u4" if wide else "<u2"

    def run(it):
        total = np.zeros(vocab, np.int64)
        for b in batches(it, 2048):
            total += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), dtype), minlength=vocab)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["s", "n"])

    rows = tokens.select("ids").mapInArrow(run, "s int, n bigint").groupBy("s").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(vocab, np.int64)  # at most one row per id of the vocabulary
    for r in rows:
        out[r["s"]] = r["n"]
    return out


def encode_files(docs: DataFrame, tokenizer_path: str, path: str, *, vocab: int, id_col: str = "doc_id",
                 text_col: str = "text", lanes: int = LANES, block_symbols: int = BLOCK_SYMBOLS,
                 files: int | None = None) -> np.ndarray:
    """Write the block files in ascending order of id; returns the frequencies to decode them with
    (also stored beside them, in ``path/table``)."""
    spark = docs.sparkSession
    wide = vocab > 1 << 16
    dtype = "<u4" if wide else "<u2"
    # the tie is stored, so that sampling the ranges of the order reads no ids
    tokens = stage_table(spark, tokenize(docs, tokenizer_path, id_col, text_col, wide).withColumn("__tie", F.xxhash64("ids")),
                         "token-ids")
    freq = scale_counts(symbol_counts(tokens, vocab, wide))
    shared = spark.sparkContext.broadcast(freq)  # one number per id of the vocabulary
    id_type = tokens.schema["doc_id"].dataType.simpleString()
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (tokens.repartitionByRange(n, "doc_id", "__tie")
               .sortWithinPartitions("doc_id", "__tie").select(F.spark_partition_id().alias("part"), "doc_id", "ids"))
    schema = BLOCK_SCHEMA.format(id=id_type)
    arrow_id = pa.string() if id_type == "string" else None

    def pack(part: int, block: int, ids: list[bytes], doc_ids: list, table: FrequencyTable) -> dict:
        raw = b"".join(ids)
        symbols = np.frombuffer(raw, dtype)
        payload, points = encode_block(symbols, table, lanes)
        width = np.dtype(dtype).itemsize
        return {"part": part, "block": block, "n_symbols": len(symbols), "lanes": lanes, "payload": payload,
                "checkpoints": points, "stream_crc": zlib.crc32(payload), "ids_crc": zlib.crc32(symbols.astype("<u4").tobytes()),
                "doc_ids": doc_ids, "lengths": [len(x) // width for x in ids]}

    def run(it):
        table = FrequencyTable(shared.value)
        ids, doc_ids, held, block, part = [], [], 0, 0, 0
        for b in batches(it, 1024):
            part = b.column(0)[0].as_py() if b.num_rows else part
            kind = arrow_id or b.schema.field(1).type
            for d, x in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                ids.append(x)
                doc_ids.append(d)
                held += len(x)
                if held >= block_symbols * np.dtype(dtype).itemsize:
                    yield _batch(pack(part, block, ids, doc_ids, table), kind)
                    ids, doc_ids, held, block = [], [], 0, block + 1
        if ids:
            yield _batch(pack(part, block, ids, doc_ids, table), kind)

    ordered.mapInArrow(run, schema).write.mode("overwrite").parquet(f"{path}/blocks")
    spark.createDataFrame([(i, int(f)) for i, f in enumerate(freq) if f], "symbol int, freq int").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/table")
    return freq


def _batch(row: dict, kind: pa.DataType) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(),
             pa.list_(kind), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types)], names=list(row))


def read_table(spark: SparkSession, path: str, vocab: int) -> np.ndarray:
    freq = np.zeros(vocab, np.int64)
    for r in spark.read.parquet(f"{path}/table").collect():  # at most one row per id of the vocabulary
        freq[r["symbol"]] = r["freq"]
    return freq


def decode_files(spark: SparkSession, path: str, vocab: int) -> DataFrame:
    """part, block, place, doc_id, n_tokens, ids_crc32, ids_before (in the block) of every document in the files.

    Blocks whose stream or ids do not match their sums raise.
    """
    shared = spark.sparkContext.broadcast(read_table(spark, path, vocab))
    blocks = spark.read.parquet(f"{path}/blocks")
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(it):
        table = FrequencyTable(shared.value)
        for b in batches(it, 1):
            r = {k: v[0] for k, v in b.to_pydict().items()}
            if zlib.crc32(r["payload"]) != r["stream_crc"]:
                raise ValueError(f"stream of block {r['part']}/{r['block']} is damaged")
            raw = decode_block(r["payload"], r["checkpoints"], r["n_symbols"], table, r["lanes"]).astype("<u4").tobytes()
            if zlib.crc32(raw) != r["ids_crc"]:
                raise ValueError(f"ids of block {r['part']}/{r['block']} are damaged")
            n = np.array(r["lengths"], np.int64)
            at = np.concatenate([[0], np.cumsum(n)])
            crc = [zlib.crc32(memoryview(raw)[4 * at[i]:4 * at[i + 1]]) for i in range(len(n))]
            kind = b.schema.field("doc_ids").type.value_type
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), r["part"], np.int32)), pa.array(np.full(len(n), r["block"], np.int32)),
                 pa.array(r["doc_ids"], kind), pa.array(n), pa.array(at[:-1]), pa.array(crc, pa.int64())],
                names=["part", "block", "doc_id", "n_tokens", "ids_before", "ids_crc32"])

    return blocks.mapInArrow(run, f"part int, block int, doc_id {id_type}, n_tokens bigint, ids_before bigint, ids_crc32 bigint")


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """part, block, start: ids before each block. Sums run inside a file, then over files."""
    b = spark.read.parquet(f"{path}/blocks").select("part", "block", "n_symbols")
    files = b.groupBy("part").agg(F.sum("n_symbols").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = files.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__file"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return b.withColumn("__in", F.coalesce(F.sum("n_symbols").over(inside), F.lit(0))).join(files, "part").select(
        "part", "block", (F.col("__file") + F.col("__in")).alias("start"))


def round_trip(docs: DataFrame, tokenizer_path: str, path: str, *, vocab: int, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row, read back from the files written to ``path``.

    Cases: a null or empty text is the end id alone; null ids sort first; rows that
    share an id follow each other in the order of a hash of their ids; a text longer
    than a block makes a longer block; an empty table writes no block and gives an
    empty result. Extra columns are ignored.
    """
    spark = docs.sparkSession
    encode_files(docs, tokenizer_path, path, vocab=vocab, id_col=id_col, text_col=text_col)
    rows = decode_files(spark, path, vocab).join(block_starts(spark, path), ["part", "block"])
    return rows.select("doc_id", (F.col("start") + F.col("ids_before")).alias("start"), "n_tokens", "ids_crc32")
