"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from huddle.session import scratch_path

MEMO_ENTRIES = 400_000
HASH_ENTRIES = 150_000  # a word's hash is cheap to make again


class Memo(dict):
    """A bounded word -> value cache. When it is full, further words are computed
    each time: the frequent ones came early, and no result is lost."""

    def __init__(self, make: Callable, limit: int = MEMO_ENTRIES):
        super().__init__()
        self._make, self._limit = make, limit

    def __missing__(self, key):
        value = self._make(key)
        if len(self) < self._limit:
            self[key] = value
        return value


def hash_memo(limit: int = HASH_ENTRIES) -> Memo:
    """64-bit hashes of words."""
    return Memo(xxhash.xxh64_intdigest, limit)


def hash_words(words: list[bytes], memo: Memo) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """64-bit hashes of all runs of ``k`` consecutive word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    salt = np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    acc = mix64(words[:n] ^ salt)
    for j in range(1, k):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n])
    return acc


def row_hashes(grams: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of the rows of a matrix of word hashes."""
    salt = np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    acc = mix64(grams[:, 0] ^ salt)
    for j in range(1, grams.shape[1]):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + grams[:, j])
    return acc


# Words are runs of letters A-Z (lowered), digits and bytes from 0x80 on; the rest separates them
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def held_out(id_col: str) -> Column:
    """Whether a row is kept from fitting: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def bounded_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id_col: str, label_col: str,
                   most: int, seed: int) -> tuple[DataFrame, np.ndarray]:
    """(t, label, h) of at most ``most`` labelled rows that are not held out, and how many
    labelled rows each sampled row of a class stands for.

    Each class gives the half of the sample with the smallest hashes of its ids. The
    list of ids is bounded, so it is broadcast to the documents and no text is shuffled.
    """
    known = (labels.select(F.col(label_id_col).alias("__id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("__id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("__id"))
             .withColumn("h", hash60(F.lit(seed), "__id")))
    total = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = min(total.get(0, 0), total.get(1, 0), most // 2)
    quota = {c: min(total.get(c, 0), most - few if total.get(c, 0) > most // 2 else most // 2) for c in (0, 1)}
    taken = None
    for c in (0, 1):
        part = known.where(F.col("label") == c).orderBy("h", "__id").limit(quota[c])
        taken = part if taken is None else taken.unionByName(part)
    share = np.array([total.get(c, 0) / max(1, quota[c]) for c in (0, 1)])
    text = F.coalesce(text_bytes(text_col), F.lit(b""))
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("t")).join(F.broadcast(taken), "__id")
    return rows.dropDuplicates(["__id"]).select("t", "label", "h"), share


def id_key(id_col: str, text_col: str) -> Column:
    """The id as text; rows without an id are told apart by their text, so that they are no single hot key."""
    return F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("~null"), text_key(text_col)))


def stage_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def source_key(col: str | Column) -> Column:
    """A non-null join key for a source name: null sorts and joins as its own source."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~null"))


def hash60(*parts: Column | str) -> Column:
    """A uniform 60-bit number from the first 15 hex digits of an md5; any SQL engine can repeat it."""
    cols = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("~null")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols).cast("binary")), 1, 15), 16, 10).cast("bigint")


SLOT_BITS = 23


def slot_filter(keys: DataFrame, col: str, bits: int = SLOT_BITS) -> bytes:
    """A bitmap of the leading bits of 64-bit hashes: 2^bits bits however many hashes there are.

    It lets rows be dropped in a scan that cannot match; what passes is still joined
    exactly, so a fuller bitmap costs time and changes nothing.
    """
    slot = F.shiftrightunsigned(col, 64 - bits)
    pages = keys.select(slot.alias("s")).distinct().groupBy(F.shiftright("s", 12).alias("page")).agg(
        F.collect_set((F.col("s") % 4096).cast("int")).alias("at"))  # at most 4096 numbers a page
    out = np.zeros(1 << bits, bool)
    for r in pages.collect():  # at most 2^(bits - 12) pages
        out[r["page"] * 4096 + np.array(r["at"], np.int64)] = True
    return np.packbits(out).tobytes()


class SlotFilter:
    """The bitmap of ``slot_filter`` in a task."""

    def __init__(self, packed: bytes):
        self.set = np.unpackbits(np.frombuffer(packed, np.uint8)).view(bool)
        self.shift = np.uint64(64 - (len(self.set).bit_length() - 1))

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        return self.set[(hashes.view(np.uint64) >> self.shift).astype(np.int64)]


def text_bytes(col: str) -> Column:
    """The UTF-8 bytes of a text column."""
    return F.col(col).cast("string").cast("binary")


def text_key(col: str) -> Column:
    """A 128-bit key of a text; null and empty texts share one."""
    return F.md5(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def batches(it: Iterable[pa.RecordBatch], size: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller slices of Arrow batches, so that a task holds few texts' results at once.

    A worker lives on after its task: what Arrow keeps of the batches for later use is given back at the end.
    """
    for b in it:
        for at in range(0, b.num_rows, size):
            yield b.slice(at, size)
    b = None
    pa.default_memory_pool().release_unused()
