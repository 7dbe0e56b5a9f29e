"""Spelling variant grouping by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point turns one into the
other. That is so exactly when the lengths of their common prefix and common suffix
together reach the longer length minus one. The words of a tile are laid out as padded
matrices of code points, once from the left and once from the right; comparing two
blocks column by column gives both lengths for all pairs of the tile at once.

Which blocks meet: of a near pair whose longer word has M letters, either the first
ceil(M/2) letters agree or the last floor(M/2) do. So a word enters, for M its own
length and one more, the group of its beginning and the group of its end. A pair that
agrees in the beginning counts there, any other near pair at the end: once in all.

Scale: only words and counts are shuffled. Occurrences are added up in the task first.
Groups beyond a block are cut into blocks by a hash, and every pair of blocks is a tile
of its own, so a beginning that a third of all words share is many small tasks. A tile
hands on one row a word (its near words' number and the best of them), not its pairs.
Forms only ever lead to a word at least twice as frequent, so chains are short, and
pointer doubling finds their ends in a few joins.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from huddle.llm.common import batches, stage_table

# Words are runs of these letters, of at least five; one run in 97 of a document loses a letter
MIN_LETTERS, MIN_COUNT, FORM_RATIO, DAMAGE = 5, 3, 2, 97
RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LETTERS)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

BLOCK = 512  # words of a block, on average
CELLS = 1 << 22  # letters of a block at most; blocks of very long words are smaller
PACK = 256  # words of small groups that are compared together
FLUSH = 200_000  # distinct words that a counting task holds
COUNTS = "word string, n bigint"
BEST = "word string, n_near bigint, best_n bigint, best string"


def damaged(run: str, h: int) -> str:
    """The run, without one letter where 97 divides its checksum."""
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count(it):
    total: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.string()), pa.array(list(total.values()), pa.int64())],
                                          names=["word", "n"])
    for b in batches(it, 64):
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if not text:
                continue
            runs = Counter(RUN.findall(text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")))
            start = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode())
            for run, n in runs.items():
                word = run if start is None else damaged(run, zlib.crc32(run.encode(), start))
                if len(word) >= MIN_LETTERS:
                    total[word] += n
        if len(total) > FLUSH:
            yield out()
            total.clear()
    yield out()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): all words of at least five letters and ``min_count`` occurrences."""
    rows = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
    counts = rows.mapInArrow(_count, COUNTS).groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


def tiles(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """(m, side, half, ti, tj, b, word, n): every word in every tile that it takes part in."""
    def entry(longer: int, side: int) -> Column:
        m = F.char_length("word") + longer
        head, tail = F.floor((m + 1) / 2).cast("int"), F.floor(m / 2).cast("int")
        half = F.col("word").substr(F.lit(1), head) if side == 0 else F.col("word").substr(F.char_length("word") - tail + 1, tail)
        return F.struct(m.alias("m"), F.lit(side).alias("side"), half.alias("half"))
    group = ["m", "side", "half"]
    rows = vocabulary.select("word", "n", F.explode(F.array(*[entry(a, s) for a in (0, 1) for s in (0, 1)])).alias("g")).select("g.*", "word", "n")
    # a group without two words, or without one of its full length, holds no pair of its own
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("size"), F.max(F.char_length("word")).alias("longest"))
    sizes = sizes.where((F.col("size") > 1) & (F.col("longest") == F.col("m"))).select(
        *group, F.ceil(F.col("size") / F.greatest(F.lit(2), F.least(F.lit(block), F.floor(F.lit(CELLS) / F.col("m"))))).cast("int").alias("blocks"))
    blocked = rows.join(sizes, group).withColumn("b", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    return blocked.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *group, F.least("b", "x").alias("ti"), F.greatest("b", "x").alias("tj"), "b", "word", "n")


def layout(words: list[str], m: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words of m or m - 1 letters, aligned left and right, padded with zeros; one row a letter position.

    The letters are Latin-1, so a code point is a byte; a right-aligned row k holds the k-th letter from the end.
    """
    left = np.frombuffer(b"".join(w.encode("latin-1").ljust(m, b"\0") for w in words), np.uint8).reshape(len(words), m)
    right = np.frombuffer(b"".join(w.encode("latin-1")[::-1].ljust(m, b"\0") for w in words), np.uint8).reshape(len(words), m)
    return np.ascontiguousarray(left.T), np.ascontiguousarray(right.T)


def common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Lengths of the common beginnings of all rows of x with all rows of y."""
    still = np.ones((x.shape[1], y.shape[1]), np.uint8)
    total = np.zeros(still.shape, np.uint8 if len(x) < 256 else np.int32)
    for a, b in zip(x, y):
        still &= a[:, None] == b[None, :]
        if not still.any():
            break
        total += still
    return total


def near_pairs(words: list[str], other: list[str] | None, m: int, side: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the near words of two blocks (of one, if ``other`` is None) that count on this side.

    A word pads with zeros, which never equal a letter; of two words of m - 1 letters the padding agrees, but they
    are compared where m is their own length.
    """
    x = layout(words, m)
    y = x if other is None else layout(other, m)
    prefix = common(x[0], y[0])
    long_x = x[0][m - 1] > 0
    long_y = long_x if other is None else y[0][m - 1] > 0
    suffix = common(x[1], y[1])
    near = prefix.astype(np.int64) + suffix >= m - 1
    near &= (prefix >= (m + 1) // 2) == (side == 0)
    near &= long_x[:, None] | long_y[None, :]
    if other is None:
        near = np.triu(near, 1)
    return np.nonzero(near)


def _best(words: list[str], n: np.ndarray, xs: np.ndarray, ys: np.ndarray):
    """For every word with a pair: how many, and the best near word (largest n, then smallest)."""
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    a, b = np.concatenate([xs, ys]), np.concatenate([ys, xs])
    by = np.lexsort((rank[b], a))
    who, first, many = np.unique(a[by], return_index=True, return_counts=True)
    best = b[by][first]
    return [words[i] for i in who], many, n[best], [words[i] for i in best]


def _compare(it):
    """Near words within tiles; the rows come sorted by tile."""
    found = ([], [], [], [])

    def compare(rows):
        """``rows``: (b, word, n) of one tile of two blocks, or of whole groups of one m and side."""
        m, side, two = rows[0][0], rows[0][1], rows[0][3] != rows[0][4]
        words, n = [r[6] for r in rows], np.array([r[7] for r in rows], np.int64)
        if two:
            rows_of = [np.array([i for i, r in enumerate(rows) if r[5] == t], np.int64) for t in (rows[0][3], rows[0][4])]
            if not len(rows_of[0]) or not len(rows_of[1]):
                return
            xs, ys = near_pairs([words[i] for i in rows_of[0]], [words[i] for i in rows_of[1]], m, side)
            xs, ys = rows_of[0][xs], rows_of[1][ys]
        else:
            xs, ys = near_pairs(words, None, m, side)
        if len(xs):
            for all_, new in zip(found, _best(words, n, xs, ys)):
                all_.extend(new)

    def out():
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        batch = pa.RecordBatch.from_arrays([pa.array(list(map(int, c)) if k == pa.int64() else c, k) for c, k in zip(found, kinds)],
                                           names=["word", "n_near", "best_n", "best"])
        for c in found:
            c.clear()
        return batch

    # several small groups make one pack: pairs across groups share no half, so none of them counts there
    def full(rows, m):
        return len(rows) > min(PACK, CELLS // m)

    def put(pack, tile):
        """The pack after this tile: tiles of cut groups and full ones are compared alone."""
        if not tile:
            return pack
        if tile[0][3:5] != (0, 0) or full(tile, tile[0][0]):
            compare(tile)
            return pack
        if pack and (pack[0][:2] != tile[0][:2] or full(pack + tile, tile[0][0])):
            compare(pack)
            pack = []
        return pack + tile

    pack, tile, key = [], [], None
    for b in it:
        for row in zip(*[c.to_pylist() for c in b.columns]):
            if row[:5] != key:
                pack, tile, key = put(pack, tile), [], row[:5]
            tile.append(row)
        if len(found[0]) > 20_000:
            yield out()
    if pack := put(pack, tile):
        compare(pack)
    yield out()


def near_words(vocabulary: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, best, best_n): every word with the number of its near words and the best of them."""
    rows = tiles(vocabulary, block)
    at = ["m", "side", "half", "ti", "tj"]
    found = (rows.repartition(*at).sortWithinPartitions(*at).select(*at, "b", "word", "n").mapInArrow(_compare, BEST))
    every = found.select("word", F.lit(None).cast("bigint").alias("n"), "n_near", F.struct((-F.col("best_n")).alias("n"), "best").alias("b"))
    alone = vocabulary.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast(every.schema["b"].dataType).alias("b"))
    return alone.unionByName(every).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("b").alias("b")).select(
        "word", "n", "n_near", F.col("b.best").alias("best"), (-F.col("b.n")).alias("best_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for links (word, form) that form no circle: the end of every chain, by pointer doubling."""
    spark = links.sparkSession
    now = stage_table(spark, links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "variants-links")
    while now.where("moved").limit(1).count():
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        now = stage_table(spark, now.join(ahead, "root", "left").select(
            "word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")), "variants-links")
    return now.select("word", "root")


def variant_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT,
                   block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word.

    Cases: a null or empty text has no words; the words of a row with a null id are
    never damaged; repeated rows count each; ties of frequency go to the smallest word
    in code-point order; a word of any length is compared in full; an empty table, or
    one without a repeated word, gives an empty result. Extra columns are ignored.
    """
    spark = docs.sparkSession
    vocabulary = stage_table(spark, word_counts(docs, id_col, text_col, min_count), "variants-words")
    words = near_words(vocabulary, block)
    has_form = F.col("best_n") >= FORM_RATIO * F.col("n")
    words = stage_table(spark, words.select("word", F.when(has_form, F.col("best")).alias("form"), "n", "n_near",
                                            F.when(has_form, F.col("best_n")).alias("form_n")), "variants-forms")
    ends = roots(words.where(F.col("form").isNotNull()))
    return words.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
