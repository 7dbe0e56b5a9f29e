"""Near-duplicate groups by min-max hashing.

A document is the set of its distinct 5-word shingles. Under each of ``PERMS``
permutations of the hash space both the smallest and the largest hash of the set
are kept: two unbiased sketch values for one evaluation. ``BANDS`` bands of
``ROWS`` values (minima in the first half, maxima in the second, no permutation
twice in a band) put similar sets into common buckets; at similarity 0.75 a pair
misses all 32 bands with probability 5e-6.

1. Equal sets form a class; only classes go on, however many copies they have.
2. Buckets are counted; classes alone in all their buckets are done.
3. Links are confirmed on the full sets. A class is first compared with the most
   central class of its buckets (the one that meets most others), which resolves
   families of copies with one comparison per class; then with the most central
   class of another component, for ``ROUNDS`` rounds.
4. Buckets that still hold several components are settled exactly: the classes in
   them are joined on the rarest quarter of their shingles (any pair at 0.75 or
   more shares one of those), with size and position bounds, and only pairs over
   two components are compared. So no group is expanded into all its pairs, and
   no pair that shares a bucket is left undecided.
5. Components: smallest label over the links, with pointer jumping, to a fixpoint.

Scale: what is shuffled is narrow (class ids and band hashes); full sets move only
for classes that share a bucket. Fixed-size bitmaps keep the others from leaving
their tasks. Every stage is written to the shared folder, so a lost executor costs
a stage at most. Hot buckets are aggregated with map-side combine or joined, where
adaptive execution splits them; no task gathers a bucket.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from huddle.llm.common import (SlotFilter, batches, gram_hashes, hash_memo, hash_words, mix64, slot_filter, stage_table,
                               text_bytes, text_key)

SHINGLE = 5
PERCENT = 75
PERMS = 64
ROWS = 4
BANDS = 2 * PERMS // ROWS
ROUNDS = 3
ORDER_BITS = 20
SEED = 41
# Words are runs of bytes other than space and 0x09-0x0D, which bytes.split cuts at; A-Z are lowered
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_set(text: bytes, memo) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; of the whole sequence if it is shorter."""
    w = hash_words(text.translate(LOWER).split(), memo)
    return np.unique(gram_hashes(w, min(SHINGLE, len(w)))) if len(w) else w


def set_id(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return xxhash.xxh3_128_digest(shingles.tobytes())


def permutations(seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], rng.integers(0, 1 << 63, PERMS, dtype=np.uint64)[:, None]


def sketch(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """2 x PERMS values: the minimum, then the maximum, under each permutation x -> a x + b."""
    low = high = None
    for at in range(0, len(shingles), 4096):
        h = a * shingles[None, at:at + 4096] + b
        lo, hi = h.min(axis=1), h.max(axis=1)
        low, high = (lo, hi) if low is None else (np.minimum(low, lo), np.maximum(high, hi))
    return np.concatenate([low, high])


def band_hashes(values: np.ndarray) -> np.ndarray:
    """One hash per band of ROWS values, different between bands."""
    v = values.reshape(BANDS, ROWS)
    acc = mix64(v[:, 0] + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for j in range(1, ROWS):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + v[:, j])
    return acc


def sign(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key, n_shingles, cid (of the set, null if empty), bands."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_bytes(text_col), F.lit(b"")).alias("t"),
                       text_key(text_col).alias("text_key"))

    def run(it):
        memo = hash_memo()
        a, b_ = permutations()
        for b in batches(it, 1024):
            n, cid, bands = [], [], []
            for t in b.column(1).to_pylist():
                s = shingle_set(t, memo)
                n.append(len(s))
                cid.append(set_id(s) if len(s) else None)
                bands.append(band_hashes(sketch(s, a, b_)).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(cid, pa.binary()),
                                              pa.array(bands, pa.list_(pa.int64()))],
                                             names=["doc_id", "text_key", "n_shingles", "cid", "bands"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, text_key string, n_shingles bigint, cid binary, bands array<bigint>")


def shared_buckets(classes: DataFrame) -> DataFrame:
    """bucket, size, cid, n: the classes of every bucket that holds more than one."""
    spark = classes.sparkSession
    counts = stage_table(spark, classes.select(F.explode("bands").alias("bucket")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size")).where("size > 1"), "dedup-bucket-sizes")
    shared = spark.sparkContext.broadcast(slot_filter(counts, "bucket"))

    def run(it):
        passes = SlotFilter(shared.value)
        for b in batches(it, 4096):
            lists = b.column(2)
            flat = lists.flatten().to_numpy()
            keep = np.flatnonzero(passes(flat))
            row = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))[keep]
            yield pa.RecordBatch.from_arrays([pa.array(flat[keep]), b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row))],
                                             names=["bucket", "cid", "n"])

    rows = classes.select("cid", "n", "bands").mapInArrow(run, "bucket bigint, cid binary, n bigint")
    return rows.join(counts, "bucket")


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """cid, n, shingles of the wanted classes (cid, rep), from the text of a representative."""
    key = F.xxhash64(F.col("rep"))
    shared = docs.sparkSession.sparkContext.broadcast(slot_filter(wanted.select(key.alias("k")), "k"))
    rows = docs.select(F.xxhash64(F.col(id_col)).alias("k"), F.coalesce(text_bytes(text_col), F.lit(b"")).alias("t"))

    def run(it):
        memo, passes = hash_memo(), SlotFilter(shared.value)
        for b in it:
            b = b.filter(pa.array(passes(b.column(0).to_numpy())))
            for c in batches([b], 512):
                sets = [s for s in (shingle_set(t, memo) for t in c.column(1).to_pylist()) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_id(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], names=["cid", "n", "shingles"])

    sets = rows.mapInArrow(run, "cid binary, n bigint, shingles binary")
    return sets.join(wanted.select("cid"), "cid", "left_semi").dropDuplicates(["cid"])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    fits = (F.col("n_a") * 100 >= F.col("n_b") * PERCENT) & (F.col("n_b") * 100 >= F.col("n_a") * PERCENT)
    j = pairs.join(sets.select(F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("set_a")), "a")
    j = j.join(sets.select(F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("set_b")), "b").where(fits)

    def run(it):
        for b in batches(it, 256):
            keep = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                    for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return j.select("a", "b", "set_a", "set_b").mapInArrow(run, "a binary, b binary")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node, label: the smallest node that each node of the links (a, b) reaches."""
    both = stage_table(spark, edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .distinct(), "dedup-links")
    labels = stage_table(spark, both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label")), "dedup-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        step = stage_table(spark, step, "dedup-labels")
        if step.where(F.col("old") != F.col("label")).isEmpty():  # no link joins two labels any more
            return step.select("node", "label")
        up = step.select(F.col("node").alias("label"), F.col("label").alias("root"))
        labels = stage_table(spark, step.join(up, "label", "left").select(
            "node", F.least("label", F.coalesce("root", "label")).alias("label")), "dedup-labels")


class Grouping:
    """The component of every class that shares a bucket, refined as links are found."""

    def __init__(self, spark: SparkSession, members: DataFrame):
        self.spark = spark
        self.comp = stage_table(spark, members.select("cid").distinct().select("cid", F.col("cid").alias("comp")), "dedup-comp")

    def link(self, pairs: DataFrame) -> None:
        """Join the components at the two ends of each pair."""
        ends = pairs.join(self.comp.select(F.col("cid").alias("a"), F.col("comp").alias("ca")), "a").join(
            self.comp.select(F.col("cid").alias("b"), F.col("comp").alias("cb")), "b")
        edges = ends.where(F.col("ca") != F.col("cb")).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        merged = components(self.spark, edges)
        self.comp = stage_table(self.spark, self.comp.join(merged.withColumnRenamed("node", "comp"), "comp", "left").select(
            "cid", F.coalesce("label", "comp").alias("comp")), "dedup-comp")

    def open_buckets(self, members: DataFrame) -> DataFrame:
        """The rows of buckets that hold several components: bucket, cid, hub, comp and the most central class of
        another component (o_hub, o_cid). Staged, as buckets only close: the next round looks at these rows alone."""
        rows = members.join(self.comp, "cid")
        best = rows.groupBy("bucket", "comp").agg(F.max(F.struct("hub", "cid")).alias("w"))
        # the two best components are picked on both sides of the shuffle, so no bucket is gathered
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.col("w").desc()))
        two = best.withColumn("rank", rank).where("rank <= 2").groupBy("bucket").agg(*[
            F.max(F.when(F.col("rank") == n, F.struct("w.hub", "w.cid", "comp"))).alias(c) for n, c in ((1, "first"), (2, "second"))])
        rows = rows.join(two.where("second IS NOT NULL"), "bucket")
        other = F.when(F.col("comp") == F.col("first.comp"), F.col("second")).otherwise(F.col("first"))
        rows = rows.select("bucket", "cid", "hub", "comp", other.alias("o"))
        return stage_table(self.spark, rows.select("bucket", "cid", "hub", "comp", F.col("o.hub").alias("o_hub"),
                                                   F.col("o.cid").alias("o_cid")), "dedup-open")


def central_pairs(rows: DataFrame, tested: DataFrame) -> DataFrame:
    """For each class the most central class of another component in one of its buckets, if not yet tested."""
    offers = rows.select(F.least("cid", "o_cid").alias("a"), F.greatest("cid", "o_cid").alias("b"), "cid", F.col("o_hub").alias("hub")).distinct()
    offers = offers.join(tested, ["a", "b"], "left_anti")
    best = offers.groupBy("cid").agg(F.max(F.struct("hub", "a", "b")).alias("p"))
    return best.select("p.a", "p.b").distinct()


def prefix_length(n: Column | int):
    """How many of the first shingles of any fixed order must hold one of a similar set."""
    return n - (n * PERCENT + 99) // 100 + 1


def shingle_weights(sets: DataFrame) -> np.ndarray:
    """How often shingles occur, by the leading ORDER_BITS of their hash: an order of rarity of fixed size."""
    def run(it):
        total = np.zeros(1 << ORDER_BITS, np.int64)
        for b in batches(it, 1024):
            flat = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint64)
            total += np.bincount((flat >> np.uint64(64 - ORDER_BITS)).astype(np.int64), minlength=1 << ORDER_BITS)
        pages = total.astype("<u4").reshape(-1, 4096)
        used = np.flatnonzero(pages.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([pages[i].tobytes() for i in used], pa.binary())],
                                         names=["page", "counts"])

    def add(it):
        total: dict[int, np.ndarray] = {}
        for b in it:
            for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[p] = total.get(p, 0) + np.frombuffer(c, "<u4").astype(np.uint64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([np.minimum(v, 0xFFFFFFFF).astype("<u4").tobytes() for v in total.values()],
                                                         pa.binary())], names=["page", "counts"])

    parts = sets.select("shingles").mapInArrow(run, "page int, counts binary")
    out = np.zeros((1 << ORDER_BITS) // 4096 * 4096, np.uint32).reshape(-1, 4096)
    # one row per page and partition comes back: at most 256 pages of 16 KB from each of a few adders
    for r in parts.repartition(4, "page").mapInArrow(add, "page int, counts binary").collect():
        out[r["page"]] += np.frombuffer(r["counts"], "<u4")
    return out.reshape(-1)


def prefix_pairs(rows: DataFrame, sets: DataFrame, tested: DataFrame) -> DataFrame:
    """Pairs of classes of different components that can be similar, by the prefix of rare shingles."""
    spark = rows.sparkSession
    active = rows.select("cid", "comp").distinct()
    own = stage_table(spark, sets.join(active, "cid").select("cid", "comp", "n", "shingles"), "dedup-open-sets")
    weights = spark.sparkContext.broadcast(shingle_weights(own))

    def run(it):
        w = weights.value
        for b in batches(it, 256):
            out = []
            for i, (n, raw) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                s = np.frombuffer(raw, np.uint64)
                k = prefix_length(n)
                order = np.lexsort((s, w[(s >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]))[:k]
                out.append((np.full(k, i), s[order].view(np.int64), np.arange(k)))
            if out:
                i, s, at = (np.concatenate(x) for x in zip(*out))
                take = pa.array(i)
                yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), b.column(2).take(take),
                                                  pa.array(s), pa.array(at, pa.int64())], names=["cid", "comp", "n", "shingle", "at"])

    posts = stage_table(spark, own.mapInArrow(run, "cid binary, comp binary, n bigint, shingle bigint, at bigint"), "dedup-prefixes")
    per = posts.groupBy("shingle", "comp").agg(F.count(F.lit(1)).alias("k"))
    main = per.groupBy("shingle").agg(F.max(F.struct("k", "comp")).alias("m"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    few = posts.join(main.select("shingle", F.col("m.comp").alias("main")), "shingle").where(F.col("comp") != F.col("main"))
    x = few.select("shingle", "main", *[F.col(c).alias(f"{c}_x") for c in ("cid", "comp", "n", "at")])
    y = posts.select("shingle", *[F.col(c).alias(f"{c}_y") for c in ("cid", "comp", "n", "at")])
    # overlap needed for the threshold, and the most that is left from this shingle on
    enough = (F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y")) * (100 + PERCENT)
              >= (F.col("n_x") + F.col("n_y")) * PERCENT)
    once = (F.col("comp_y") == F.col("main")) | (F.col("cid_x") < F.col("cid_y"))
    cand = x.join(y, "shingle").where((F.col("comp_x") != F.col("comp_y")) & once & enough)
    cand = cand.select(F.least("cid_x", "cid_y").alias("a"), F.greatest("cid_x", "cid_y").alias("b")).distinct()
    return cand.join(tested, ["a", "b"], "left_anti")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_key, cid, keeps_class: one row per input row.

    ``component_id`` is the smallest id that can be reached over links; ``kept`` marks
    the rows that have it. Cases: null texts and texts without words have no shingles,
    are linked with nothing and are kept; texts of fewer than five words are one
    shingle; rows with equal sets are linked, so repeated rows share a component; a
    null id is never smallest unless its component has no other; an empty table gives
    an empty result. Whole texts are compared. Extra columns are ignored.
    """
    spark = docs.sparkSession
    signed = stage_table(spark, sign(docs, id_col, text_col), "dedup-signed")
    classes = stage_table(spark, signed.where("cid IS NOT NULL").groupBy("cid").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("bands").alias("bands")), "dedup-classes")
    members = shared_buckets(classes)
    hubs = members.groupBy("cid").agg(F.sum("size").alias("hub"))
    members = stage_table(spark, members.select("bucket", "cid").join(hubs, "cid"), "dedup-members")
    groups = Grouping(spark, members)
    wanted = classes.join(groups.comp.select("cid"), "cid", "left_semi").select("cid", "rep")
    sets = stage_table(spark, full_sets(docs, wanted, id_col, text_col), "dedup-sets")
    tested = [spark.createDataFrame([], "a binary, b binary")]
    rest = groups.open_buckets(members)
    for _ in range(rounds):
        pairs = stage_table(spark, central_pairs(rest, reduce(DataFrame.unionByName, tested)), "dedup-pairs")
        if pairs.isEmpty():
            break
        tested.append(pairs)
        groups.link(stage_table(spark, confirm(pairs, sets), "dedup-confirmed"))
        rest = groups.open_buckets(rest.select("bucket", "cid", "hub"))
    if not rest.isEmpty():
        pairs = stage_table(spark, prefix_pairs(rest, sets, reduce(DataFrame.unionByName, tested)), "dedup-pairs")
        groups.link(stage_table(spark, confirm(pairs, sets), "dedup-confirmed"))
    comp = classes.select("cid", "rep").join(groups.comp, "cid", "left").select(
        "cid", "rep", F.coalesce("comp", "cid").alias("comp"))
    # a missing id comes last; the class order settles ties between classes that share an id
    first = comp.groupBy("comp").agg(F.min(F.struct(F.col("rep").isNull().alias("no"), F.col("rep"), F.col("cid"))).alias("w"))
    comp = comp.join(first, "comp").select("cid", F.col("w.rep").alias("component"), (F.col("w.cid") == F.col("cid")).alias("keeps_class"))
    own = F.col("cid").isNull()
    out = signed.select("doc_id", "n_shingles", "text_key", "cid").join(comp, "cid", "left")
    component = F.when(own, F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
                      "text_key", "cid", F.coalesce("keeps_class", F.lit(True)).alias("keeps_class"))


def keep_one_per_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, with all columns: the one with the smallest id.

    Documents without words are in no group and all stay. Of repeated rows (same id
    and text) one stays.
    """
    verdict = stage_table(docs.sparkSession, near_duplicates(docs, id_col=id_col, text_col=text_col).where(
        "cid IS NOT NULL").select("doc_id", "text_key", (F.col("kept") & F.col("keeps_class")).alias("stays")), "dedup-verdict")
    keys = verdict.groupBy("doc_id", "text_key").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("rows"))
    keyed = docs.select(F.struct("*").alias("__row"), F.col(id_col).alias("__id"), text_key(text_col).alias("__key"))
    same = F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__key") == F.col("text_key"))
    # only rows that go or repeat are looked up: a short list is broadcast at run time and no text moves
    once = keyed.join(keys.where("NOT stays OR rows > 1"), same, "left_anti")
    again = keyed.join(keys.where("stays AND rows > 1"), same, "left_semi").dropDuplicates(["__id", "__key"])
    return once.unionByName(again).select("__row.*")
