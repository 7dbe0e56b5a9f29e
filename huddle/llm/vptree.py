"""Nearest neighbours by cosine with one vantage-point tree per shard.

Vectors are normalised; the chord distance sqrt(2 - 2 cos) between them is a
metric and orders like the cosine. Equal vectors are first combined into classes
(a group of copies that holds a third of all rows is one entry of one tree).
Classes are dealt to shards by a hash, each shard of bounded size, and each shard
builds one tree: a node holds a vantage point and the median distance to it, a
leaf a block of vectors.

A query walks the nearer side first and skips the other one when the triangle
inequality shows it to be farther than the k-th best so far, ``|d - median| >
factor * tau``. Factor 1 is exact; smaller factors prune more and may miss.
Queries walk a tree together in blocks, so every distance computation is a matrix
product. A product only sorts out what lies below the best so far by more than its
rounding error; every other row is scored exactly, however many are that close. The first
product is in single precision; where it leaves more rows than are wanted, one in double
precision follows. A block of queries keeps its best from tree to tree, so later trees are
pruned by what the earlier ones have found. The parts' results are merged by a window over (query).

Scale: a task takes one block of queries and one part of the shards, both of bounded
size: every tree goes to each block of queries once, every query to each part of the
shards once, and a tree is unpacked once for a whole block. Neither trees nor queries are
broadcast or collected. More shards and more query blocks mean more tasks. Where vectors are
spread so evenly that nothing can be skipped, each query still meets every vector.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from huddle.llm.common import stage_table

NEIGHBOURS = 5
FACTOR = 1.0
SHARD_ROWS = 8192
LEAF_ROWS = 256
QUERY_BLOCK = 16384
QUERY_CELLS = 1 << 20  # numbers in a block of queries, where vectors are long
PART_CELLS = 1 << 23  # numbers in the shards that a task holds at once
SPLIT_QUERIES = 2048  # of so many queries with a bound, the halves walk a node each in its own order
TASKS_PER_CORE = 4
PAIR_CELLS = 1 << 21  # numbers of one side in one block of exact scores
SEED = 7


def usable_rows(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and the vector, where it is not null, not zero and finite throughout; singles stay what they are, all
    other numbers become doubles."""
    single = isinstance(vectors.schema[vec_col].dataType.elementType, T.FloatType)
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<float>" if single else "array<double>").alias("v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()
                   & F.forall("v", finite) & F.exists("v", lambda x: x != 0))


def classes(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector with the k + 1 smallest ids that hold it (a query skips its own)."""
    ids = F.slice(F.array_sort(F.collect_set("vec_id")), 1, k + 1)
    # combined per task and salt first, so that no task gathers all ids of a hot vector
    part = rows.withColumn("__s", F.pmod(F.xxhash64("vec_id"), F.lit(64))).groupBy("v", "__s").agg(ids.alias("ids"))
    return part.groupBy("v").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"))


class Node:
    __slots__ = ("vantage", "median", "inside", "outside", "rows")

    def __init__(self, vantage=None, median=0.0, inside=None, outside=None, rows=None):
        self.vantage, self.median, self.inside, self.outside, self.rows = vantage, median, inside, outside, rows


def chord(cos: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cos))


def build_tree(unit: np.ndarray, leaf_rows: int = LEAF_ROWS, seed: int = SEED) -> Node:
    """A tree over row numbers of ``unit`` (normalised vectors)."""
    rng = np.random.default_rng(seed)

    def build(rows: np.ndarray) -> Node:
        if len(rows) <= leaf_rows:
            return Node(rows=rows)
        vantage = int(rows[rng.integers(len(rows))])
        d = chord(unit[rows] @ unit[vantage])
        median = float(np.median(d))
        inside, outside = rows[d <= median], rows[d > median]
        if not len(outside):  # all at one distance
            return Node(rows=rows)
        return Node(vantage, median, build(inside), build(outside))

    return build(np.arange(len(unit)))


def rounding(dim: int, kind: type = np.float64) -> float:
    """How far two cosines can be apart in a matrix product of normalised vectors and yet be
    in the other order (or equal) in exact_cosine: twice the error bounds of both."""
    return 8.0 * (dim + 4) * np.finfo(kind).eps


class Search:
    """The best ``keep`` rows of a matrix for a block of queries, by exact cosine and then
    by ``order`` (smaller first; row numbers if not given). ``walk`` takes up the rows of one tree."""

    def __init__(self, vec: np.ndarray, queries: np.ndarray, keep: int, kth: int, factor: float,
                 order: np.ndarray | None = None):
        self.vec, self.queries, self.q = vec, queries, normalised(queries)
        self.rough, self.rough_q = normalised(vec).astype(np.float32), self.q.astype(np.float32)
        self.keep, self.kth, self.factor = keep, kth, factor
        self.order = np.arange(len(vec)) if order is None else order
        self.cos = np.full((len(queries), keep), -np.inf)
        self.row = np.full((len(queries), keep), -1, np.int64)
        self.near, self.rough_near = rounding(vec.shape[1]), rounding(vec.shape[1], np.float32)
        # chords of both sides and tau are off by at most sqrt(near) each, near-ties lie sqrt(2 near) beyond tau
        self.slack = 5.0 * np.sqrt(self.near)
        self.leaf_pairs = 0
        self.exact_pairs = 0

    def tau(self, who: np.ndarray) -> np.ndarray:
        """Distance of the k-th best so far; infinite until there are k."""
        return chord(np.maximum(self.cos[who, self.kth], -2.0)) + np.where(np.isinf(self.cos[who, self.kth]), np.inf, 0.0)

    def exact(self, who: np.ndarray, rows: np.ndarray) -> np.ndarray:
        self.exact_pairs += len(who)
        step = max(1, PAIR_CELLS // self.vec.shape[1])
        parts = [exact_cosine(self.queries[who[i:i + step]].astype(np.float64), self.vec[rows[i:i + step]].astype(np.float64))
                 for i in range(0, len(who), step)]
        return np.concatenate(parts) if parts else np.empty(0)

    def candidates(self, rows: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in who, position in rows) of all pairs that may be among the best."""
        cos = self.rough_q[who] @ self.rough[rows].T
        floor = (self.cos[who, -1] - self.rough_near).astype(np.float32)
        some = np.flatnonzero(cos.max(axis=1) >= floor)  # few, once a query has a good bound
        hit = cos[some] >= floor[some, None]
        many = np.flatnonzero(np.count_nonzero(hit, axis=1) > self.keep)
        if len(many):
            at = who[some[many]]
            cos = self.q[at] @ normalised(self.vec[rows]).T
            best = np.partition(np.concatenate([self.cos[at], cos], axis=1), -self.keep, axis=1)[:, -self.keep]
            hit[many] = cos >= (best - self.near)[:, None]
        at, col = np.divmod(np.flatnonzero(hit), len(rows))
        return some[at], col

    def leaf(self, rows: np.ndarray, who: np.ndarray) -> None:
        self.leaf_pairs += len(who) * len(rows)
        at, col = self.candidates(rows, who)
        if not len(at):
            return
        had = who[at[np.flatnonzero(np.diff(at, prepend=-1))]]  # each query that has a candidate, once
        had_at, had_slot = np.nonzero(self.row[had] >= 0)
        q, row, score = (np.concatenate(x) for x in (
            (had[had_at], who[at]), (self.row[had][had_at, had_slot], rows[col]),
            (self.cos[had][had_at, had_slot], self.exact(who[at], rows[col]))))
        best = np.lexsort((self.order[row], -score, q))
        q, row, score = q[best], row[best], score[best]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        kept = place < self.keep
        self.cos[q[kept], place[kept]] = score[kept]
        self.row[q[kept], place[kept]] = row[kept]

    def walk(self, tree: Node, who: np.ndarray, base: int = 0) -> None:
        """Take up a tree over the rows from ``base`` on."""
        inner, todo = [], [tree]
        while todo:
            node = todo.pop()
            if node.rows is None:
                inner.append(node)
                todo += [node.inside, node.outside]
        vantage = normalised(self.vec[[base + node.vantage for node in inner]]) if inner else self.q[:0]
        dist = chord(self.q[who] @ vantage.T)  # a product for all vantage points
        column = {id(node): i for i, node in enumerate(inner)}

        def descend(node: Node, at: np.ndarray) -> None:
            if not len(at):
                return
            if node.rows is not None:
                self.leaf(base + node.rows, who[at])
                return
            d = dist[at, column[id(node)]]
            near_in = d <= node.median
            margin = np.abs(d - node.median)
            if len(at) < SPLIT_QUERIES and not np.isinf(self.cos[who[at], self.kth]).any():
                # all have a bound already: a larger product is worth more than each one's nearer side first
                for side, mask in ((node.inside, near_in), (node.outside, ~near_in)):
                    descend(side, at[mask | (margin <= self.factor * self.tau(who[at]) + self.slack)])
                return
            for first, second, mask in ((node.inside, node.outside, near_in), (node.outside, node.inside, ~near_in)):
                group = at[mask]
                descend(first, group)
                if len(group):
                    descend(second, group[margin[mask] <= self.factor * self.tau(who[group]) + self.slack])

        descend(tree, np.arange(len(who)))


def normalised(vec: np.ndarray) -> np.ndarray:
    vec = vec.astype(np.float64, copy=False)
    return vec / np.sqrt((vec * vec).sum(axis=1))[:, None]


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the rows of two double matrices, always summed in the same order."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _matrix(col: pa.Array) -> np.ndarray:
    """Equal-length lists as a matrix."""
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def plant_trees(found: DataFrame, n_shards: int, leaf_rows: int) -> DataFrame:
    """shard, dim, tree: one row per shard and vector length."""
    dealt = found.withColumns({"dim": F.size("v"), "shard": F.pmod(F.xxhash64("v"), F.lit(n_shards)).cast("int")})

    def plant(key, table):
        table = table.combine_chunks()
        vec = _matrix(table.column("v").chunk(0))
        order = np.lexsort(vec.T[::-1])  # the same tree however the rows arrive
        vec = vec[order]
        blob = pickle.dumps((vec, table.column("ids").chunk(0).take(pa.array(order)), build_tree(normalised(vec), leaf_rows)),
                            protocol=pickle.HIGHEST_PROTOCOL)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "dim": pa.array([key[1].as_py()], pa.int32()),
                         "tree": pa.array([blob], pa.binary())})

    return dealt.groupBy("shard", "dim").applyInArrow(plant, "shard int, dim int, tree binary")


class Part:
    """The trees of some shards over one matrix of their vectors, and the ids of each row."""

    def __init__(self, blobs: list[bytes]):
        vecs, ids, self.trees = zip(*map(pickle.loads, blobs))
        self.vec = np.concatenate(vecs)
        self.base = np.cumsum([0, *map(len, vecs[:-1])]).tolist()
        ids = pa.concat_arrays(ids)
        self.ids = ids.flatten()
        self.n_ids = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
        self.first_id = np.cumsum(self.n_ids) - self.n_ids
        self.by_id = pc.rank(self.ids.take(pa.array(self.first_id)), tiebreaker="first").to_numpy().astype(np.int64)
        self.most = pc.max(pc.value_counts(self.ids).field("counts")).as_py()

    def answer(self, qid: pa.Array, queries: np.ndarray, k: int, factor: float) -> list[pa.Array]:
        """query_id, vec_id, score: rows that hold at least the k nearest of each query."""
        # an id has at most ``most`` vectors here, so these classes hold k ids besides the query's
        keep = min(k * self.most + 1, len(self.vec))
        s = Search(self.vec, queries, keep, keep - 1, factor, self.by_id)
        for tree, base in zip(self.trees, self.base):
            s.walk(tree, np.arange(len(queries)), base)
        who, slot = np.nonzero(s.row >= 0)
        row = s.row[who, slot]
        n = self.n_ids[row]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        asks = qid.take(pa.array(np.repeat(who, n))).cast(self.ids.type)
        found = self.ids.take(pa.array(np.repeat(self.first_id[row], n) + nth))
        other = pc.not_equal(asks, found)
        return [asks.filter(other), found.filter(other), pa.array(np.repeat(s.cos[who, slot], n)).filter(other)]


def to_parts(found: DataFrame, trees: DataFrame, asked: DataFrame, n_shards: int, per_block: int) -> tuple[DataFrame, DataFrame]:
    """Queries and trees by (dim, block, part): every query for each part of the shards, every tree for each block of queries."""
    cells = F.coalesce(F.sum(F.size("v").cast("bigint")), F.lit(0)).alias("cells")
    have, ask = (df.agg(F.count(F.lit(1)).alias("n"), cells).first() for df in (found, asked))
    n_blocks = max(1, -(-ask["n"] // per_block), -(-ask["cells"] // QUERY_CELLS))
    bound = max(1, PART_CELLS * n_shards // max(1, have["cells"]))  # shards a part may have
    enough = n_shards * n_blocks // (TASKS_PER_CORE * found.sparkSession.sparkContext.defaultParallelism)
    n_parts = -(-n_shards // max(1, min(bound, enough)))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")
    q = asked.select(F.size("v").alias("dim"), block.alias("block"), "vec_id", "v").withColumn("part", every(n_parts))
    t = trees.withColumn("part", F.pmod("shard", F.lit(n_parts)).cast("int")).withColumn("block", every(n_blocks))
    return q, t


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, *, id_col: str = "vec_id",
            vec_col: str = "embedding", factor: float = FACTOR, shard_rows: int = SHARD_ROWS,
            leaf_rows: int = LEAF_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other vectors of each query vector.

    Score is the cosine of the original vectors in double precision; ties go to the
    smaller id. Cases: null or zero vectors, and such with null or non-finite parts,
    neither ask nor answer; vectors of another length are no candidates; a row never
    answers for its own id; with fewer than k candidates all are returned; repeated
    rows count once per id; empty tables give an empty result. Extra columns are ignored.
    """
    spark = vectors.sparkSession
    found = stage_table(spark, classes(usable_rows(vectors, id_col, vec_col), k), "vector-classes")
    n_shards = max(1, -(-found.count() // shard_rows))
    trees = stage_table(spark, plant_trees(found, n_shards, leaf_rows), "vp-trees")
    asked = stage_table(spark, usable_rows(queries, id_col, vec_col).dropDuplicates(["vec_id", "v"]), "vp-queries")
    asks, parts = to_parts(found, trees, asked, n_shards, query_block)
    schema = T.StructType([T.StructField("query_id", found.schema["ids"].dataType.elementType),
                           T.StructField("vec_id", found.schema["ids"].dataType.elementType), T.StructField("score", T.DoubleType())])

    def search(q: pa.Table, t: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not q.num_rows or not t.num_rows:  # no vector of that length on one side
            kind = q.schema.field("vec_id").type
            return pa.table([pa.array([], kind), pa.array([], kind), pa.array([], pa.float64())], names)
        q = q.combine_chunks()
        blobs = [b.as_py() for _, b in sorted(zip(t.column("shard").to_pylist(), t.column("tree")), key=lambda x: x[0])]
        return pa.table(Part(blobs).answer(q.column("vec_id").chunk(0), _matrix(q.column("v").chunk(0)), k, factor), names)

    by = ["dim", "block", "part"]
    # by query first: the rows of an id and then of a query are together without another shuffle
    answers = (asks.groupBy(*by).cogroup(parts.groupBy(*by)).applyInArrow(search, schema)
               .repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
