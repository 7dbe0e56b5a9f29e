"""Merkle dataset manifest by sibling-shift self-joins.

Every row is a leaf; the leaves of a source, in ascending id order, form a tree of
arity three, and the roots of the sources form one more tree. A level is a table
of (tree, at, n, digest). To build the next one, the level is joined with itself
on computed sibling indices: a node at slot s of its run of three finds its
siblings at the slots s+1 and s+2 of the same run (modulo three; for arity two
the sibling is at XOR 1). What the join found is the node's part of every proof
below it, and the slot-zero rows, which then hold the digests of the whole run,
emit the parents. The proofs are handed down from the root, one join a level.

Scale: a join key is (tree, index), so a source with a third of all rows spreads
like any other; positions come from ranges of (source, id, digest), never from one
sorted task. Texts are read twice (digest, tampered digest) and never shuffled. A
level holds a third of the rows of the one below, and each is a written table in the
shared folder, so a lost executor costs at most one level. The proof of a row grows
with the logarithm of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from huddle.llm.common import stage_table
from huddle.llm.order import positions

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """H: lowercase hex SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(c: Column) -> Column:
    """``-`` for null, else byte count, colon, value; integers in decimal."""
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return digest(*[field(c) for c in fields])


def tampered_text(id_col: Column, text: Column) -> Column:
    """The text without line feeds where the checksum of the decimal id is even; a null id leaves it."""
    even = F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def with_siblings(level: DataFrame, arity: int = ARITY) -> DataFrame:
    """The level with ``before`` and ``after``: the digests of a node's run left and right of it.

    One equijoin for each slot offset, on the computed index of the sibling there.
    """
    slot = F.col("at") % arity
    out = level
    for o in range(1, arity):
        sibling = F.col("at").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("at") - slot + (slot + o) % arity
        other = level.select(F.col("tree").alias("__tree"), F.col("at").alias("__at"), F.col("digest").alias(f"__s{o}"))
        out = out.withColumn("__to", sibling).join(
            other, (F.col("tree") == F.col("__tree")) & (F.col("__to") == F.col("__at")), "left").drop("__tree", "__at", "__to")

    def side(left: bool) -> Column:
        # the sibling at offset o stands at slot (s + o) % arity: left of the node if s + o wraps round
        at_slot = [F.when((slot + o >= arity) == F.lit(left), F.coalesce(F.col(f"__s{o}"), F.lit(""))).otherwise("")
                   for o in range(1, arity)]
        return F.concat(*at_slot)
    return out.select(*level.columns, side(True).alias("before"), side(False).alias("after"))


def parents(level: DataFrame, arity: int = ARITY) -> DataFrame:
    """The next level, emitted by the slot-zero rows of a level with siblings."""
    heads = level.where((F.col("at") % arity == 0) & (F.col("n") > 1))
    return heads.select("tree", F.expr(f"at DIV {arity}").alias("at"), F.expr(f"(n + {arity - 1}) DIV {arity}").alias("n"),
                        digest(F.col("digest"), F.col("after")).alias("digest"))


def build(leaves: DataFrame, name: str, arity: int = ARITY) -> list[DataFrame]:
    """All levels, leaves first, each with siblings: (tree, at, n, digest, before, after).

    ``leaves`` has a non-null tree, the 0-based index ``at``, the tree's number of
    leaves ``n`` and the digest. The node of a tree that stands alone is its root.
    """
    spark = leaves.sparkSession
    widest = leaves.agg(F.max("n")).first()[0] or 0
    levels = []
    while widest >= 1:
        levels.append(stage_table(spark, with_siblings(leaves, arity), f"merkle-{name}-{len(levels)}"))
        leaves, widest = parents(levels[-1], arity), -(-widest // arity) if widest > 1 else 0
    return levels


def hand_down(levels: list[DataFrame], tops: DataFrame, arity: int = ARITY) -> DataFrame:
    """tree, at, digest, path and the columns of ``tops`` for every leaf.

    ``tops`` has one row a tree with a path of its root; a node's path is its own
    step and then its parent's path, from the leaf to the top.
    """
    carried = [c for c in tops.columns if c not in ("tree", "path")]
    step = F.array(F.struct("before", "after"))
    done = None
    for level in reversed(levels):
        own = level.where(F.col("n") == 1).join(tops, "tree").select("tree", "at", "digest", "path", *carried)
        if done is not None:
            up = done.select(F.col("tree").alias("__tree"), F.col("at").alias("__at"), F.col("path").alias("__path"), *carried)
            below = level.where(F.col("n") > 1).join(
                up, (F.col("tree") == F.col("__tree")) & (F.expr(f"at DIV {arity}") == F.col("__at")))
            own = own.unionByName(below.select("tree", "at", "digest", F.concat(step, "__path").alias("path"), *carried))
        done = own
    return done


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda acc, s: digest(s["before"], acc, s["after"]))


def proof_digest(path: Column) -> Column:
    """H of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


EMPTY_PATH = "CAST(array() AS array<struct<before:string,after:string>>)"


def manifest(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source",
             fields: tuple[str, ...] = FIELDS, text_col: str = "text", arity: int = ARITY) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified, position: one row per input row.

    ``folded_root`` is the root from the leaf of the tampered row and the untampered
    siblings. Cases: a null field is ``-`` and differs from an empty one; null sources
    form a tree of their own, the first; null ids come first in their source and are
    never tampered with; rows with one id stand in the order of their digests (equal
    rows are interchangeable, each gets a proof); a source of one row has its leaf as
    root; an empty table gives an empty result. Extra columns are ignored.
    """
    spark = docs.sparkSession
    as_is = [F.col(c) for c in fields]
    bent = [tampered_text(F.col(id_col), F.col(c)) if c == text_col else F.col(c) for c in fields]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       leaf_digest(as_is).alias("leaf"), leaf_digest(bent).alias("bent"))
    rows = stage_table(spark, rows, "merkle-rows")
    placed = positions(rows, ["source", "doc_id", "leaf", "bent"], "__rank")

    sizes = placed.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("__rank").alias("__first"))
    # a source's tree is named by its rank among the sources
    sizes = stage_table(spark, positions(sizes, ["source"], "tree"), "merkle-sources")
    placed = stage_table(spark, placed.join(sizes, placed["source"].eqNullSafe(sizes["source"])).select(
        "tree", (F.col("__rank") - F.col("__first")).alias("at"), "n", F.col("leaf").alias("digest"), "doc_id",
        placed["source"], "bent"), "merkle-placed")
    low = build(placed.select("tree", "at", "n", "digest"), "sources", arity)
    if not low:
        return placed.select("doc_id", "source", *[F.lit("").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
                             F.col("at").alias("position"), F.lit(False).alias("verified"))
    subroots = None
    for level in low:
        alone = level.where(F.col("n") == 1).select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("at"),
                                                    F.lit(sizes.count()).cast("bigint").alias("n"), "digest")
        subroots = alone if subroots is None else subroots.unionByName(alone)
    high = build(stage_table(spark, subroots, "merkle-subroots"), "top", arity)
    root = high[-1].where(F.col("n") == 1).select("tree", F.expr(EMPTY_PATH).alias("path"), F.col("digest").alias("root"))
    top = stage_table(spark, hand_down(high, root, arity), "merkle-top")
    tops = top.select(F.col("at").alias("tree"), F.col("digest").alias("subroot"), "root", "path")
    paths = hand_down(low, tops, arity)

    out = placed.select("tree", "at", "doc_id", "source", "bent").join(paths, ["tree", "at"])
    folded = fold(F.col("bent"), F.col("path"))
    return out.select("doc_id", "source", F.col("digest").alias("leaf"), "subroot", "root",
                      proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"),
                      F.col("at").alias("position")).withColumn("verified", F.col("folded_root") == F.col("root"))
