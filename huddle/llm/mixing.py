"""Mixing sources to target weights with a multivariate-hypergeometric splitting
tree (DataFrame functions only).

1. Targets: sources by code point (null last) weigh 5, 2, 1, repeating, and share
   all words; a target stops at three times its source's words, the excess goes
   to the others by weight (water filling in closed form, one window over the
   list of sources).
2. Blocks: a document falls into one of ``BLOCKS`` hash blocks of its source. The
   blocks are put in a seeded permutation; whole passes over all blocks come
   first, then the permuted blocks that fit into the rest of the target, then the
   one block that comes nearest to what is still left. So a block is drawn 0 to 3
   times and the drawn words miss the target by less than a block.
3. Tree: the exact quota of draws of every source is split recursively between
   the halves of the output shards. A node's draws are put in a seeded order and the
   first ones, as many as the left half holds, go left: what each source gives is a
   multivariate hypergeometric draw from the node's quotas. A shard's part of a source
   is a run of that source's permuted draws, so shards are disjoint.
4. Rows: a document looks up its block's draws; no text is shuffled to decide. The
   layout then deals rows by shard and piece of the shuffle order and sorts in the task.

Scale: documents are aggregated to (source, block) with map-side combine, so a
hot source is 4,096 keys. The tree works on one narrow row a draw (12,288 a source at
most), ranked in buckets of the seeded order, never a node in one task. What is
broadcast is one array of 4,096 short lists per source, while their estimated size is
under ``MAX_BROADCAST_BYTES``; beyond it the same join shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from huddle.llm.common import hash60, id_key, source_key, stage_table
from huddle.llm.sharding import global_rank

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCKS = 4096
N_SHARDS = 16
SEED = 23
MAX_BROADCAST_BYTES = 64 << 20
DRAWS_PER_BUCKET = 100_000  # of one tree level, ranked in one task
PIECE_WORDS = 8_000_000  # of a shard, shuffled in one task
WORD = r"[^\x20\x09-\x0D]+"


def block_of(id_col: str, text_col: str, seed: int, blocks: int) -> Column:
    return (hash60(F.lit(seed), id_key(id_col, text_col)) % blocks).cast("int")


def word_counts(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int, blocks: int) -> DataFrame:
    """Every row's id, source key, block and number of words."""
    return docs.select(
        F.col(id_col).alias("doc_id"), source_key(source_col).alias("__src"),
        block_of(id_col, text_col, seed, blocks).alias("__block"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0))
        .cast("bigint").alias("size"))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(__src, source_size) -> plus target. One row per source; the list of sources is metadata-sized."""
    place = F.row_number().over(Window.orderBy(F.col("__src") == "~null", "__src")) - 1
    w = F.array(*[F.lit(int(x)) for x in weights])
    s = sources.withColumn("__weight", F.element_at(w, (place % len(weights) + 1).cast("int")).cast("bigint"))
    everything = Window.partitionBy()
    # sources reach their cap in the order of cap over weight
    prior = Window.orderBy(F.col("source_size") / F.col("__weight"), "__src").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns({
        "__cap": F.col("source_size") * cap, "__all_words": F.sum("source_size").over(everything),
        "__all_weight": F.sum("__weight").over(everything)})
    s = s.withColumns({"__cap_before": F.coalesce(F.sum("__cap").over(prior), F.lit(0)),
                       "__weight_before": F.coalesce(F.sum("__weight").over(prior), F.lit(0))})
    full = (F.col("__cap").cast("double") * (F.col("__all_weight") - F.col("__weight_before"))
            <= (F.col("__all_words") - F.col("__cap_before")).cast("double") * F.col("__weight"))
    s = s.withColumn("__full", full)
    rest = (F.col("__all_words") - F.sum(F.when(F.col("__full"), F.col("__cap")).otherwise(0)).over(everything)).cast("double")
    free = F.sum(F.when(F.col("__full"), 0).otherwise(F.col("__weight"))).over(everything)
    target = F.when(F.col("__full"), F.col("__cap").cast("double")).otherwise(rest * F.col("__weight") / free)
    return s.select("__src", "source_size", target.alias("target"))


def block_draws(sizes: DataFrame, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(__src, __block, __words, source_size, target, __perm, __draws): how often each block is drawn."""
    blocks = sizes.groupBy("__src", "__block").agg(F.sum("size").alias("__words"))
    sources = source_targets(blocks.groupBy("__src").agg(F.sum("__words").alias("source_size")), weights, cap)
    order = Window.partitionBy("__src").orderBy("__k", "__block")
    b = blocks.join(sources, "__src").withColumn("__k", hash60(F.lit(seed), F.lit("block"), "__src", "__block"))
    b = b.withColumns({"__perm": F.row_number().over(order) - 1, "__upto": F.sum("__words").over(
        order.rowsBetween(Window.unboundedPreceding, 0))})
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - passes * F.col("source_size")
    b = b.withColumns({"__passes": passes, "__rest": rest}).withColumn(
        "__first", (F.col("__upto") <= F.col("__rest")) & (F.col("__rest") > 0))  # nothing left: not even blocks without words
    source = Window.partitionBy("__src")
    left = F.col("__rest") - F.coalesce(F.max(F.when(F.col("__first"), F.col("__upto"))).over(source), F.lit(0))
    b = b.withColumn("__left", left)
    # one more block, the one whose words come nearest to what is left, if taking it helps
    gap = F.abs(F.col("__left") - F.col("__words"))
    b = b.withColumn("__best", F.min(F.when(~F.col("__first") & (gap < F.col("__left")), F.struct(
        gap.alias("gap"), F.col("__perm").alias("perm")))).over(source))
    again = F.col("__first") | F.coalesce(F.col("__best.perm") == F.col("__perm"), F.lit(False))
    return b.select("__src", "__block", "__words", "source_size", "target", "__perm", (F.col("__passes") + again.cast("int")).cast("int").alias("__draws"))


def split_quotas(quotas: DataFrame, n_shards: int, total: int, seed: int = SEED) -> DataFrame:
    """(__src, __q), ``total`` draws in all -> (__src, __upto): how many draws of the source lie in shards 0 to j.

    Every shard's total is fixed beforehand (totals differ by one at most); a node's
    left half takes its capacity from the node's draws without replacement.
    """
    draws = quotas.where("__q > 0").select(
        "__src", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__q") - 1)).alias("__i"),
        F.lit(0).cast("bigint").alias("__lo"), F.lit(n_shards).cast("bigint").alias("__hi"))
    buckets = max(1, -(-total // DRAWS_PER_BUCKET))
    for level in range((n_shards - 1).bit_length()):
        h = hash60(F.lit(seed), F.lit("tree"), F.lit(level), "__src", "__i")
        draws = draws.withColumns({"__h": h, "__mid": F.expr("(__lo + __hi) DIV 2")})
        place = F.floor(F.col("__h") * F.lit(buckets / 2.0 ** 60)).cast("int")
        ranked = global_rank(draws, ["__lo"], place, ["__h", "__src", "__i"], "__rank")
        left = F.expr(f"__rank < __mid * {total} DIV {n_shards} - __lo * {total} DIV {n_shards}")
        # staged: a level is read twice, to count its buckets and to rank in them
        draws = stage_table(quotas.sparkSession, ranked.select(
            "__src", "__i", F.when(left, F.col("__lo")).otherwise(F.col("__mid")).alias("__lo"),
            F.when(left, F.col("__mid")).otherwise(F.col("__hi")).alias("__hi")), f"mix-tree-{level}")
    return draws.groupBy("__src").agg(F.array(*[F.sum((F.col("__lo") <= j).cast("bigint")) for j in range(n_shards)]).alias("__upto"))


def draw_table(sizes: DataFrame, n_shards: int = N_SHARDS, *, seed: int = SEED, blocks: int = BLOCKS,
               weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> tuple[DataFrame, Row]:
    """One row per source: its size and target, and for each block the shards that draw it;
    and the totals of the mix (sources, draws, words)."""
    # staged: one row per block, read for the quotas and for the draws
    draws = stage_table(sizes.sparkSession, block_draws(sizes, seed, weights, cap), "mix-draws")
    all_ = draws.agg(F.countDistinct("__src").alias("sources"), F.coalesce(F.sum("__draws"), F.lit(0)).alias("draws"),
                     F.coalesce(F.sum(F.col("__words") * F.col("__draws")), F.lit(0)).alias("words")).first()
    alloc = split_quotas(draws.groupBy("__src").agg(F.sum("__draws").alias("__q")), n_shards, all_["draws"], seed)
    each = draws.withColumn("__pass", F.explode(F.when(F.col("__draws") > 0, F.sequence(F.lit(1), F.col("__draws")))))
    nth = F.row_number().over(Window.partitionBy("__src").orderBy("__pass", "__perm")) - 1
    each = each.withColumn("__nth", nth).join(alloc, "__src")
    each = each.withColumn("__shard", F.size(F.filter("__upto", lambda u: u <= F.col("__nth"))))
    drawn = each.groupBy("__src", "__block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__pass", "__shard"))), lambda x: x["__shard"]).alias("__in"))
    lists = drawn.groupBy("__src").agg(F.map_from_entries(F.collect_list(F.struct("__block", "__in"))).alias("__m"))
    per_block = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda i: F.try_element_at("__m", i))
    sources = draws.groupBy("__src").agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    table = sources.join(lists, "__src", "left").select("__src", "source_size", "target", per_block.alias("__drawn"))
    small = all_["sources"] * blocks * 40 + all_["draws"] * 4 <= MAX_BROADCAST_BYTES  # a list's header and place, its numbers
    return F.broadcast(table) if small else table, all_


def mix_report(docs: DataFrame, n_shards: int = N_SHARDS, *, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", seed: int = SEED, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, size, source_size, target, taken, shards: one row per input row.

    ``taken`` is the number of words that the mix takes from the row, repeats
    counted; ``shards`` lists the output shards that draw the row, by pass, joined by
    commas (empty: not drawn). Cases: a null or empty text has size 0 and takes 0; a
    null source is the last source; rows that share an id share a block, rows with
    null ids fall into blocks by their text; without any words all targets are 0 and
    nothing is drawn; an empty table gives an empty result. Extra columns are ignored.
    """
    # staged: ids and numbers, so that the texts are read and cut into words once
    sizes = stage_table(docs.sparkSession, word_counts(docs, id_col, text_col, source_col, seed, blocks), "mix-sizes")
    table, _ = draw_table(sizes, n_shards, seed=seed, blocks=blocks)
    drawn = F.coalesce(F.element_at("__drawn", F.col("__block") + 1), F.array().cast("array<int>"))
    return sizes.join(table, "__src").select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.size(drawn)).cast("bigint").alias("taken"),
        F.array_join(drawn.cast("array<string>"), ",").alias("shards"))


def mix_documents(docs: DataFrame, n_shards: int = N_SHARDS, *, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", seed: int = SEED, blocks: int = BLOCKS, positions: bool = True,
                  layout: bool = False) -> DataFrame:
    """The mix itself: every input row as often as its block is drawn, with all its
    columns and ``mix_shard``, ``mix_pass``, ``mix_order`` (a seeded order inside a shard;
    columns of these names in the input are replaced).

    ``layout=True`` also lays the rows out: a shard is cut by ``mix_order`` into pieces of
    about ``PIECE_WORDS`` words, each piece goes whole to one task and is shuffled there.
    Cases: as in ``mix_report``; repeated rows are drawn alike, each as a row of its own;
    the other columns are carried along unchanged.
    """
    table, all_ = draw_table(word_counts(docs, id_col, text_col, source_col, seed, blocks), n_shards, seed=seed, blocks=blocks)
    keyed = docs.select(F.struct("*").alias("__row"), source_key(source_col).alias("__src"), id_key(id_col, text_col).alias("__id"),
                        block_of(id_col, text_col, seed, blocks).alias("__block"))
    rows = keyed.join(table.select("__src", "__drawn"), "__src")
    rows = rows.select("__row", "__id", F.posexplode(F.element_at("__drawn", F.col("__block") + 1)).alias("__pass", "__shard"))
    rows = rows.withColumn("__order", hash60(F.lit(seed), F.lit("order"), "__pass", "__id"))
    if layout:
        pieces = max(1, -(-all_["words"] // (n_shards * PIECE_WORDS)))
        piece = F.floor(F.col("__order") * F.lit(pieces / 2.0 ** 60)).cast("int")
        rows = rows.repartition("__shard", piece).sortWithinPartitions("__shard", "__order", "__id")
    if not positions:
        return rows.select("__row.*")
    extra = {f"mix_{c}": F.col(f"__{c}") for c in ("shard", "pass", "order")}
    kept = [F.col("__row")[c].alias(c) for c in docs.columns if c not in extra]
    return rows.select(*kept, *[v.alias(k) for k, v in extra.items()])
