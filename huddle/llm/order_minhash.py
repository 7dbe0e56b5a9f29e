"""Document fingerprints by Order MinHash (DataFrame functions only).

A text is cut into tokens, and its k-mers (runs of three tokens) are numbered by
occurrence, so that a repeated k-mer counts as often as it stands there. One hash of
(k-mer, occurrence) deals them into 64 bins; a bin selects its two k-mers with the
smallest hashes, puts them back into the order of the text and hashes that tuple.
Two texts agree in a bin if they select the same k-mers there *in the same order*,
which makes the fingerprint sensitive to edit distance where plain minhash sees sets.
The bins stand for as many permutations: one hash is evaluated a k-mer, not 64
(one-permutation hashing). Bins that are empty in both texts say nothing, so likeness
is taken over the others.

Scale: a fingerprint is made in the row, by built-in array functions. The next
document in id order is found in ranges of (id, text hash), never in one sorted task:
every text is shuffled once, to its range, with its fingerprint beside it, and the
first row of a range also goes to the end of the range before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from huddle.llm.order import bounds, bounds_column, range_of

K = 3
BIN_BITS = 6
PICKS = 2
# Tokens are runs without white space; from its 16th character on, a run is cut into single characters, wherever it
# began: scripts without spaces, encoded data and other long runs keep k-mers of their own.
SPACE = r"\s+"
LONG_RUN = r"\S{17}"
SPACE_OR_LONG = r"\s+|(?<=\S{16})"
_HIGH = "-4294967296L"  # the upper 32 bits; the lower 32 hold a place in the text


def _picked(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with ``out``: bin and tuple hash of every bin that is not empty, as ints.

    Each array that a later step indexes is a column of its own, so that it is made once a row.
    """
    keep = rows.columns
    h, s, d, f = (f"`{out}_{x}`" for x in "hsdf")

    def column(expr: str, name: str) -> Column:
        return F.expr(expr).alias(name.strip("`"))

    def hash_of(x: str) -> str:
        return f"shiftright({x}, 32)"

    def bin_of(x: str) -> str:
        return f"shiftrightunsigned({x}, {64 - BIN_BITS})"

    def smallest(array: str) -> str:
        """The first picks of every bin of a sorted array."""
        return f"filter({array}, (x, i) -> i < {PICKS} OR {bin_of(f'{array}[i - {PICKS}]')} <> {bin_of('x')})"

    text = F.col(text)
    tokens = F.when(text.rlike(LONG_RUN), F.split(text, SPACE_OR_LONG)).otherwise(F.split(text, SPACE))
    rows = rows.select(*keep, F.transform(F.array_remove(tokens, ""), lambda t: F.xxhash64(t)).alias(h.strip("`")))
    grams = ", ".join(f"{h}[i + {j}]" for j in range(K))
    # hash above, place below: sorted, the occurrences of a k-mer stand together in the order of the text
    rows = rows.select(*keep, column(f"""
        CASE WHEN size({h}) = 0 THEN CAST(array() AS array<bigint>)
             WHEN size({h}) < {K} THEN array(xxhash64({h}) & {_HIGH})
             ELSE sort_array(transform(sequence(0, size({h}) - {K}), i -> (xxhash64({grams}) & {_HIGH}) | i)) END""", s))
    # occurrence 0 keeps the k-mer's hash, so those are in order already; the further ones get a hash of (k-mer, occurrence)
    again = f"i > 0 AND {hash_of(f'{s}[i - 1]')} = {hash_of('x')}"
    rows = rows.select(*keep, column(f"filter({s}, (x, i) -> {again})", d), column(f"filter({s}, (x, i) -> NOT ({again}))", f))
    starts = f"filter(sequence(0, size({d})), i -> i = 0 OR i = size({d}) OR {hash_of(f'{d}[i - 1]')} <> {hash_of(f'{d}[i]')})"
    rows = rows.select(*keep, d, column(f"CASE WHEN size({d}) > 0 THEN {starts} END", h), column(smallest(f), f))
    numbered = (f"flatten(transform(slice({h}, 1, size({h}) - 1), (a, r) -> transform(sequence(a, {h}[r + 1] - 1), "
                f"i -> (xxhash64({hash_of(f'{d}[i]')}, i - a + 1) & {_HIGH}) | ({d}[i] & 4294967295L))))")
    rows = rows.select(*keep, column(f"CASE WHEN size({d}) = 0 THEN {f} ELSE sort_array(concat({f}, {numbered})) END", f))
    rows = rows.select(*keep, column(smallest(f), f))
    # a bin's first pick speaks for it: alone, or with the second one in the order of their places
    first, second = f"i = 0 OR {bin_of(f'{f}[i - 1]')} <> {bin_of('x')}", f"get({f}, i + 1)"
    tuple_hash = (f"CASE WHEN {second} IS NULL OR {bin_of(second)} <> {bin_of('x')} THEN xxhash64({hash_of('x')}) "
                  f"WHEN (x & 4294967295L) < ({second} & 4294967295L) THEN xxhash64({hash_of('x')}, {hash_of(second)}) "
                  f"ELSE xxhash64({hash_of(second)}, {hash_of('x')}) END")
    entry = f"CAST((shiftleft({bin_of('x')}, {32 - BIN_BITS}) | shiftrightunsigned({tuple_hash}, {32 + BIN_BITS})) - 2147483648L AS INT)"
    return rows.select(*keep, column(f"sort_array(array_compact(transform({f}, (x, i) -> CASE WHEN {first} THEN {entry} END)))", out))


def fingerprint_text(sketch: Column) -> Column:
    """A sketch as text: eight hex digits for every bin that is not empty."""
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.lower(F.hex(x.cast("bigint") + 2147483648)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing bins among those that are not empty in both sketches; 1 for two without any bin, null if one is null."""
    def bins(x: Column) -> Column:
        return F.transform(x, lambda v: F.shiftright(v, 32 - BIN_BITS))
    both = F.size(F.array_union(bins(a), bins(b)))
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(both == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(a, b)) / both)


def sketches(docs: DataFrame, text_col: str = "text", out: str = "sketch") -> DataFrame:
    """``docs`` with the Order MinHash sketch of every text, an ascending array of ints; a null text has that of an empty one."""
    texts = docs.withColumn("__t", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return _picked(texts, "__t", out).drop("__t")


def edit_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: one row per input row.

    The edited text is the text with its second half (rounded down) replaced by as
    many first characters of the next document in ascending id order, or all of them.

    Cases: a null text is an empty one; an empty text, or one of white space, has the
    empty fingerprint; two empty fingerprints are alike (1); a text of fewer tokens than
    a k-mer is one k-mer. Null ids come first; rows with one id stand in the order of
    their text's hash, and equal rows are separate documents that follow each other. The
    last document's next one is the first, so a single document is its own next one. An
    empty table gives an empty result. Extra columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("hash", F.xxhash64("text"))
    key = ["doc_id", "hash"]
    lowest = rows.agg(F.min(F.struct(*key)).alias("k")).first()["k"]
    if lowest is None:
        cuts = heads = []
    else:
        cuts = bounds(rows, key, parts)
        heads = [lowest, *cuts]

    placed = rows.withColumn("range", range_of(rows, key, cuts))
    # the first row of a range also stands at the end of the one before it (of the last one for the first)
    if heads:
        is_head = F.get(bounds_column(rows, key, heads), F.col("range")) == F.struct(*[F.col(c) for c in key])
        before = F.when(F.col("range") == 0, F.lit(len(cuts))).otherwise(F.col("range") - 1)
        own = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
        guest = F.struct(before.cast("int").alias("range"), F.lit(True).alias("guest"))
        at = F.when(F.coalesce(is_head, F.lit(False)), F.array(own, guest)).otherwise(F.array(own))
    else:
        at = F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("guest")))
    sketched = _picked(placed, "text", "own").withColumn("__at", F.explode(at)).select(
        "doc_id", "hash", "text", "own", "__at.range", "__at.guest")

    w = Window.partitionBy("range").orderBy("guest", *key)
    pairs = sketched.withColumn("__next", F.lead("text").over(w)).withColumn("__next_own", F.lead("own").over(w))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = pairs.where(~F.col("guest")).withColumn("n_chars", n.cast("bigint")).withColumn(
        "edited", F.concat(F.col("text").substr(F.lit(1), n - half), F.col("__next").substr(F.lit(1), half))).select(
        "doc_id", "n_chars", "edited", "own", "__next_own")
    both = _picked(edited, "edited", "other")
    return both.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       fingerprint_text(F.col("own")).alias("fingerprint"), fingerprint_text(F.col("other")).alias("edited_fingerprint"),
                       likeness(F.col("own"), F.col("other")).alias("near_edited"),
                       likeness(F.col("own"), F.col("__next_own")).alias("near_next"))
