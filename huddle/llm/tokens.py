"""Token counts without ids: pieces are counted once per distinct pre-token and
joined to the pre-token frequencies of each document.

The join stays inside the task: the pre-token -> pieces table is a bounded cache
of the Python worker (kept across its tasks), so no frequencies are shuffled. A
shuffled join would move one row per distinct pre-token and document, more than
the texts themselves. Every row stands alone: a lost executor costs its tasks only.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache
from operator import mul

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from huddle.llm.common import batches
from huddle.llm.pretokens import ChunkMemo, pretokenizer

LIMIT = 512


class Counts:
    """Token counts of texts under one tokenizer file; one per Python worker."""

    def __init__(self, path: str):
        self.pre = pretokenizer(path)
        self.plain = ChunkMemo(lambda c: len(self.pre.encode_chunk(c)))
        self.spaced = ChunkMemo(lambda c: len(self.pre.encode_chunk(" " + c)))

    def __call__(self, text: str) -> int:
        parts = self.pre.parts(text)
        if parts is None:
            return len(self.pre.whole(text))
        total = 0
        for part in parts:
            if isinstance(part, int):
                total += 1
                continue
            for chunks, memo in zip(self.pre.chunks(part), (self.plain, self.spaced)):
                freq = Counter(chunks)
                total += sum(map(mul, map(memo.__getitem__, freq), freq.values()))
        return total


@lru_cache(maxsize=4)
def counts(path: str) -> Counts:
    """One per Python worker."""
    return Counts(path)


def count_tokens(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per input row.

    ``tokenizer_path`` names a tokenizers-library file that every worker can read.
    Cases: null and empty texts have 0 bytes and 0 tokens; texts of any length are
    counted whole; special strings inside a text count as the library's default
    does (one token); repeated rows and null ids are counted like others; an empty
    table gives an empty result. Extra columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(it):
        count = counts(tokenizer_path)
        for b in batches(it, 2048):
            n = pa.array([count(t) for t in b.column(1).to_pylist()], pa.int64())
            size = pc.cast(pc.binary_length(b.column(1)), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, n, pc.greater(n, limit)],
                                             names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean")
