"""Pre-tokens of the two public tokenizer files, and exact per-pre-token encoding.

A tokenizers-library file splits a text at its added tokens, normalises each
piece, splits it by a pattern and encodes every match on its own. So an encoding
is the concatenation of the encodings of its pre-tokens. Both patterns never let
a match run over a blank between two words, so texts are first cut into chunks at
blanks with ``str.split`` and a worker splits and encodes each distinct chunk, and
each distinct pre-token, once.

Texts with characters outside long-settled Unicode blocks (where the tables of
the pattern library and the tokenizer could differ) are encoded whole by the
library instead: the same ids on another road.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Sequence
from functools import lru_cache

import regex

from huddle.llm.common import MEMO_ENTRIES, Memo

# The split patterns of the two tokenizer files, with Unicode white space spelled out
SPACE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
BYTE_LEVEL = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
              rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
WORD_LEVEL = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
# blocks whose letters, digits and spaces have not changed for many Unicode versions; no case or
# composition rule of the first block depends on a neighbour. U+001C to U+001F are left to the library.
SETTLED = r"\x00-\x1b\x20-ɏ"
SETTLED_MORE = r"Ѐ-ҁҊ-ԯ‐-‧‰-⁞、。ぁ-ゖァ-ヺ一-龥가-힣"
#: a blank between other white space, or such at the end: only there does white space join over a cut
JOINED_SPACE = re.compile(rf" (?=[{SPACE}]|\Z)(?<=[{SPACE}] )")


def byte_alphabet() -> dict[int, str]:
    """Byte-level BPE writes bytes as characters: printable ones as they are, the others from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return {b: chr(b if b in shown else next(hidden)) for b in range(256)}


class PreTokenizer:
    """Splits texts as one tokenizer file does and encodes distinct pre-tokens."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.plain = not any(t[k] for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word", "normalized"))
        self.words_only = spec["normalizer"] is not None  # lower case, white space dropped
        self.pattern = regex.compile(WORD_LEVEL if self.words_only else BYTE_LEVEL)
        self.unsettled = re.compile(f"[^{SETTLED}]" if self.words_only else f"[^{SETTLED}{SETTLED_MORE}]")
        self.split_added = re.compile("|".join(sorted(map(re.escape, self.added), key=len, reverse=True)) or r"(?!)")
        self._alphabet = byte_alphabet()
        self._model = self.tokenizer.model
        self._pieces = Memo(self.encode_pretoken)

    def encode_pretoken(self, pretoken: str) -> tuple[int, ...]:
        """Ids of one pre-token; not kept."""
        plain = pretoken.isascii() and pretoken.isalnum()  # these bytes are written as they are
        word = pretoken if plain else pretoken.encode().decode("latin-1").translate(self._alphabet)
        return tuple(t.id for t in self._model.tokenize(word))

    def encode_chunk(self, chunk: str) -> Sequence[int]:
        """Ids of a piece of text that starts and ends where a pre-token does."""
        if self.words_only and chunk.isalpha():  # letters alone are one pre-token
            return self._pieces[chunk]
        return [i for p in self.pattern.findall(chunk) for i in self._pieces[p]]

    def whole(self, text: str) -> list[int]:
        """The library's own encoding."""
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def parts(self, text: str) -> list[str | int] | None:
        """Pieces between added tokens, and the ids of those; None if the library has to encode the text."""
        if not self.plain or self.unsettled.search(text):
            return None
        if not any(m in text for m in self.added):
            return [text]
        out, at = [], 0
        for m in self.split_added.finditer(text):
            out += [text[at:m.start()], self.added[m.group()]]
            at = m.end()
        return [*out, text[at:]]

    def chunks(self, piece: str) -> tuple[list[str], list[str]]:
        """(chunks as they are, chunks that follow a blank which belongs to them), in order within each list.

        The second list is empty for files that drop white space.
        """
        if self.words_only:
            return piece.lower().split(), []
        if JOINED_SPACE.search(piece):
            return [piece], []
        first, *rest = piece.split(" ")
        return [first], rest


@lru_cache(maxsize=4)
def pretokenizer(path: str) -> PreTokenizer:
    """One per Python worker."""
    return PreTokenizer(path)


class ChunkMemo(Memo):
    """chunk -> value; chunks that hold line breaks hardly recur and are not kept."""

    def __missing__(self, key):
        return self._make(key) if "\n" in key else super().__missing__(key)


class WordMemo(Memo):
    """chunk or pre-token -> value, of a file that drops white space, in one bounded table.

    A word is held once, whether it stands alone or beside a comma. Values of a chunk's pre-tokens are joined.
    """

    def __init__(self, split: Callable, make: Callable, limit: int = MEMO_ENTRIES):
        super().__init__(make, limit)
        self._split = split

    def __missing__(self, key):
        if key.isalpha() or (parts := self._split(key)) == [key]:  # letters alone are one pre-token
            return super().__missing__(key)
        value = b"".join([self[p] for p in parts])
        if len(self) < self._limit:
            self[key] = value
        return value
