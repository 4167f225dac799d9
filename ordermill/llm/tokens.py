"""Token ids of whole texts with a public tokenizer file, each distinct word encoded once per worker."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from string import ascii_lowercase

import pyarrow as pa
from tokenizers import Tokenizer

from ordermill.llm.columns import slices
from ordermill.llm.worker import begin, held_by

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallel units

KEPT_WORDS = 600_000  # words remembered by a worker, twice: when so many are new, those not seen since the last time go
LONGEST_KEPT = 64  # bytes of a remembered word
_TAIL = re.compile(rb"(.*[A-Za-z0-9])([!-&(-/:-@\[-`{-~]+)", re.DOTALL)  # signs after a letter or digit, no apostrophe
_TAILS = (".", "?!", "$$$", "*_")


class WordIds(dict):
    """Word -> its ids as little-endian 32-bit numbers, encoded when first seen.

    For tokenizers whose pre-tokenizer drops white space, so that no token spans two words: there, the ids of a text
    are those of its words, one after the other.  Two short cuts save work at a word's first sight, each used only if
    the tokenizer passes a trial of it: signs that end a word are a piece of their own, and a word of lower-case
    letters is one piece, which the tokenizer's model takes without normalisation.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.older: dict[bytes, bytes] = {}
        self.added = re.compile(b"|".join(re.escape(t.content.encode()) for t in self.tokenizer.get_added_tokens_decoder().values()) or b"(?!)")
        self.letters = {c: p[0] for c in map(chr, range(97, 0x250)) if c.isalpha() and c == c.lower() and len(p := self._pieces(c)) == 1}
        if self._pieces("".join(self.letters)) != ["".join(self.letters.values())]:
            self.letters = {}
        self.plain = all(self.letters.get(c) == c for c in ascii_lowercase)
        self.parted = all(self._pieces(f"ab{t}") == self._pieces("ab") + self._pieces(t) for t in _TAILS) and self._pieces("AB") == self._pieces("ab")

    def _pieces(self, text: str) -> list[str]:
        """What the tokenizer's model is given of ``text``."""
        normal, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        text = normal.normalize_str(text) if normal else text
        return [piece for piece, _ in cut.pre_tokenize_str(text)] if cut else [text]

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self._encode(word)
        if len(word) <= LONGEST_KEPT:
            if len(self) >= KEPT_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def _encode(self, word: bytes) -> bytes:
        if self.plain and word.isalpha() and word.islower():  # of ASCII alone
            return array("I", [t.id for t in self.model.tokenize(word.decode())]).tobytes()
        if self.parted and len(word) <= LONGEST_KEPT and not self.added.search(low := word.lower()):
            if tail := _TAIL.fullmatch(low):  # only what words have in common is remembered besides the word
                return self[tail[1]] + self[tail[2]]
            if low != word:
                return self[low]
        text = word.decode()
        if self.letters.keys() >= set(text):
            return array("I", [t.id for t in self.model.tokenize("".join(map(self.letters.__getitem__, text)))]).tobytes()
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def of(self, texts: list[bytes]) -> list[bytes]:
        return [b"".join(map(self.__getitem__, text.split())) for text in texts]


@lru_cache(1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


held_by("words", word_ids.cache_clear)


def encoded(batches: Iterator[pa.RecordBatch], column: str, path: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows with the ids of their texts; a null text has none."""
    begin("words")
    ids = word_ids(path)
    for batch in batches:
        for some in slices(batch, column):
            yield some, ids.of(some.column(column).fill_null("").cast(pa.large_binary()).to_pylist())
