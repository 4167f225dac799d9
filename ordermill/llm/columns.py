"""Texts of an Arrow column as numpy arrays: bytes, words, word hashes, shingles.

A word is a maximal run of bytes other than ASCII white space (``[^\\x20\\x09-\\x0D]+``); the letters A-Z count as
lower case.  Null texts have no bytes.  Hashes are 64-bit polynomials over random byte values, mixed afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ordermill.llm.worker import held_by

WORDS_PER_SHINGLE = 5
SLICE_BYTES = 1 << 20  # texts are worked on in groups of about so many bytes; a longer text is a group of its own

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64)[_LOWER]
_PLACE = np.random.default_rng(20240102).integers(1, 1 << 63, WORDS_PER_SHINGLE, dtype=np.uint64) | _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finish of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_KEPT_POWERS = 1 << 21
_kept: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse; a bounded number is kept for further calls."""
    def made(base: np.uint64, size: int) -> np.ndarray:
        values = np.full(size, base)
        values[:1] = 1
        return np.multiply.accumulate(values)

    if n > _KEPT_POWERS:
        return made(_BASE, n), made(_INVERSE, n)
    if not _kept:
        _kept.extend((made(_BASE, _KEPT_POWERS), made(_INVERSE, _KEPT_POWERS)))
    return _kept[0][:n], _kept[1][:n]


held_by("powers", _kept.clear)


def utf8(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts in a row, and where each begins; one more entry has the end."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    places = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    held = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.empty(0, np.uint8)
    return data[places[0]:places[-1]], places - places[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` bytes of text, so that memory follows one run."""
    lengths = np.diff(utf8(batch.column(column))[1])
    part = np.cumsum(lengths) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for low, high in zip(edges, edges[1:], strict=False):
        if high > low:
            yield batch.slice(low, high - low)


def words(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word, and how many words each text has."""
    solid = ~_SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    filled = places[1:] > places[:-1]
    at, to = places[:-1][filled], places[1:][filled] - 1
    first[at], last[to] = solid[at], solid[to]
    begins = np.flatnonzero(first)
    before = np.searchsorted(begins, places)
    return begins, np.flatnonzero(last) + 1, np.diff(before)


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, case of A-Z ignored."""
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up, out=sums[1:])
    return mix((sums[ends] - sums[begins]) * down[begins])


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and how many each text has."""
    data, places = utf8(texts)
    begins, ends, counts = words(data, places)
    return word_hashes(data, begins, ends), counts


def shingles(hashes: np.ndarray, counts: np.ndarray, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of five words, and how many each text has.

    A text of one to four words has one shingle, all of its words; with ``short=False`` it has none.
    """
    k = WORDS_PER_SHINGLE
    made = np.zeros(len(hashes), np.uint64)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(hashes))  # words to the end of the text
    for i in range(k):
        here = hashes[i:] * _PLACE[i]
        here[left[: len(here)] <= i] = 0
        made[: len(here)] += here
    at_start = np.zeros(len(hashes), bool)
    at_start[(np.cumsum(counts) - counts)[counts > 0]] = True
    kept = (left >= k) | (at_start if short else False)
    per_text = np.maximum(counts - k + 1, np.minimum(counts, 1) if short else 0)
    return mix(made[kept]), per_text


def as_list(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Rows of ``counts`` values each as an Arrow list column."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))
