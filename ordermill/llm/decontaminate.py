"""Benchmark items inside documents, by size-partitioned MinHash containment search (operator 10).

Items of at most ``SHORT`` five-word shingles are looked up exactly: an item that is there has at least one of a few of its
shingles, as many as may be missing and one more, in the document.  Larger items are split by their number of shingles into
classes; class ``k`` holds items of more than ``2**(k-1)`` and at most ``2**k`` shingles.  For each class, documents are seen through windows of three blocks of ``2**(k-1)``
shingles, one block apart, so that any run as long as an item lies in one window and the Jaccard similarity of the two
sets stays high however long the document is: at least 0.25 where four fifths of an item's shingles are there.  Window and item
become candidates if one of ``HASHES`` MinHash values is equal, which misses such a pair with a probability of
about 1e-6.  Minima of larger blocks come from those of smaller ones, so all classes cost little more than one.
Candidates are verified by the exact share of the item's shingles that the whole document holds.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ordermill.llm.columns import hashed_words, shingles, slices

THRESHOLD = 0.8
HASHES = 48
ITEMS_PER_PASS = 20_000  # items in one broadcast; more are searched for in further passes over the documents
ITEM_BYTES_PER_PASS = 32 << 20  # of the items' texts

_U = np.uint64
_RNG = np.random.default_rng(20240210)
_FLIP = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_ODD = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) | _U(1)
SMALLEST = 3  # the first class holds items of at most 2**3 shingles
SHORT = 1 << (SMALLEST - 1)  # shingles; items of no more belong to no class, as windows would be too wide for them


class Items:
    """Exact shingle sets of some items, the shingles that tell short ones and, per size class, MinHash values."""

    def __init__(self, ids: list, texts: list, threshold: float = THRESHOLD):
        hashes, counts = hashed_words(pa.array(texts, pa.string()))
        made, per_item = shingles(hashes, counts, short=False)
        sets = [np.unique(x) for x in np.split(made, np.cumsum(per_item)[:-1])] if len(ids) else []
        known: dict[bytes, list] = {}
        for item, own in zip(ids, sets, strict=True):
            if len(own):
                known.setdefault(own.tobytes(), []).append(item)  # items of equal sets are one
        self.ids = list(known.values())
        self.sets = [np.frombuffer(k, np.uint64) for k in known]
        self.classes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by_class: dict[int, list[int]] = {}
        for i, own in enumerate(self.sets):
            if len(own) > SHORT:
                by_class.setdefault(math.ceil(math.log2(len(own))), []).append(i)
        self.telling, self.told = self._telling([i for i, own in enumerate(self.sets) if len(own) <= SHORT], threshold)
        for k, members in by_class.items():
            values = np.stack([np.array([((self.sets[i] ^ f) * o).min() for f, o in zip(_FLIP, _ODD, strict=True)]) for i in members], 1)
            flat = (values ^ np.arange(HASHES, dtype=np.uint64)[:, None]).reshape(-1)  # a value counts for its own hash
            order = np.argsort(flat)
            self.classes[k] = flat[order], np.tile(np.array(members), HASHES)[order]

    def _telling(self, short: list[int], threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Shingles of which an item must have one in the document, in order, and their items; shared ones last."""
        if not short:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        kinds, n = np.unique(np.concatenate([self.sets[i] for i in short]), return_counts=True)
        chosen = []
        for i in short:
            own = self.sets[i]
            most_missing = len(own) - math.ceil(threshold * len(own) - 1e-9)
            chosen.append(own[np.argsort(n[np.searchsorted(kinds, own)], kind="stable")][: most_missing + 1])
        hashes, items = np.concatenate(chosen), np.repeat(short, [len(c) for c in chosen])
        order = np.argsort(hashes)
        return hashes[order], items[order]

    def _told(self, made: np.ndarray, per_text: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) pairs of short items of which a telling shingle is in the text."""
        if not len(self.telling):
            return set()
        low = np.searchsorted(self.telling, made)
        hit = np.flatnonzero(self.telling[np.minimum(low, len(self.telling) - 1)] == made)
        owner = np.repeat(np.arange(len(per_text)), per_text)[hit]
        high = np.searchsorted(self.telling, made[hit], "right")
        return {(text, int(self.told[at])) for text, a, b in set(zip(owner.tolist(), low[hit].tolist(), high.tolist(), strict=True)) for at in range(a, b)}

    def candidates(self, made: np.ndarray, per_text: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) pairs that share a telling shingle, or of which a window and the item share a MinHash value."""
        found = self._told(made, per_text)
        texts = np.flatnonzero(per_text)
        if not len(texts) or not self.classes:
            return found
        size = 1 << (SMALLEST - 1)
        own = per_text[texts]
        blocks = -(-own // size)
        first = np.cumsum(own) - own
        within = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        starts = np.repeat(first, blocks) + within * size
        minima = np.empty((HASHES, len(starts)), np.uint64)
        held = np.empty_like(made)
        for j in range(HASHES):
            np.bitwise_xor(made, _FLIP[j], out=held)
            np.multiply(held, _ODD[j], out=held)
            minima[j] = np.minimum.reduceat(held, starts)
        for k in range(SMALLEST, max(self.classes) + 1):
            if k > SMALLEST:  # blocks of this class are two of the one before
                within = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                minima = np.minimum.reduceat(minima, np.flatnonzero(within % 2 == 0), axis=1)
                blocks = -(-blocks // 2)
            if k in self.classes:
                owner = np.repeat(texts, blocks)
                found |= self._equal(k, minima, owner)
        return found

    def _equal(self, k: int, minima: np.ndarray, owner: np.ndarray) -> set[tuple[int, int]]:
        values, members = self.classes[k]
        windows = minima.copy()
        for ahead in (1, 2):
            same = owner[ahead:] == owner[:-ahead]
            if len(same):
                windows[:, : len(same)] = np.where(same, np.minimum(windows[:, : len(same)], minima[:, ahead:]), windows[:, : len(same)])
        windows ^= np.arange(HASHES, dtype=np.uint64)[:, None]
        low = np.searchsorted(values, windows)
        hit = values[np.minimum(low, len(values) - 1)] == windows
        pairs: set[tuple[int, int]] = set()
        for j, w in zip(*np.nonzero(hit), strict=True):
            at = low[j, w]
            while at < len(values) and values[at] == windows[j, w]:
                pairs.add((int(owner[w]), int(members[at])))
                at += 1
        return pairs


def _passes(benchmark: DataFrame) -> Iterator[tuple[list, list]]:
    """The items in lots of bounded number and bytes; the driver holds one lot."""
    ids, texts, held = [], [], 0
    for row in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        ids.append(row.item_id)
        texts.append(row.text)
        held += len(row.text)
        if len(ids) >= ITEMS_PER_PASS or held >= ITEM_BYTES_PER_PASS:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, item_shingles, shared and containment of every document that holds an item.

    An item is in a document if at least ``threshold`` of its distinct shingles are.  Null texts, and items of fewer than
    five words, match nothing; equal items are each reported; repeated documents are reported each; empty tables give no
    rows.  Items are broadcast in lots of bounded size, one pass over the documents for each lot.
    """
    kinds = "doc_id long, item_id long, item_shingles long, shared long, containment double"
    spark = docs.sparkSession
    found = spark.createDataFrame([], kinds)
    rows = docs.select("doc_id", "text")
    for ids, texts in _passes(benchmark):
        held = spark.sparkContext.broadcast(pickle.dumps(Items(ids, texts, threshold)))

        def search(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            items = pickle.loads(held.value)
            for batch in batches:
                for some in slices(batch, "text"):
                    yield _verified(some, items, threshold)

        found = found.union(rows.mapInArrow(search, kinds))
    return found


def _verified(batch: pa.RecordBatch, items: Items, threshold: float) -> pa.RecordBatch:
    made, per_text = shingles(*hashed_words(batch.column("text")), short=False)
    ends = np.cumsum(per_text)
    ids, out, last, sorted_set = batch.column("doc_id"), [], -1, None
    for text, item in sorted(items.candidates(made, per_text)):
        if text != last:
            last, sorted_set = text, np.unique(made[ends[text] - per_text[text] : ends[text]])
        own = items.sets[item]
        at = np.minimum(np.searchsorted(sorted_set, own), len(sorted_set) - 1)
        shared = int((sorted_set[at] == own).sum())
        if shared >= threshold * len(own) - 1e-9:
            out += [(ids[text].as_py(), i, len(own), shared, shared / len(own)) for i in items.ids[item]]
    columns = list(zip(*out, strict=True)) or [[]] * 5
    kinds = [pa.int64()] * 4 + [pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      ["doc_id", "item_id", "item_shingles", "shared", "containment"])


def clean_documents(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that hold a benchmark item; decided row by row, so ids need not be unique or present."""
    kept = docs
    for ids, texts in _passes(benchmark):
        held = docs.sparkSession.sparkContext.broadcast(pickle.dumps(Items(ids, texts, threshold)))

        def keep(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            items = pickle.loads(held.value)
            for batch in batches:
                for some in slices(batch, "text"):
                    numbered = pa.RecordBatch.from_arrays([pa.array(np.arange(some.num_rows)), some.column("text")], ["doc_id", "text"])
                    bad = _verified(numbered, items, threshold).column("doc_id")
                    good = np.ones(some.num_rows, bool)
                    good[np.asarray(bad, np.int64)] = False
                    yield some.filter(pa.array(good))

        kept = kept.mapInArrow(keep, docs.schema)
    return kept
