"""Hard-negative mining by a secondary sort of packed pair scores (operator 11).

Anchors meet all rows in blocks: a task holds one block of each and makes their integer inner products.  Two passes
keep what is shuffled small and lose nothing.  The first gives every anchor its first positives, which set the
windows of scores.  In the second a task sends, of each anchor and window, only its own first negatives: the first of
all tasks are among them.

A pair's score is packed with its kind into one number that falls as the score rises, positives ahead of equal
negatives, so (anchor, packed score, id) is its place.  Pairs are dealt to tasks by anchor and sorted there by that key.
An iterator then reads them in order: a positive opens its window, a negative is emitted to each window that is
open and not yet full.  It holds one anchor's windows and one Arrow batch, never the pairs of an anchor.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.near_duplicates import _group_ids, _runs
from ordermill.llm.storage import settle_table

SCALE = 256
BLOCK_NUMBERS = 1 << 21  # vector components of a block of rows
ANCHOR_NUMBERS = 1 << 20  # of a block of anchors
LEAST_ROWS = 1024  # rows of a block, where the table has so many
CHUNK_SCORES = 1 << 22  # scores in memory at a time
HELD_PAIRS = 1 << 19  # pairs kept before they are cut to the first ones again
NO_ID = (1 << 63) - 1  # rows without an id come last among equal scores
MOST = float(1 << 62)  # of a vector's sum of squares, so that every score fits 64 bits


def usable_rows(rows: DataFrame, label: Column | None = None) -> DataFrame:
    """row, vec_id, label, embedding and squares of the rows that take part.

    A row without a label or vector, or with a null or non-finite component, takes no part, nor does one whose scores
    would not fit 64 bits (components far beyond 10^6).
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = lambda x: F.floor(SCALE * x.cast("double")).cast("double")
    squares = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + whole(x) * whole(x))
    named = rows.select("vec_id", (F.col("label") if label is None else label).cast("long").alias("label"), "embedding").where("label IS NOT NULL AND embedding IS NOT NULL")
    return named.where(finite).withColumn("squares", squares).where(F.col("squares") < MOST).select(F.monotonically_increasing_id().alias("row"), "*")


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The vectors as whole numbers (a row each), filled up with zeros."""
    held = batch.column("embedding")
    lengths = held.value_lengths().to_numpy()
    made = np.zeros((batch.num_rows, width))
    flat = np.floor(SCALE * held.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    made[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return made


def _kind(batch: pa.RecordBatch) -> type:
    """The fastest numbers in which every inner product is exact: partial sums never exceed the product of the norms."""
    most = float(batch.column("squares").to_numpy().max(initial=0))
    return np.float32 if most < 2**24 else np.float64 if most < 2**52 else np.int64


def _firsts(anchor: np.ndarray, score: np.ndarray, vec: np.ndarray, most: int) -> np.ndarray:
    """Where the first ``most`` of each anchor are: highest score first, then smallest id."""
    order = np.lexsort((vec, -score, anchor))
    sorted_ = anchor[order]
    starts = np.searchsorted(sorted_, sorted_)
    return order[np.arange(len(order)) - starts < most]


class Pairs:
    """Scored pairs of a block's anchors, cut to those that may be needed when there are many."""

    def __init__(self, cut):
        self.cut, self.parts, self.n = cut, [], 0

    def add(self, *columns: np.ndarray) -> None:
        if len(columns[0]) > HELD_PAIRS // 2:
            columns = self._kept(columns)
        self.parts.append(columns)
        self.n += len(columns[0])
        if self.n > HELD_PAIRS:
            self.parts = [self.all()]
            self.n = len(self.parts[0][0])

    def _kept(self, columns):
        kept = self.cut(*columns[:3])
        return tuple(c[kept] for c in columns)

    def all(self) -> tuple[np.ndarray, ...]:
        """anchor, score, id and row of the pairs."""
        joined = tuple(np.concatenate(c) for c in zip(*self.parts, strict=True)) if self.parts else tuple(np.empty(0, np.int64) for _ in range(4))
        return self._kept(joined)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    """For each pair of blocks: the anchors' rows and whole numbers, the rows and theirs."""
    keys = ["a", "r"]
    for batch in _runs(batches, keys):
        group = _group_ids(batch, keys)
        for low, high in zip(*(lambda e: (e, [*e[1:], len(group)]))([0, *(np.flatnonzero(np.diff(group)) + 1)]), strict=True):
            some = batch.slice(low, high - low)
            is_row = some.column("is_row").to_numpy(zero_copy_only=False)
            first = int(np.argmax(is_row)) if is_row.any() else len(is_row)
            if 0 < first < len(is_row):
                anchors, rows, kind = some.slice(0, first), some.slice(first), _kind(some)
                yield anchors, _matrix(anchors, width).astype(kind), rows, _matrix(rows, width).astype(kind)


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy() for n in names]


def positive_pairs(blocks: DataFrame, width: int, most: int) -> DataFrame:
    """anchor, score, vec and other (rows) of each block's first ``most`` pairs of equal label."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, a, rows, b in _blocks(batches, width):
            a_row, a_label = _numbers(anchors, "row", "label")
            row, label, vec = _numbers(rows, "row", "label", "vec")
            held = Pairs(lambda anchor, score, vec: _firsts(anchor, score, vec, most))
            for name in np.intersect1d(a_label, label):
                ours, theirs = np.flatnonzero(a_label == name), np.flatnonzero(label == name)
                step = max(1, CHUNK_SCORES // len(ours))
                for low in range(0, len(theirs), step):
                    some = theirs[low : low + step]
                    scores = a[ours] @ b[some].T
                    usable = a_row[ours][:, None] != row[some][None, :]
                    if len(some) > most + 1:  # one place more, as an anchor does not count for itself
                        least = np.partition(scores, len(some) - most - 1, axis=1)[:, len(some) - most - 1]
                        usable &= scores >= least[:, None]
                    at, to = np.nonzero(usable)
                    held.add(a_row[ours[at]], scores[at, to].astype(np.int64), vec[some[to]], row[some[to]])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held.all()], ["anchor", "score", "vec", "other"])

    return blocks.mapInArrow(score, "anchor long, score long, vec long, other long")


def window_pairs(blocks: DataFrame, width: int, most: int, low: int, high: int) -> DataFrame:
    """anchor, score, vec and other of each block's first ``most`` pairs of unequal label in each of the anchor's ``windows``."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, a, rows, b in _blocks(batches, width):
            a_row, a_label = _numbers(anchors, "row", "label")
            row, label, vec = _numbers(rows, "row", "label", "vec")
            windows = anchors.column("windows")
            sizes = windows.value_lengths().to_numpy()
            tops = np.full((len(a_row), max(1, sizes.max(initial=0))), -1, np.int64)  # no score is in a window below 0
            tops[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = windows.flatten().to_numpy()
            place = np.argsort(a_row)

            def inside(anchor: np.ndarray, scores: np.ndarray, vec: np.ndarray) -> np.ndarray:
                own = tops[place[np.searchsorted(a_row[place], anchor)]]
                needed = np.zeros(len(anchor), bool)
                for k in range(own.shape[1]):
                    fits = np.flatnonzero(_in_window(scores, own[:, k], low, high))
                    needed[fits[_firsts(anchor[fits], scores[fits], vec[fits], most)]] = True
                return np.flatnonzero(needed)

            held = Pairs(inside)
            highest = tops.max(1)
            lowest = np.where(tops >= 0, tops, np.iinfo(np.int64).max).min(1)
            ours = np.flatnonzero(highest >= 0)
            floor = -(-low * (lowest[ours].astype(object)) // high).astype(np.int64) if len(ours) else highest[ours]
            step = max(1, CHUNK_SCORES // max(1, len(ours)))
            for at_row in range(0, len(row) if len(ours) else 0, step):
                some = slice(at_row, at_row + step)
                scores = a[ours] @ b[some].T
                fits = (scores <= highest[ours, None]) & (scores >= floor[:, None]) & (a_label[ours, None] != label[None, some])
                at, to = np.nonzero(fits)
                held.add(a_row[ours[at]], scores[at, to].astype(np.int64), vec[some][to], row[some][to])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held.all()], ["anchor", "score", "vec", "other"])

    return blocks.mapInArrow(score, "anchor long, score long, vec long, other long")


def _in_window(score: np.ndarray, top: np.ndarray, low: int, high: int) -> np.ndarray:
    """low * top <= high * score <= high * top, by quotients, so that nothing overflows."""
    whole, rest = top // high, top % high  # low * top / high = low * whole + low * rest / high
    return (top >= 0) & (score <= top) & (score >= low * whole + -(-low * rest // high))


def emit(batches: Iterator[pa.RecordBatch], negatives: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Read pairs in order of anchor and packed score; a positive opens a window, a negative fills those that are open."""
    anchor, open_, opened = None, [], 0
    for batch in batches:
        out: list[tuple] = []
        for now, packed, vec in zip(*(batch.column(c).to_pylist() for c in ("anchor", "packed", "vec")), strict=True):
            if now != anchor:
                anchor, open_, opened = now, [], 0
            score, negative = -(packed >> 1), packed & 1
            if not negative:
                opened += 1
                open_.append([vec, score, 0, opened])
                continue
            open_ = [w for w in open_ if w[2] < negatives and low * w[1] <= high * score]  # scores fall: a window left is left for good
            for window in open_:
                window[2] += 1
                out.append((anchor, window[0], window[3], window[2], vec, window[1], score))
        columns = list(zip(*out, strict=True)) or [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "positive", "place", "rank", "negative", "positive_score", "negative_score"])


def hard_negatives(rows: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, place (of the positive, from 1), rank, negative_id, positive_score and negative_score.

    ``rows`` has vec_id, label and embedding; ``is_anchor`` and ``label`` are expressions on them.  A score is the inner
    product of the vectors' components times ``SCALE``, rounded down.  An anchor's positives are its first ``positives`` other
    rows of the same label, the highest score first, ties by smaller id; each gets the first ``negatives`` rows of another label
    with ``low`` * positive score <= ``high`` * score <= ``high`` * positive score.  A positive below 0 has none.

    Repeated rows are rows of their own, also as anchors; a row without an id is last among equal scores.  Of vectors of
    unequal length the shorter counts as filled up with zeros; an empty vector has score 0.  See ``usable_rows`` for rows
    that take no part.  An empty table gives no rows.
    """
    if not 0 < low <= high:
        raise ValueError("a window goes from a positive share of the score up to the score")
    spark = rows.sparkSession
    anchors = F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")
    held = settle_table(usable_rows(rows, label).select("*", anchors), "vectors")
    n, n_anchors, width = held.agg(F.count(F.lit(1)), F.count_if("is_anchor"), F.max(F.size("embedding"))).first()
    width = max(1, width or 0)
    row_blocks = max(1, math.ceil(n * width / BLOCK_NUMBERS), min(spark.sparkContext.defaultParallelism, n // LEAST_ROWS))
    anchor_blocks = max(1, math.ceil(n_anchors * width / ANCHOR_NUMBERS))
    vec = F.coalesce("vec_id", F.lit(NO_ID)).alias("vec")
    number = lambda blocks: F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    common = ["row", vec, "label", "embedding", "squares"]

    def met(anchors: DataFrame) -> DataFrame:
        ours = anchors.select(number(anchor_blocks).alias("a"), every(row_blocks).alias("r"), F.lit(False).alias("is_row"), *common, "windows")
        theirs = held.select(every(anchor_blocks).alias("a"), number(row_blocks).alias("r"), F.lit(True).alias("is_row"), *common, F.lit(None).cast("array<long>").alias("windows"))
        blocks = ours.unionByName(theirs)
        return blocks.repartition(min(row_blocks * anchor_blocks, 4096), "a", "r").sortWithinPartitions("a", "r", "is_row")

    asked = held.where("is_anchor").withColumn("windows", F.array().cast("array<long>"))
    first = positive_pairs(met(asked), width, positives)
    order = F.struct((-F.col("score")).alias("less"), "vec", "other")
    found = first.groupBy("anchor").agg(F.slice(F.array_sort(F.collect_list(order)), 1, positives).alias("found"))  # a few of each block
    found = settle_table(found, "positives")
    windows = found.select(F.col("anchor").alias("row"), F.transform("found", lambda x: -x["less"]).alias("windows"))
    second = window_pairs(met(held.where("is_anchor").join(windows, "row")), width, negatives, low, high)
    ours = found.select("anchor", F.explode("found").alias("x")).select("anchor", (2 * F.col("x.less")).alias("packed"), "x.vec")
    theirs = second.select("anchor", (1 - 2 * F.col("score")).alias("packed"), "vec")
    ordered = ours.union(theirs).repartition("anchor").sortWithinPartitions("anchor", "packed", "vec")
    kinds = "anchor long, positive long, place long, rank long, negative long, positive_score long, negative_score long"
    made = ordered.mapInArrow(lambda batches: emit(batches, negatives, low, high), kinds)
    names = held.where("is_anchor").select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return made.join(names, "anchor").select(
        "anchor_id", known("positive").alias("positive_id"), F.col("place").cast("int").alias("place"), F.col("rank").cast("int").alias("rank"),
        known("negative").alias("negative_id"), "positive_score", "negative_score")
