"""Hashed maximum-entropy language model with a class-factored softmax (operator 5).

The chance of a word is that of its class, given the words before, times that of the word in its class, given the same.
A word's class is given by its last two bytes, the most frequent endings having classes of their own; the end of a text is
a class too.  The class is a softmax over hashed features: the word before, the word two back (a skip) and both together,
besides a bias.  The word is a softmax over all words of its class: its bias is its smoothed share, and each template's
value in that class has weights for two hashes of the word.  The sum over a class's words is exact: words that agree in
both hashes have the same weights, so that their shares are added up beforehand.  One unknown word belongs to each class;
it has a bias alone.  Weights of both rise and fall with the gradient, observed against expected counts of feature
and outcome over all training tokens, in steps scaled for each weight as in iterative scaling; tasks add up their counts
and the driver, which holds the weights alone, applies them.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.columns import mix, slices, utf8, word_hashes, words
from ordermill.llm.storage import new_folder, read_arrow, settle_at

CLASSES = 32
FEATURES = 1 << 14  # hashed values of each of the three templates
TEMPLATES = 3
VALUES = 16  # of each of a word's two hashes
SLOTS = FEATURES // (2 * VALUES)  # hashed values of each template in each class, for the words of the class
UPDATES = 2
PRIOR = 30.0  # tokens by which each feature's class counts are drawn to the mean
EXTRA = 0.1  # added to each word's count
BROADCAST_WORDS = 8_000_000  # a vocabulary of at most so many words (12 bytes each) is read whole by every worker
END = np.uint64(0xD1B54A32D192ED03)
START = np.uint64(0x2545F4914F6CDD1D)
END_TAIL = 1 << 16
_U = np.uint64
_ODD = _U(0xC2B2AE3D27D4EB4F)


def tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and endings of all tokens, each text's words and one end, and how many tokens each text has."""
    data, places = utf8(batch.column("text"))
    begins, ends, counts = words(data, places)
    lower = np.where((data >= 65) & (data <= 90), data + 32, data)
    tail = lower[ends - 1].astype(np.int64) if len(ends) else np.empty(0, np.int64)
    tail += np.where(ends - begins > 1, lower[np.maximum(ends - 2, 0)].astype(np.int64) << 8, 0) if len(ends) else 0
    at = np.arange(len(begins)) + np.repeat(np.arange(len(counts)), counts)
    all_hashes, all_tails = np.full(len(begins) + len(counts), END), np.full(len(begins) + len(counts), END_TAIL, np.int64)
    all_hashes[at], all_tails[at] = word_hashes(data, begins, ends), tail
    return all_hashes, all_tails, counts + 1


def features(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Feature numbers of each token, one row per template."""
    first = np.cumsum(counts) - counts
    one, two = np.roll(hashes, 1), np.roll(hashes, 2)
    one[first] = two[first] = START
    two[(first + 1)[counts > 1]] = START
    both = mix(one * _ODD + two)
    return np.stack([(x >> _U(50)).astype(np.int64) for x in (one, mix(two), both)])


def word_values(hashes: np.ndarray) -> np.ndarray:
    """The columns of both hashes of each word."""
    return np.stack([hashes >> _U(60), ((hashes >> _U(56)) & _U(VALUES - 1)) + _U(VALUES)]).astype(np.int64)


def _runs(kinds: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each kind (a small number) that occurs, and where."""
    order = np.argsort(kinds.astype(np.uint16), kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(kinds[order]) != 0, [True]])) if len(kinds) else []
    for low, high in zip(edges, edges[1:], strict=False):
        yield int(kinds[order[low]]), order[low:high]


@dataclass
class Model:
    total: int  # training tokens
    kinds: int  # distinct training tokens
    class_of: np.ndarray  # by ending
    class_total: np.ndarray
    class_kinds: np.ndarray
    bias: np.ndarray
    weights: np.ndarray  # template, class, feature
    shares: np.ndarray  # class, first hash, second hash: smoothed share in the class of its words with these
    word_weights: np.ndarray  # template, class, value of the first or of the second hash, slot
    vocabulary: str  # folder of the words' counts

    def class_logs(self, found: np.ndarray) -> np.ndarray:
        """Natural logarithms of the classes' chances for each token."""
        scores = _added(self.weights, found) + self.bias[:, None]
        scores -= scores.max(0)
        scores -= np.log(np.exp(scores).sum(0))
        return scores.T

    def word_scores(self, own: int, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For tokens of one class: weights of both hashes' values, the same raised, and the sum over the class's words.

        A weight is a sum of logarithms of ratios of counts, shared among templates and hashes: raised, it stays a finite number.
        """
        scores = _added(self.word_weights[:, own], found % SLOTS)
        raised = np.exp(scores).astype(np.float64)
        unknown = EXTRA / (self.class_total[own] + EXTRA * (self.class_kinds[own] + 1))
        return scores, raised, np.einsum("ij,ij->j", self.shares[own].T @ raised[:VALUES], raised[VALUES:]) + unknown

    def word_chances(self, own: int, found: np.ndarray) -> np.ndarray:
        """Chances of both hashes' values for tokens of one class."""
        _, raised, whole = self.word_scores(own, found)
        one, two = raised[:VALUES], raised[VALUES:]
        return np.concatenate([one * (self.shares[own] @ two), two * (self.shares[own].T @ one)]) / whole


def _added(weights: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Sums over the templates of the columns found."""
    scores = weights[0].take(found[0], 1, mode="clip")
    for t in range(1, TEMPLATES):
        scores += weights[t].take(found[t], 1, mode="clip")
    return scores


def word_counts(train: DataFrame) -> DataFrame:
    """word (hash), tail and n of every training token; tasks send one row for each word that they have."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def merged():
            hashes, tails, n = (np.concatenate(c) for c in zip(*held, strict=True))
            kinds, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            return kinds, tails[index], np.bincount(inverse, n, len(kinds)).astype(np.int64)

        for batch in batches:
            for some in slices(batch, "text"):
                hashes, tails, _ = tokens(some)
                held.append((hashes, tails, np.ones(len(hashes), np.int64)))
                if len(held) > 8:
                    held = [merged()]
                    if len(held[0][0]) > 2_000_000:
                        yield _count_rows(held.pop())
        if held:
            yield _count_rows(merged())

    rows = train.select("text").mapInArrow(count, "word long, tail int, n long")
    return rows.groupBy("word").agg(F.first("tail").alias("tail"), F.sum("n").alias("n"))


def _count_rows(counted: tuple) -> pa.RecordBatch:
    hashes, tails, n = counted
    return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(tails.astype(np.int32)), pa.array(n)], ["word", "tail", "n"])


def feature_counts(train: DataFrame, model: Model, expected: bool) -> np.ndarray:
    """Counts over all tokens, as they are or as the model expects them.

    First those of template, class and feature, then those of template, class, and each value of a word's hashes with each slot.
    """
    held = train.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frozen = pickle.loads(held.value)
        sums = np.zeros((2, TEMPLATES, CLASSES, FEATURES))
        of_words = sums[1].reshape(TEMPLATES, CLASSES, 2 * VALUES, SLOTS)
        for batch in batches:
            for some in slices(batch, "text", 1 << 20):
                hashes, tails, counts = tokens(some)
                found, own = features(hashes, counts), frozen.class_of[tails]
                if expected:
                    chances = np.exp(frozen.class_logs(found)).T
                    for t in range(TEMPLATES):
                        for c in range(CLASSES):
                            sums[0, t, c] += np.bincount(found[t], chances[c], FEATURES)
                    runs = list(_runs(own))
                    chances = np.concatenate([frozen.word_chances(c, found[:, at]).astype(np.float32) for c, at in runs], 1)
                    order = np.concatenate([at for _, at in runs])
                    for t in range(TEMPLATES):
                        cells = own[order] * SLOTS + found[t, order] % SLOTS
                        for v in range(2 * VALUES):
                            of_words[t, :, v] += np.bincount(cells, chances[v], CLASSES * SLOTS).reshape(CLASSES, SLOTS)
                else:
                    cells = (own * (2 * VALUES) + word_values(hashes)) * SLOTS
                    for t in range(TEMPLATES):
                        sums[0, t] += np.bincount(own * FEATURES + found[t], minlength=CLASSES * FEATURES).reshape(CLASSES, FEATURES)
                        both = (cells + found[t] % SLOTS).reshape(-1)
                        of_words[t] += np.bincount(both, minlength=of_words[t].size).reshape(of_words[t].shape)
        for row, own_sums in enumerate(sums.reshape(-1, FEATURES)):
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([own_sums.astype("<f4").tobytes()])], ["row", "sums"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, sums in zip(batch.column("row").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                total[row] = total.get(row, 0) + np.frombuffer(sums, "<f4").astype(np.float64)
        for row, sums in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([sums.tobytes()])], ["row", "sums"])

    kinds = "row int, sums binary"
    rows = train.select("text").mapInArrow(add_up, kinds).repartition("row").mapInArrow(merge, kinds).collect()  # two rows for each template and class
    found = np.zeros((2 * TEMPLATES * CLASSES, FEATURES))
    for r in rows:
        found[r["row"]] = np.frombuffer(r["sums"])
    return found.reshape(2, TEMPLATES, CLASSES, FEATURES)


def fit(train: DataFrame) -> Model:
    """Count all training tokens, choose the classes, and train the weights in ``UPDATES`` distributed updates."""
    folder = new_folder(train.sparkSession, "words")
    vocabulary = settle_at(word_counts(train), folder)
    tails = vocabulary.groupBy("tail").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()  # 65,537 rows at most
    class_of = np.ones(END_TAIL + 1, np.int64)
    ranked = sorted((r for r in tails if r.tail != END_TAIL), key=lambda r: (-r.n, r.tail))
    for c, r in enumerate(ranked[: CLASSES - 2]):
        class_of[r.tail] = c + 2
    class_of[END_TAIL] = 0
    class_total, class_kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in tails:
        class_total[class_of[r.tail]] += r.n
        class_kinds[class_of[r.tail]] += r.kinds
    total, kinds = int(class_total.sum()), int(class_kinds.sum())
    mean = (class_total + EXTRA) / (total + EXTRA * CLASSES)
    weights, word_weights = np.zeros((TEMPLATES, CLASSES, FEATURES), np.float32), np.zeros((TEMPLATES, CLASSES, 2 * VALUES, SLOTS), np.float32)
    shares = word_shares(vocabulary, class_of) / (class_total + EXTRA * (class_kinds + 1))[:, None, None]
    model = Model(total, kinds, class_of, class_total, class_kinds, np.log(mean).astype(np.float32), weights, shares, word_weights, folder)
    if not total:
        return model
    word_mean = np.concatenate([shares.sum(2), shares.sum(1)], 1)[..., None]  # class, value, slot
    drawn, word_drawn = PRIOR * mean[:, None], np.maximum(PRIOR * word_mean, 1e-9)  # a value that no word of the class has keeps weight 0
    each = lambda x: (x[0], x[1].reshape(word_weights.shape))
    seen, word_seen = each(feature_counts(train, model, expected=False))
    for update in range(UPDATES):
        if update:
            awaited, word_awaited = each(feature_counts(train, model, expected=True))
        else:  # without weights, a feature's classes and values are expected at their means
            awaited, word_awaited = seen.sum(1, keepdims=True) * mean[:, None], word_seen[:, :, :VALUES].sum(2, keepdims=True) * word_mean
        model.weights = (model.weights + np.log((seen + drawn) / (awaited + drawn)) / TEMPLATES).astype(np.float32)
        model.word_weights = (model.word_weights + np.log((word_seen + word_drawn) / (word_awaited + word_drawn)) / (2 * TEMPLATES)).astype(np.float32)
    return model


def word_shares(vocabulary: DataFrame, class_of: np.ndarray) -> np.ndarray:
    """Smoothed counts of the words of each class, first hash and second hash."""
    named = [(F.lit(int(tail)), F.lit(int(class_of[tail]))) for tail in np.flatnonzero(class_of != 1)]
    own = F.coalesce(F.element_at(F.create_map(*[x for pair in named for x in pair]), F.col("tail")), F.lit(1))
    cells = F.shiftrightunsigned("word", 56).cast("int")  # both hashes, 4 bits each
    rows = vocabulary.groupBy(own.alias("own"), cells.alias("cell")).agg((F.sum("n") + F.lit(EXTRA) * F.count(F.lit(1))).alias("n")).collect()
    found = np.zeros((CLASSES, VALUES * VALUES))
    for r in rows:
        found[r["own"], r["cell"]] = r["n"]
    return found.reshape(CLASSES, VALUES, VALUES)


@lru_cache(1)
def _vocabulary(folder: str) -> tuple[np.ndarray, np.ndarray]:
    table = read_arrow(folder, ["word", "n"])
    hashes, n = table.column("word").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(hashes)
    return hashes[order], n[order]


def looked_up(hashes: np.ndarray, known: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Counts of the hashes, 0 where unknown; distinct ones are looked up once, in order."""
    kinds, inverse = np.unique(hashes, return_inverse=True)
    if not len(known):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(known, kinds), len(known) - 1)
    return np.where(known[at] == kinds, n[at], 0)[inverse]


def score(docs: DataFrame, model: Model, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every whole text.

    Null and empty texts are an end alone.  Scores are sums of log10 over a text's tokens: by the words' smoothed shares
    (base), and by the model.  Without training tokens every chance is 1 and both are 0.  Repeated rows are
    scored each; an empty table gives no rows.

    Workers read the vocabulary whole from the shared folder while it is of at most ``broadcast_words`` words; beyond
    that, each text's distinct words are joined with it by a shuffle.
    """
    rows = docs.select("doc_id", "text")
    if model.kinds <= broadcast_words:
        return _score_with_table(rows, model)
    return _score_with_join(rows, model)


KINDS = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score_with_table(rows: DataFrame, model: Model) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frozen = pickle.loads(held.value)
        known, n = _vocabulary(frozen.vocabulary)
        for batch in batches:
            for some in slices(batch, "text", 1 << 20):
                hashes, tails, counts = tokens(some)
                seen = looked_up(hashes, known, n)
                own, chances, fits = _chances(frozen, hashes, tails, counts)
                base = np.log10((seen + EXTRA) / (frozen.total + EXTRA * (frozen.kinds + 1)))
                word = np.log10((seen + EXTRA) / (frozen.class_total + EXTRA * (frozen.class_kinds + 1))[own])
                yield _scored(some, frozen, counts, (seen > 0).astype(np.int64), base, chances + word + np.where(seen > 0, fits, 0))

    return rows.mapInArrow(weigh, KINDS)


def _chances(model: Model, hashes: np.ndarray, tails: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each token's class, the log10 of that class's chance over the sum of its words, and what the word's weights add if it is known."""
    own, fits = model.class_of[tails], np.zeros(len(hashes))
    if not model.total:
        return own, fits, fits
    found, values = features(hashes, counts), word_values(hashes)
    chances = model.class_logs(found)[np.arange(len(own)), own].astype(np.float64)
    for c, at in _runs(own):
        scores, _, whole = model.word_scores(c, found[:, at])
        each = np.arange(len(at))
        fits[at] = scores[values[0, at], each].astype(np.float64) + scores[values[1, at], each]
        chances[at] -= np.log(whole)
    return own, chances / np.log(10), fits / np.log(10)


def _scored(batch: pa.RecordBatch, model: Model, counts: np.ndarray, known: np.ndarray, base: np.ndarray, whole: np.ndarray) -> pa.RecordBatch:
    first = np.cumsum(counts) - counts
    add = lambda x: pa.array(np.add.reduceat(x, first))  # noqa: E731  every text has its end
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(counts), add(known), pa.array(np.full(len(counts), model.total)), add(base), add(whole)],
        ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def _score_with_join(rows: DataFrame, model: Model) -> DataFrame:
    """The same sums where words meet their counts in a shuffle; rows that repeat id and text count once in it."""
    spark = rows.sparkSession
    held = spark.sparkContext.broadcast(pickle.dumps(model))
    named = rows.withColumn("_text", F.xxhash64(F.coalesce("text", F.lit(""))))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frozen = pickle.loads(held.value)
        for batch in batches:
            for some in slices(batch, "text", 1 << 20):
                hashes, tails, counts = tokens(some)
                own, chances, fits = _chances(frozen, hashes, tails, counts)
                text = np.repeat(np.arange(len(counts)), counts)
                order = np.lexsort((hashes, text))
                new = np.concatenate([[True], (hashes[order][1:] != hashes[order][:-1]) | (text[order][1:] != text[order][:-1])])
                at = np.flatnonzero(new)
                kept = order[at]
                n = np.diff(np.concatenate([at, [len(order)]]))
                of_text = np.add.reduceat(chances, np.cumsum(counts) - counts)
                index = pa.array(text[kept])
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id").take(index), some.column("_text").take(index), pa.array(hashes[kept].view(np.int64)), pa.array(n),
                     pa.array(own[kept].astype(np.int32)), pa.array(counts[text[kept]]), pa.array(of_text[text[kept]]),
                     pa.array(np.add.reduceat(fits[order], at))],
                    ["doc_id", "_text", "word", "times", "class", "n_tokens", "_chances", "_fits"])

    each = named.dropDuplicates(["doc_id", "_text"]).mapInArrow(spread, "doc_id long, _text long, word long, times long, class int, n_tokens long, _chances double, _fits double")
    counted = each.join(spark.read.schema("word long, tail int, n long").parquet(model.vocabulary), "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    below = F.element_at(F.array(*[F.lit(float(x)) for x in model.class_total + EXTRA * (model.class_kinds + 1)]), F.col("class") + 1)
    sums = counted.groupBy("doc_id", "_text").agg(
        F.first("n_tokens").alias("n_tokens"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("times") * F.log10((F.col("n") + EXTRA) / (model.total + EXTRA * (model.kinds + 1)))).alias("base_score"),
        (F.first("_chances") + F.sum(F.col("times") * F.log10((F.col("n") + EXTRA) / below) + F.when(F.col("n") > 0, F.col("_fits")).otherwise(0.0))).alias("score")).withColumnsRenamed({"doc_id": "_doc", "_text": "_of"})
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_of"))
    joined = named.drop("text").join(sums, same).withColumn("train_tokens", F.lit(model.total).cast("long"))
    return joined.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
