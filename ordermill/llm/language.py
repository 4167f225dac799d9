"""Language identification by prediction by partial matching (operator 1).

For every language, context trees of up to ``ORDER`` bytes are counted over a bounded sample of labelled texts and then
frozen.  A byte costs -log2 of its probability in the longest context that has seen it; a context that has not escapes
to the next shorter one with the probability of method C (distinct successors against all), the bytes it has seen
being excluded there, down to a uniform byte.  The sum over a text is its exact code length, and the language with the
shortest code wins.

All languages' trees are kept as tables of context and byte, one per order, with the cost in each language side by
side, so that one look-up serves all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.columns import SLICE_BYTES, slices, utf8
from ordermill.llm.names import free_name
from ordermill.llm.worker import begin

ORDER = 4
TEXTS_PER_LANGUAGE = 300  # the sample: so many texts at most of each language, chosen by a hash
BYTES_PER_LANGUAGE = 6_000_000  # shared evenly by a language's texts in the sample; a longer text gives windows from all of it
WINDOW_CHARS = 500
PIECE_BYTES = 1 << 18  # bytes scored at a time, so that memory does not follow the length of a text
EVIDENCE_BYTES = 64  # the score weighs the languages as if the text had at most so many bytes
UNKNOWN = "und"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Table:
    """Open-addressed table of numbers below 2**62; ``find`` gives slots, or -1."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.slot_of = np.empty(len(keys), np.int64)
        left, slot = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = self.keys[slot] == -1
            taken, first = np.unique(slot[free], return_index=True)
            chosen = np.flatnonzero(free)[first]
            self.keys[taken] = keys[left[chosen]]
            self.slot_of[left[chosen]] = taken
            rest = np.ones(len(left), bool)
            rest[chosen] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MULTIPLIER) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._home(keys)
        held = self.keys[slot]
        found = np.where(held == keys, slot, -1)
        open_ = np.flatnonzero((held != keys) & (held != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            held = self.keys[slot[open_]]
            hit = held == keys[open_]
            found[open_[hit]] = slot[open_[hit]]
            open_ = open_[~hit & (held != -1)]
        return found

    def spread(self, rows: np.ndarray) -> np.ndarray:
        """``rows``, one for each key, in slots."""
        wide = np.zeros((len(self.keys), *rows.shape[1:]), rows.dtype)
        wide[self.slot_of] = rows
        return wide


def grams(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The number made of the last ``ORDER`` bytes and the byte itself, for each byte; texts begin after line ends."""
    filled = np.diff(places)
    at = np.arange(len(data)) - np.repeat(places[:-1], filled)
    found = data.astype(np.int64)
    for back in range(1, ORDER + 1):
        earlier = np.full(len(data), 10, np.int64)
        earlier[back:] = np.where(at[back:] >= back, data[:-back], 10) if back < len(data) else earlier[back:]
        found |= earlier << (8 * back)
    return found


class Model:
    """Frozen statistics of some languages."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        whole = [grams(*utf8(pa.array(samples[name], pa.string()))) for name in self.languages]
        n = len(self.languages)
        self.orders = []  # (bytes in context, costs by slot, contexts, escapes by slot)
        for k in range(ORDER + 1):
            low = (1 << (8 * (k + 1))) - 1
            seen = [np.unique(w & low, return_counts=True) for w in whole]
            keys = np.unique(np.concatenate([s[0] for s in seen]))
            contexts = np.unique(keys >> 8)
            suffix = keys & (low >> 8)
            under = np.full((len(keys), n), 8.0)  # the cost one order lower; a uniform byte below order 0
            if k:
                table, costs, *_ = self.orders[-1]
                under = costs[table.find(suffix)].astype(np.float64)
            cost, escape = np.empty((len(keys), n)), np.zeros((len(contexts), n))
            for i, (own, count) in enumerate(seen):
                at = np.searchsorted(keys, own)
                place = np.searchsorted(contexts, own >> 8)
                total = np.bincount(place, count, len(contexts))
                kinds = np.bincount(place, minlength=len(contexts))
                excluded = np.bincount(place, np.exp2(-under[at, i]), len(contexts))
                left = np.maximum(1 - excluded, 1e-9)
                known = kinds > 0
                escape[known, i] = -np.log2(kinds[known] / (total[known] + kinds[known]) / left[known])
                cost[:, i] = under[:, i] + escape[np.searchsorted(contexts, keys >> 8), i]
                cost[at, i] = -np.log2(count / (total + kinds)[place])
            table, beyond = Table(keys), Table(contexts)
            self.orders.append((table, table.spread(cost.astype(np.float32)), beyond, beyond.spread(escape.astype(np.float32))))

    def code_lengths(self, data: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Bits of each text (rows) in each language (columns)."""
        bits = np.zeros((len(places) - 1, len(self.languages)))
        for low in range(0, len(data), PIECE_BYTES):
            high = min(low + PIECE_BYTES, len(data))
            first, last = int(np.searchsorted(places, low, "right")) - 1, int(np.searchsorted(places, high))
            begins = max(low - ORDER, int(places[first]))  # the contexts of a text that the piece cuts
            costs = self._costs(grams(data[begins:high], np.clip(places[first : last + 1], begins, high) - begins)[low - begins :])
            edges = np.clip(places[first : last + 1], low, high) - low
            filled = np.flatnonzero(np.diff(edges))
            for i in range(bits.shape[1]):
                bits[first + filled, i] += np.add.reduceat(costs[:, i], edges[:-1][filled], dtype=np.float64)
        return bits

    def _costs(self, whole: np.ndarray) -> np.ndarray:
        """Bits of each byte, named by its gram, in each language."""
        costs = np.zeros((len(whole), len(self.languages)), np.float32)
        left = np.arange(len(whole))
        for k in range(ORDER, -1, -1):
            table, known, beyond, escapes = self.orders[k]
            key = whole[left] & ((1 << (8 * (k + 1))) - 1)
            slot = table.find(key)
            hit = slot >= 0
            costs[left[hit]] += known[slot[hit]]
            left, key = left[~hit], key[~hit]
            if not len(left):
                break
            slot = beyond.find(key >> 8)
            seen = slot >= 0
            costs[left[seen]] += escapes[slot[seen]]
        costs[left] += 8.0
        return costs


def windows(text: Column, most: Column, seed: Column) -> Column:
    """The text, or about ``most`` bytes of a longer one: a window from each of equal stretches of the whole text, placed by a hash."""
    chars, size = F.char_length(text), F.octet_length(text)
    take = F.greatest(F.lit(1), F.floor(most * chars / size)).cast("long")
    pieces = F.ceil(take / WINDOW_CHARS).cast("int")

    def piece(k: Column) -> Column:
        length = F.least(F.lit(WINDOW_CHARS).cast("long"), take - k * WINDOW_CHARS)
        share = F.pmod(F.xxhash64(seed, k), F.lit(1 << 20)) / (1 << 20)
        start = F.floor(k * chars / pieces + share * F.greatest(F.lit(0), chars / pieces - length)).cast("long")
        return F.substring(text, F.least(start, chars - length).cast("int") + 1, length.cast("int"))

    return F.when(size <= most, text).otherwise(F.array_join(F.transform(F.sequence(F.lit(0), pieces - 1), piece), ""))


def fit(labelled: DataFrame) -> Model | None:
    """Count the sample of ``labelled`` (doc_id, text, lang); None without any labelled text.

    No label is left out for the length of its texts: the driver gets at most ``TEXTS_PER_LANGUAGE`` texts of each
    language, and of each text about its even share of ``BYTES_PER_LANGUAGE`` at most, as windows; only empty
    texts teach nothing.  Languages are thinned by a hash before they are ranked, so that no task ranks all texts of a
    frequent one, and only the windows are ranked.
    """
    rows = labelled.select("doc_id", "text", "lang").where("lang IS NOT NULL AND octet_length(text) > 0")
    counts = rows.groupBy("lang").count().collect()  # one row for each language
    if not counts:
        return None
    spark, full = labelled.sparkSession, 1 << 40
    limits = [(r["lang"], int(full * min(1.0, 4 * TEXTS_PER_LANGUAGE / r["count"])), BYTES_PER_LANGUAGE // min(TEXTS_PER_LANGUAGE, r["count"])) for r in counts]
    shares = spark.createDataFrame(limits, "lang string, share long, most long")
    chosen = rows.withColumn("_h", F.pmod(F.xxhash64("doc_id", "text"), F.lit(full))).join(F.broadcast(shares), "lang").where("_h < share")
    chosen = chosen.select("lang", "_h", "doc_id", windows(F.col("text"), F.col("most"), F.col("_h")).alias("text"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("_h", "doc_id", "text"))
    samples: dict[str, list[str]] = {}
    for r in chosen.withColumn("_n", first).where(F.col("_n") <= TEXTS_PER_LANGUAGE).select("lang", "text").collect():
        samples.setdefault(r.lang, []).append(r.text)
    return Model({name: sorted(texts) for name, texts in samples.items()}) if samples else None


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with lang_pred, score and bits_per_byte; columns of these names are replaced.

    Null texts, texts without a letter and any text without a model are ``und`` with score 0 and null bits_per_byte.
    Of languages with equal codes the first by name wins.  Rows are kept one for one; an empty table stays empty.
    """
    made, letter = ("lang_pred", "score", "bits_per_byte"), free_name("_letter", docs.columns)
    named = docs.drop(*made).withColumn(letter, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    schema = named.drop(letter).selectExpr("*", "'' AS lang_pred", "0D AS score", "CAST(NULL AS DOUBLE) AS bits_per_byte").schema
    held = docs.sparkSession.sparkContext.broadcast(model)  # one copy for each worker, dropped with the next stage's tasks
    most = SLICE_BYTES * 4 // max(4, len(model.languages) if model else 1)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin()
        frozen = held.value
        for batch in batches:
            for some in slices(batch, "text", most):
                letters = np.asarray(some.column(letter))
                kept = [some.column(c) for c in some.schema.names if c != letter]
                if frozen is None:
                    found = [[UNKNOWN] * some.num_rows, np.zeros(some.num_rows), [None] * some.num_rows]
                else:
                    data, places = utf8(some.column("text"))
                    sizes = np.maximum(np.diff(places), 1)[:, None]
                    bits = frozen.code_lengths(data, places)
                    best = bits.argmin(1)
                    weighed = bits * np.minimum(1.0, EVIDENCE_BYTES / sizes)
                    shares = np.exp2(weighed.min(1, keepdims=True) - weighed)
                    score = np.where(letters, 1 / shares.sum(1), 0.0)
                    cost = bits.min(1) / sizes[:, 0]
                    names = [frozen.languages[b] if known else UNKNOWN for b, known in zip(best, letters, strict=True)]
                    found = [names, score, pa.array(cost, mask=~letters)]
                columns = [pa.array(x, k) if not isinstance(x, pa.Array) else x for x, k in zip(found, (pa.string(), pa.float64(), pa.float64()), strict=True)]
                yield pa.RecordBatch.from_arrays([*kept, *columns], names=schema.names)

    return named.mapInArrow(label, schema)
