"""Spelling variant grouping by PartEnum signatures (operator 13).

Two words that differ by one letter put in, left out or replaced have multisets of letters that differ in two elements
at most.  A multiset is a binary vector over (letter, how often it came before), and these dimensions are dealt to
``CELLS`` cells.  Vectors of a Hamming distance of at most two agree in all cells but two, so a word's signatures are
its cells without any two of them, every choice once (partition and enumerate), and near words share at least one.
Signatures are joined by equality, pairs that meet are verified by their edit distance, and none is missed.

A word's form is its near word of most occurrences, if it has ``RATIO`` times the word's own.  Forms are followed to
the last by doubling: each round replaces a word's root by that root's root.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.columns import as_list, mix
from ordermill.llm.storage import settle_table

LETTER = r"[A-Za-zÀ-ÿ]"
LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
CELLS = 7
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_U = np.uint64
_CHOICES = list(combinations(range(CELLS), CELLS - 2))


def letter_runs(docs: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """doc_id and run, a row for each maximal run of at least ``least`` letters; A-Z in lower case, no other letter changed.

    Null and empty texts have none; repeated rows count each.
    """
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"{LETTER}{{{least},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(runs).alias("run")).withColumn("run", F.translate("run", _UPPER, _LOWER))


def count_words(runs: DataFrame, word: str | Column = "run", least: int = LEAST_LETTERS, count: int = LEAST_COUNT) -> DataFrame:
    """word and n of the words of at least ``least`` letters that occur at least ``count`` times.

    Occurrences are summed in every task before they are shuffled, so a frequent word is a few rows there.
    """
    word = F.col(word) if isinstance(word, str) else word
    kept = runs.select(word.alias("word")).where(F.char_length("word") >= least)
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= count)


def signature_values(words: pa.Array) -> np.ndarray:
    """The signatures of each word, a row of numbers: its letters in all cells but two, for every two."""
    texts = words.to_pylist()
    lengths = np.array([len(t) for t in texts], np.int64)
    letters = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    order = np.lexsort((letters, owner))
    letters, owner = letters[order], owner[order]
    new = np.ones(len(letters), bool)
    new[1:] = (letters[1:] != letters[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    before = np.arange(len(letters)) - np.repeat(starts, np.diff(np.append(starts, len(letters))))
    element = mix(letters << _U(32) | before.astype(np.uint64))
    cells = np.zeros((len(texts), CELLS), np.uint64)
    np.add.at(cells, (owner, (element % _U(CELLS)).astype(np.int64)), mix(element))
    made = np.empty((len(texts), len(_CHOICES)), np.uint64)
    for k, chosen in enumerate(_CHOICES):
        held = np.full(len(texts), k, np.uint64)
        for cell in chosen:
            held = mix(held * _U(0x9E3779B97F4A7C15) + cells[:, cell])
        made[:, k] = held
    return made.view(np.int64)


def signed(vocabulary: DataFrame) -> DataFrame:
    """word, n and signature, a row for each of a word's signatures."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = as_list(signature_values(batch.column("word")).reshape(-1), np.full(batch.num_rows, len(_CHOICES)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), held], ["word", "n", "signatures"])

    rows = vocabulary.select("word", "n").mapInArrow(sign, "word string, n long, signatures array<long>")
    return rows.select("word", "n", F.explode("signatures").alias("signature"))


def near_words(vocabulary: DataFrame) -> DataFrame:
    """word, n, near and near_n of all pairs of different words at an edit distance of one, each pair both ways."""
    rows = settle_table(signed(vocabulary), "signatures")
    one, other = rows, rows.withColumnsRenamed({"word": "near", "n": "near_n"})
    verified = (F.col("word") < F.col("near")) & (F.levenshtein("word", "near", 1) == 1)
    pairs = one.join(other, "signature").where(verified).groupBy("word", "near").agg(F.any_value("n").alias("n"), F.any_value("near_n").alias("near_n"))
    pairs = settle_table(pairs.select("word", "n", "near", "near_n"), "near-words")
    return pairs.union(pairs.select("near", "near_n", "word", "n"))


def last_forms(forms: DataFrame, most_steps: int) -> DataFrame:
    """word and root: where the chain of forms from each word ends, for chains of at most ``most_steps`` steps without a ring."""
    roots = settle_table(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(max(most_steps - 1, 0).bit_length()):  # each round doubles the steps taken
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        roots = settle_table(roots.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "roots")
    return roots


def spelling_groups(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, form, form_n, n_near and root of every row of ``vocabulary`` (word, n; a word once, n at least 1).

    ``n_near`` counts the words at an edit distance of one (of code points).  ``form`` is the one of most occurrences, the
    first in code-point order among equals, if it has at least ``ratio`` (2 or more) times the word's own; else null, as is
    ``form_n``.  ``root`` follows forms to the last and is the word itself without one.  An empty table gives no rows.
    """
    if ratio < 2:
        raise ValueError("a ratio below 2 allows rings of forms")
    vocabulary = settle_table(vocabulary.select("word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = near_words(vocabulary).groupBy("word").agg(F.any_value("n").alias("n"), F.count(F.lit(1)).alias("n_near"), best)
    enough = -F.col("best.less") >= ratio * F.col("n")
    near = settle_table(near.select("word", "n_near", F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")), "forms")
    most, least = vocabulary.agg(F.max("n"), F.min("n")).first()
    steps = 0
    while most is not None and least * ratio ** (steps + 1) <= most:  # each step has ``ratio`` times the occurrences
        steps += 1
    roots = last_forms(near.where("form IS NOT NULL"), steps)
    found = vocabulary.join(near, "word", "left").join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
