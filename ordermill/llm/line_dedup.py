"""Line deduplication by an exact set-similarity join (operator 4).

A line is the set of its words; lines of equal sets are one node.  A word's rank is how often its bucket of a fixed hash
table occurs in all lines, then its hash: one order for all lines that puts rare words first.  Two sets of a
Jaccard similarity of at least t share a word among the first ``n - ceil(t n) + 1`` of each, so lines meet at these
words.  There, lengths, the place of the word and a 128-bit map of each set's words (words that just one of two maps has
are in just one of the sets) drop pairs that cannot reach t, and never others.  The lines that are left at a word form
teams, and a team met at several words is verified once: pairs by a map of 512 bits, then by exact Jaccard, until a line has an
earlier similar one.  A line goes if an earlier one, by document id and line number, is similar.

No step emits the pairs of a group: a word gives each line's team, a team each line's verdict, and groups beyond a
task's share are cut into blocks, of which a task compares two.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.columns import as_list, mix, slices, utf8, word_hashes, words
from ordermill.llm.components import Forest
from ordermill.llm.near_duplicates import _group_ids, _runs, block_pairs
from ordermill.llm.names import aside
from ordermill.llm.storage import new_folder, read_arrow, settle_at, settle_table

THRESHOLD = 0.8
BUCKETS = 1 << 23  # of the table of word counts; its size is fixed, words that share a bucket share a count
WORD_BLOCK = 1024  # lines that meet at one word, in a block
SPAN_ROWS = 1 << 16
SLOTS = 1 << 24  # of the set of wanted documents; its size is fixed, documents that share a slot pass together
GROUP_BLOCK = 2048  # lines of a candidate group in a block; a line is sent once for every block of its group
BLOCK_WORDS = 1 << 20
PART_WORDS = 1 << 21  # words that a task compares or sends at a time, but for a larger group
_U = np.uint64


def line_words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, the number of words of each line, and the number of lines of each text."""
    data, places = utf8(batch.column("text"))
    breaks = np.flatnonzero(data == 10)
    # A line ends after its line break or with the text; words never cross either, so lines are texts of their own.
    ends = np.union1d(breaks + 1, places[1:]) if len(data) else np.empty(0, np.int64)
    lines = np.concatenate([[0], ends[ends > 0]])
    begins, stops, counts = words(data, lines)
    filled = np.diff(places) > 0
    per_text = np.searchsorted(lines[1:], places[1:], "right") - np.searchsorted(lines[1:], places[:-1], "right")
    return word_hashes(data, begins, stops), counts, np.where(filled, per_text, 0)


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(64 - 23)).astype(np.int64)


def count_buckets(docs: DataFrame, folder: str) -> None:
    """Write how often each bucket of words occurs in all lines to ``folder``; at most ``BUCKETS`` rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, np.int32)
        for batch in batches:
            for some in slices(batch, "text"):
                np.add.at(sums, bucket(line_words(some)[0]), np.int32(1))
        used = np.flatnonzero(sums)
        for low in range(0, len(used), 1 << 20):
            own = used[low : low + (1 << 20)]
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(sums[own])], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket int, n int")
    settle_at(rows.groupBy("bucket").agg(F.sum(F.col("n").cast("long")).alias("n")), folder)


@lru_cache(1)
def _counts(folder: str) -> np.ndarray:
    table = read_arrow(folder, ["bucket", "n"])
    sums = np.zeros(BUCKETS, np.uint32)
    sums[table.column("bucket").to_numpy()] = np.minimum(table.column("n").to_numpy(), 0xFFFFFFFF)
    return sums


def rank(counts: np.ndarray) -> np.ndarray:
    """Counts as numbers of 19 bits in the same order; counts above 4,096 keep 12 leading bits."""
    return counts.astype(np.float32).view(np.uint32).astype(np.uint64) >> _U(12)


def in_order(line: np.ndarray, counts: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where the words stand by line, rank of their counts and hash; equal words of a line come together."""
    held, middle = rank(counts), (hashes >> _U(17)) & _U((1 << 24) - 1)
    if len(line) and line[-1] < 1 << 20:
        key = line.astype(np.uint64) << _U(44) | held << _U(24) | middle
        order = np.argsort(key)
        key, own = key[order], hashes[order]
        if not ((key[1:] == key[:-1]) & (own[1:] != own[:-1])).any():
            return order
    return np.lexsort((hashes, middle, held, line))


class LineSets:
    """The word sets of a batch's lines, each sorted by rank."""

    def __init__(self, batch: pa.RecordBatch, counts: np.ndarray):
        hashes, per_line, self.per_text = line_words(batch)
        line = np.repeat(np.arange(len(per_line)), per_line)
        n = counts[bucket(hashes)]
        order = in_order(line, n, hashes)
        hashes, line = hashes[order], line[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (line[1:] != line[:-1])
        self.words, self.line, self.n = hashes[new], line[new], n[order][new]
        self.sizes = np.bincount(self.line, minlength=len(per_line))
        self.ends = np.cumsum(self.sizes)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.words))])
        self.node = np.where(self.sizes > 0, mix(sums[self.ends] - sums[self.ends - self.sizes] + self.sizes.astype(np.uint64)), _U(0)).view(np.int64)
        self.text = np.repeat(np.arange(len(self.per_text)), self.per_text)
        self.number = np.arange(len(per_line)) - np.repeat(np.cumsum(self.per_text) - self.per_text, self.per_text)

    def maps(self) -> np.ndarray:
        """128 bits of each line, two numbers."""
        filled = np.flatnonzero(self.sizes)
        starts = (self.ends - self.sizes)[filled]
        held = np.zeros((len(self.sizes), 2), np.uint64)
        bit = mix(self.words) >> _U(57)
        for half in range(2):
            own = np.where(bit >> _U(6) == half, _U(1) << (bit & _U(63)), _U(0))
            if len(filled):
                held[filled, half] = np.bitwise_or.reduceat(own, starts)
        return held


def line_rows(docs: DataFrame, folder: str, threshold: float) -> DataFrame:
    """Every line with a word: its place (doc_id, text_hash, line), node, size, map and prefix.

    ``prefix`` has 32 bits of the first words' hashes, without the ``skip`` words that occur once in all lines; the first
    ``cold`` of them occur at most ``WORD_BLOCK`` times.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts(folder)
        for batch in batches:
            for some in slices(batch, "text"):
                sets = LineSets(some, counts)
                kept = np.flatnonzero(sets.sizes)
                size = sets.sizes[sets.line]
                place = np.arange(len(sets.words)) - (sets.ends - sets.sizes)[sets.line]
                first = place < size - np.ceil(threshold * size - 1e-9) + 1
                shared = first & (sets.n > 1)

                def per_line(chosen: np.ndarray) -> np.ndarray:
                    return np.bincount(sets.line[chosen], minlength=len(sets.sizes))[kept]

                index, maps = pa.array(sets.text[kept]), sets.maps().view(np.int64)[kept]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id").take(index), some.column("text_hash").take(index), pa.array(sets.number[kept].astype(np.int32)), pa.array(sets.node[kept]),
                     pa.array(sets.sizes[kept].astype(np.int32)), pa.array(per_line(first & (sets.n <= 1)).astype(np.int32)), pa.array(per_line(shared & (sets.n <= WORD_BLOCK)).astype(np.int32)),
                     pa.array(maps[:, 0]), pa.array(maps[:, 1]), as_list(sets.words[shared].astype(np.uint32).view(np.int32), per_line(shared), pa.int32())],
                    ["doc_id", "text_hash", "line", "node", "size", "skip", "cold", "map0", "map1", "prefix"])

    return docs.mapInArrow(read, "doc_id long, text_hash long, line int, node long, size int, skip int, cold int, map0 long, map1 long, prefix array<int>")


def _wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at least ``SPAN_ROWS``, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= SPAN_ROWS:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def candidate_groups(nodes: DataFrame, threshold: float) -> DataFrame:
    """node, team and blocks: the lines that pairs passing the filters connect at one word are a team, named by its members.

    A team met at several words is one.  Only words that may have more than ``WORD_BLOCK`` lines are counted, to cut their
    lines into blocks, so a team has at most two blocks of lines.
    """
    rows = nodes.select("node", "size", "skip", "cold", "map0", "map1", F.posexplode("prefix").alias("at", "word"))
    rows = rows.select("word", "node", "size", (F.col("skip") + F.col("at")).alias("place"), "map0", "map1", (F.col("at") < F.col("cold")).alias("cold"))
    once = F.lit(0)
    cold = rows.where("cold").select("word", once.alias("i"), once.alias("j"), once.alias("block"), "size", "node", "place", "map0", "map1")
    warm = rows.where(~F.col("cold"))
    hot = settle_table(warm.groupBy("word").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > WORD_BLOCK), "hot-words")
    blocks = F.coalesce(F.ceil(F.col("members") / WORD_BLOCK), F.lit(1)).cast("int")
    warm = warm.join(hot, "word", "left").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("pair", F.explode(block_pairs(blocks, F.col("block"))))
    rows = cold.union(warm.select("word", "pair.i", "pair.j", "block", "size", "node", "place", "map0", "map1"))
    keys = ["word", "i", "j"]

    def span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _runs(_wide(batches), keys):
            group = _group_ids(batch, keys)
            node, size, place, block = (batch.column(c).to_numpy().astype(np.int64) for c in ("node", "size", "place", "block"))
            maps = np.stack([batch.column(c).to_numpy().view(np.uint64) for c in ("map0", "map1")], 1)
            across = batch.column("i").to_numpy() != batch.column("j").to_numpy()
            forest, ahead = Forest(len(node)), 1
            # of two lines, the shorter has a common word this early
            at = np.flatnonzero(size - place >= np.ceil(2 * threshold / (1 + threshold) * size - 1e-9))
            while len(at):
                at = at[at + ahead < len(node)]
                # rows of a group come by size: once the next is too long, so are all after it
                at = at[(group[at] == group[at + ahead]) & (size[at] >= threshold * size[at + ahead] - 1e-9)]
                to = at + ahead
                met = ~across[at] | (block[at] != block[to])
                need = np.ceil(threshold / (1 + threshold) * (size[at] + size[to]) - 1e-9)
                met &= np.minimum(size[at] - place[at], size[to] - place[to]) >= need
                met &= np.bitwise_count(maps[at] ^ maps[to]).sum(1) <= size[at] + size[to] - 2 * need
                if met.any():
                    roots = forest.roots()
                    met &= roots[at] != roots[to]
                    forest.join(at[met], to[met])
                ahead += 1
            roots = forest.roots()
            members = np.bincount(roots, minlength=len(node))
            team, total = np.zeros(len(node), np.uint64), np.bincount(roots, size, len(node))
            np.add.at(team, roots, mix(node.view(np.uint64)))
            blocks = np.ceil(np.maximum(members / GROUP_BLOCK, total / BLOCK_WORDS)).astype(np.int32)
            tied = members[roots] > 1
            own = roots[tied]
            yield pa.RecordBatch.from_arrays([pa.array(node[tied]), pa.array(mix(team[own]).view(np.int64)), pa.array(blocks[own])], ["node", "team", "blocks"])

    return rows.repartition(*keys).sortWithinPartitions(*keys, "size", "node").mapInArrow(span, "node long, team long, blocks int").distinct()


@lru_cache(1)
def _slots(folder: str) -> np.ndarray:
    held = np.zeros(SLOTS, bool)
    held[read_arrow(folder, ["slot"]).column("slot").to_numpy()] = True
    return held


def maybe_wanted(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``docs`` that may be among ``wanted`` (_doc, _text), and some others.

    Spares a shuffle the texts of most documents without candidates.  The set has at most ``SLOTS`` slots; a corpus of many
    more wanted documents fills it, and then all texts pass to the join that decides.
    """
    folder = new_folder(docs.sparkSession, "wanted")
    settle_at(wanted.select(F.pmod(F.xxhash64("_doc", "_text"), F.lit(SLOTS)).cast("int").alias("slot")).distinct(), folder)
    rows = docs.select("doc_id", "text_hash", "text", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SLOTS)).cast("int").alias("_slot"))

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _slots(folder)
        for batch in batches:
            yield batch.filter(pa.array(slots[batch.column("_slot").to_numpy()])).select(["doc_id", "text_hash", "text"])

    return rows.mapInArrow(passing, rows.drop("_slot").schema)


def _parts(batch: pa.RecordBatch, group: np.ndarray, sizes: np.ndarray) -> Iterator[slice]:
    """Rows of whole groups with about ``PART_WORDS`` words."""
    edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
    upto = np.concatenate([[0], np.cumsum(sizes)])[edges]
    low = 0
    while low < len(edges) - 1:
        high = max(low + 1, int(np.searchsorted(upto, upto[low] + PART_WORDS, "right")) - 1)
        yield slice(int(edges[low]), int(edges[high]))
        low = high


def common_words(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray, kinds: int) -> np.ndarray:
    """How many words the rows ``left`` and ``right`` share; ``words`` are sorted numbers below ``kinds`` in each row."""
    placed = np.repeat(np.arange(len(sizes)), sizes) * kinds + words
    common = np.zeros(len(left), np.int64)
    edges = np.cumsum(sizes[left]) // PART_WORDS
    for k in range(int(edges[-1]) + 1 if len(edges) else 0):
        own = np.flatnonzero(edges == k)
        n = sizes[left[own]]
        pair = np.repeat(np.arange(len(own)), n)
        at = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + starts[left[own]][pair]
        wanted = right[own][pair] * kinds + words[at]
        held = np.searchsorted(placed, wanted)
        common[own] = np.bincount(pair, placed[np.minimum(held, len(placed) - 1)] == wanted, len(own)).astype(np.int64)
    return common


def late_rows(group: np.ndarray, node: np.ndarray, turn: np.ndarray, apart: np.ndarray, flat: np.ndarray, sizes: np.ndarray, threshold: float) -> np.ndarray:
    """The nodes with a similar one of an earlier turn in one of their groups.

    Rows of a group come by size.  Rows a step apart are compared for growing steps: a wide map of the words decides first, then
    the words themselves.  A node that has its similar earlier one is not asked again, in any group.
    """
    kinds, words = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.cumsum(sizes) - sizes
    bit = mix(kinds.view(np.uint64))[words] >> _U(55)
    maps = np.zeros((len(sizes), 8), np.uint64)
    np.bitwise_or.at(maps, (row, (bit >> _U(6)).astype(np.int64)), _U(1) << (bit & _U(63)))
    words = words[np.lexsort((words, row))]
    names, own = np.unique(node, return_inverse=True)
    late = np.zeros(len(names), bool)
    at, ahead = np.arange(len(node)), 1
    while len(at):
        at = at[at + ahead < len(node)]
        at = at[(group[at] == group[at + ahead]) & (sizes[at] >= threshold * sizes[at + ahead] - 1e-9)]
        to = at + ahead
        later = np.where(turn[at] > turn[to], own[at], own[to])
        asked = ~late[later] & (apart[at] != apart[to]) & (node[at] != node[to])
        left, right, later = at[asked], to[asked], later[asked]
        most = sizes[left] + sizes[right] - 2 * np.ceil(threshold / (1 + threshold) * (sizes[left] + sizes[right]) - 1e-9)
        near = np.bitwise_count(maps[left] ^ maps[right]).sum(1) <= most
        left, right, later = left[near], right[near], later[near]
        if len(left):
            common = common_words(words, starts, sizes, left, right, len(kinds))
            similar = common >= threshold * (sizes[left] + sizes[right] - common) - 1e-9
            late[later[similar]] = True
        ahead += 1
    return names[late]


def later_nodes(docs: DataFrame, nodes: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """The nodes of candidate groups (node, team, blocks) of which an earlier one is similar."""
    wanted = nodes.join(groups, "node").groupBy("first.doc_id", "first.text_hash").agg(F.collect_list(F.struct(  # the lines of one document
        F.col("first.line").alias("line"), "node", "team", "blocks")).alias("wanted")).withColumnsRenamed({"doc_id": "_doc", "text_hash": "_text"})
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_text"))
    wanted = settle_table(wanted, "wanted-lines")
    texts = maybe_wanted(docs, wanted).join(wanted, same).select("doc_id", "text_hash", "text", "wanted")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(BUCKETS, np.uint8)
        for batch in batches:
            for some in slices(batch, "text"):
                sets = LineSets(some, none)
                first = np.cumsum(sets.per_text) - sets.per_text
                held = some.column("wanted")
                text = np.repeat(np.arange(some.num_rows), held.value_lengths().to_numpy())
                line, node, team, blocks = (held.flatten().field(c).to_numpy() for c in ("line", "node", "team", "blocks"))
                at = first[text] + line
                edges = [0, *(np.flatnonzero(np.cumsum(sets.sizes[at])[1:] // PART_WORDS != np.cumsum(sets.sizes[at])[:-1] // PART_WORDS) + 1), len(at)]
                for low, high in zip(edges, edges[1:], strict=False):
                    chosen = [sets.words[sets.ends[k] - sets.sizes[k] : sets.ends[k]] for k in at[low:high]]
                    flat = np.concatenate(chosen) if chosen else np.empty(0, np.uint64)
                    index, part = pa.array(text[low:high]), slice(low, high)
                    yield pa.RecordBatch.from_arrays(
                        [some.column("doc_id").take(index), some.column("text_hash").take(index), pa.array(line[part]), pa.array(node[part]), pa.array(team[part]), pa.array(blocks[part]),
                         as_list(flat.view(np.int64), sets.sizes[at[part]], pa.int64())], ["doc_id", "text_hash", "line", "node", "team", "blocks", "words"])

    rows = texts.mapInArrow(gather, "doc_id long, text_hash long, line int, node long, team long, blocks int, words array<long>")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("pair", F.explode(block_pairs(F.col("blocks"), F.col("block"))))
    rows = rows.select("team", "pair.i", "pair.j", "block", F.size("words").alias("size"), "node", "doc_id", "text_hash", "line", "words")
    keys = ["team", "i", "j"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _runs(batches, keys):
            group = _group_ids(batch, keys)
            node, block, text, line, size = (batch.column(c).to_numpy() for c in ("node", "block", "text_hash", "line", "size"))
            ids = batch.column("doc_id")
            turn = np.empty(len(node), np.int64)
            turn[np.lexsort((line, text, ids.fill_null(0).to_numpy(), ~np.asarray(ids.is_null())))] = np.arange(len(node))
            # in a pair of blocks, rows of one block are not compared; within a block all rows are
            apart = np.where(batch.column("i").to_numpy() != batch.column("j").to_numpy(), block, np.arange(len(node)) + (1 << 32))
            for part in _parts(batch, group, size):
                flat = batch.column("words").slice(part.start, part.stop - part.start).flatten().to_numpy()
                late = late_rows(group[part], node[part], turn[part], apart[part], flat, size[part].astype(np.int64), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(late)], ["node"])

    return rows.repartition(*keys).sortWithinPartitions(*keys, "size", "node").mapInArrow(verify, "node long").distinct()


def repeated_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, lines and removed (sorted line numbers, from 0) of every document.

    Lines are what line breaks part, words what ASCII white space parts, A-Z in lower case.  A line goes if its words
    have a Jaccard similarity of at least ``threshold`` with those of any earlier line, be that kept or not; lines without
    a word stay.  Earlier is by id (null first), text hash and line number.  Rows that repeat id and text are one
    document and give one row; a null text has no lines, an empty one has one; an empty table gives no rows.
    """
    named = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"), F.col("text").isNull().alias("_none"))
    folder = new_folder(docs.sparkSession, "words")
    count_buckets(named, folder)
    place = ["doc_id", "text_hash", "line"]
    found = settle_table(line_rows(named.drop("_none"), folder, threshold), "lines")
    least = found.groupBy("node").agg(F.min(F.struct(*place, "size", "skip", "cold", "map0", "map1", "prefix")).alias("least"))
    nodes = settle_table(least.select("node", F.struct(*(f"least.{c}" for c in place)).alias("first"), *(f"least.{c}" for c in ("size", "skip", "cold", "map0", "map1", "prefix"))), "line-nodes")
    groups = settle_table(candidate_groups(nodes, threshold), "teams")
    late = later_nodes(named.drop("_none"), nodes.select("node", "first"), groups, threshold)
    firsts = nodes.join(late.withColumn("late", F.lit(True)), "node", "left").select("node", "first", F.coalesce("late", F.lit(False)).alias("late"))
    here = F.struct(*place)
    gone = found.join(firsts, "node").where(F.col("late") | ~here.eqNullSafe(F.col("first"))).select("doc_id", "text_hash", "line")
    per_doc = gone.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("line")).alias("removed")).withColumnsRenamed({"doc_id": "_doc", "text_hash": "_text"})
    lines = F.when(F.col("_none"), 0).otherwise(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
    every = named.select("doc_id", "text_hash", lines.alias("lines")).dropDuplicates(["doc_id", "text_hash"])
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_text"))
    return every.join(per_doc, same, "left").select("doc_id", "text_hash", "lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def without_repeated_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the lines that go taken out of ``text``."""
    found = repeated_lines(docs, threshold).select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_text"), F.col("removed").alias("_removed"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_text"))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains("_removed", i)), "\n")
    rows, back = aside(docs, "doc_id", "text")
    return back(rows.join(found, same).withColumn("text", kept))
