"""N-gram Jaccard join with Bayesian candidate pruning (operator 3).

Texts whose words are equal form one node.  A node's MinHash values (16 bits each) are read in bands of four; nodes that
agree in a band meet in a bucket.  There, pairs are compared 16 values at a time, and a pair is dropped as soon as the
posterior probability of a similarity of at least the threshold (uniform prior) falls below ``TOLERANCE``.  The pairs that
remain span candidate groups, whose members are then compared exactly, by their shingle sets.

No step emits the pairs of a group.  A bucket gives each member's root, a candidate group each member's number of
links and root.  Buckets and groups beyond a task's share are cut into blocks, and a task compares two blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.columns import as_list, hashed_words, mix, powers, shingles, slices
from ordermill.llm.components import Forest, connected_components
from ordermill.llm.names import aside
from ordermill.llm.storage import settle_table

THRESHOLD = 0.8
BANDS = 20
ROWS = 4
HASHES = BANDS * ROWS
STEP = 16  # MinHash values compared at a time
TOLERANCE = 1e-6
BUCKET_BLOCK = 1024  # members of a bucket in a block
GROUP_BLOCK = 512  # members of a candidate group in a block
BLOCK_SHINGLES = 1 << 21  # shingles of the members in a block, about

_U = np.uint64
_RNG = np.random.default_rng(20240303)
_FLIP = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_ODD = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) | _U(1)


def least_matches(threshold: float, tolerance: float = TOLERANCE) -> list[int]:
    """For each number n of compared values, the fewest matches that leave a chance of ``tolerance``.

    With a uniform prior the similarity after m matches is Beta(m + 1, n - m + 1), and the chance that it reaches the
    threshold is that of at most m successes in n + 1 trials.
    """
    least = []
    for n in range(HASHES + 1):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        least.append(m)
    return least


def may_be_similar(one: np.ndarray, other: np.ndarray, least: list[int]) -> np.ndarray:
    """Which pairs of rows of MinHash values pass every comparison."""
    left, matches = np.arange(len(one)), np.zeros(len(one), np.int64)
    for at in range(0, HASHES, STEP):
        matches += (one[left, at : at + STEP] == other[left, at : at + STEP]).sum(1)
        passed = matches >= least[min(at + STEP, HASHES)]
        left, matches = left[passed], matches[passed]
    answer = np.zeros(len(one), bool)
    answer[left] = True
    return answer


def text_nodes(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One number for each sequence of words; 0 for none."""
    up, down = powers(len(hashes))
    ends = np.cumsum(counts)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up)])
    if not len(hashes):
        return np.zeros(len(counts), np.int64)
    first = np.minimum(ends - counts, len(hashes) - 1)
    value = mix((sums[ends] - sums[ends - counts]) * down[first] + counts.astype(np.uint64))
    return np.where(counts > 0, value, _U(0)).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, node, words and sig (``BANDS`` longs of four MinHash values; null without words) of each text."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                hashes, counts = hashed_words(some.column("text"))
                made, per_text = shingles(hashes, counts)
                filled = np.flatnonzero(per_text)
                starts = (np.cumsum(per_text) - per_text)[filled]
                sig = np.zeros((some.num_rows, HASHES), np.uint16)
                held = np.empty_like(made)
                for j in range(HASHES if len(filled) else 0):
                    np.bitwise_xor(made, _FLIP[j], out=held)
                    np.multiply(held, _ODD[j], out=held)
                    sig[filled, j] = (mix(np.minimum.reduceat(held, starts)) >> _U(48)).astype(np.uint16)
                bands = as_list(sig.view(np.int64).reshape(-1), np.full(some.num_rows, BANDS), pa.int64())
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(text_nodes(hashes, counts)), pa.array(per_text.astype(np.int64)), bands],
                                                 ["doc_id", "node", "size", "sig"])

    return docs.select("doc_id", "text").mapInArrow(sign, "doc_id long, node long, size long, sig array<long>")


def block_pairs(blocks: Column, block: Column) -> Column:
    """The pairs of blocks (i, j), i <= j, in which ``block`` takes part."""
    return F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.struct(F.least(block, other).alias("i"), F.greatest(block, other).alias("j")))


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of whole groups, for rows sorted by ``keys``."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        if rest:
            last = [rest[-1].column(k)[-1].as_py() for k in keys]
            inside = np.logical_and.reduce([c == v for c, v in zip(columns, last, strict=True)])
            head = len(inside) if inside.all() else int(np.argmin(inside))
        else:
            head = 0
        if head == batch.num_rows:
            rest.append(batch)
            continue
        new = np.logical_or.reduce([c[1:] != c[:-1] for c in columns]) if batch.num_rows > 1 else np.empty(0, bool)
        tail = int(np.flatnonzero(new)[-1]) + 1 if new.any() else 0
        tail = max(tail, head)
        whole = [*rest, batch.slice(0, tail)]
        if sum(b.num_rows for b in whole):
            yield pa.Table.from_batches(whole).combine_chunks().to_batches()[0]
        rest = [batch.slice(tail)]
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]


def _group_ids(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
    new = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.concatenate([[0], np.cumsum(new)])


def candidate_edges(nodes: DataFrame, threshold: float) -> DataFrame:
    """src and dst of stars that span, in every bucket, the nodes whose pairs pass the Bayesian test."""
    least = least_matches(threshold)
    rows = nodes.select("node", F.posexplode("sig").alias("band", "value"))
    shared = rows.groupBy("band", "value").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = rows.join(shared, ["band", "value"]).join(nodes.select("node", "sig"), "node")
    blocks = F.ceil(F.col("members") / BUCKET_BLOCK).cast("int")
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("pair", F.explode(block_pairs(blocks, F.col("block"))))
    keys = ["band", "value", "i", "j"]
    members = members.select("band", "value", "pair.i", "pair.j", "block", "node", "sig")

    def span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _runs(batches, keys):
            group = _group_ids(batch, keys)
            sig = batch.column("sig").flatten().to_numpy().reshape(-1, BANDS).view(np.uint16)
            node, block = batch.column("node").to_numpy(), batch.column("block").to_numpy()
            across = batch.column("i").to_numpy() != batch.column("j").to_numpy()
            forest, ahead, at = Forest(len(node)), 1, np.arange(len(node) - 1)
            while len(at):
                at = at[at + ahead < len(node)]
                at = at[group[at] == group[at + ahead]]
                met = at[~across[at] | (block[at] != block[at + ahead])]
                roots = forest.roots()
                met = met[roots[met] != roots[met + ahead]]
                if len(met):
                    good = met[may_be_similar(sig[met], sig[met + ahead], least)]
                    forest.join(good, good + ahead)
                ahead += 1
            roots = forest.roots()
            tied = roots != np.arange(len(roots))
            yield pa.RecordBatch.from_arrays([pa.array(node[tied]), pa.array(node[roots[tied]])], ["src", "dst"])

    return members.repartition(*keys).sortWithinPartitions(*keys, "block", "node").mapInArrow(span, "src long, dst long").distinct()


def shingle_sets(rows: DataFrame) -> DataFrame:
    """Rows whose text is that of ``node``, with the sorted set of shingles in place of the text."""
    kept = [c for c in rows.columns if c != "text"]
    schema = rows.drop("text").selectExpr("*", "array(0L) AS shingles").schema

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                hashes, counts = hashed_words(some.column("text"))
                same = text_nodes(hashes, counts) == some.column("node").to_numpy()
                made, per_text = shingles(hashes, counts)
                sets = [np.unique(x) if ok else x[:0] for x, ok in zip(np.split(made, np.cumsum(per_text)[:-1]), same, strict=True)]
                held = as_list(np.concatenate(sets).view(np.int64), np.array([len(s) for s in sets]), pa.int64())
                yield pa.RecordBatch.from_arrays([*[some.column(c) for c in kept], held], [*kept, "shingles"]).filter(pa.array(same))

    return rows.mapInArrow(gather, schema)


def similar_pairs(sets: list[np.ndarray], first: int, threshold: float) -> np.ndarray:
    """Matrix of which of the first ``first`` sets are similar to which of the rest (to each other if that is all)."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    kinds, index, seen = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.cumsum(seen > 1) - 1
    kept = seen[index] > 1
    owner, index = owner[kept], shared[index[kept]]
    order = np.argsort(index, kind="stable")
    owner, index = owner[order], index[order]
    left = slice(0, first)
    right = slice(first, len(sets)) if first < len(sets) else left
    common = np.zeros((first, len(sets) - first if first < len(sets) else first), np.float32)
    width = 4096
    for low in range(0, int(shared[-1]) + 1 if len(shared) else 0, width):
        a, b = np.searchsorted(index, [low, low + width])
        held = np.zeros((len(sets), width), np.float32)
        held[owner[a:b], index[a:b] - low] = 1
        common += held[left] @ held[right].T
    either = sizes[left][:, None] + sizes[right][None, :] - common
    found = common >= threshold * either - 1e-6
    if first == len(sets):
        np.fill_diagonal(found, False)
    return found


KEY = ["_known", "_id", "_words"]  # whether there is an id, the id, the words


def with_key(rows: DataFrame, node: str) -> DataFrame:
    return rows.withColumns({"_known": F.col("doc_id").isNotNull(), "_id": F.coalesce("doc_id", F.lit(0)), "_words": F.col(node)})


def one_text_each(docs: DataFrame) -> DataFrame:
    """``KEY`` and text, one row for each id and words: rows that repeat both, and those without an id, shrink before the shuffle."""
    return with_key(with_nodes(docs.select("doc_id", "text")), "_node").groupBy(*KEY).agg(F.any_value("text").alias("text"))


def exact_links(docs: DataFrame, nodes: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """For the nodes of each candidate group: node, root, links (documents of other nodes that are similar), blocks."""
    sized = nodes.select("node", "doc_id", "copies", "size").join(groups, "node")
    totals = sized.groupBy("component").agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_size"))
    blocks = F.greatest(F.ceil(F.col("_n") / GROUP_BLOCK), F.ceil(F.col("_size") / BLOCK_SHINGLES)).cast("int")
    sized = sized.join(totals, "component").select("component", "node", "doc_id", "copies", blocks.alias("blocks")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    texts = one_text_each(docs).join(with_key(sized, "node").drop("doc_id"), KEY).drop(*KEY)
    keys = ["component", "i", "j"]
    rows = shingle_sets(texts).withColumn("pair", F.explode(block_pairs(F.col("blocks"), F.col("block"))))
    rows = rows.select("component", "pair.i", "pair.j", "block", "blocks", "node", "copies", "shingles")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _runs(batches, keys):
            group = _group_ids(batch, keys)
            node, copies = batch.column("node").to_numpy(), batch.column("copies").to_numpy()
            block, blocks = batch.column("block").to_numpy(), batch.column("blocks").to_numpy()
            across = batch.column("i").to_numpy() != batch.column("j").to_numpy()
            held = batch.column("shingles")
            flat, ends = held.flatten().to_numpy(), np.cumsum(held.value_lengths().to_numpy())
            out = []
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1), len(group)]
            for low, high in zip(edges, edges[1:], strict=False):
                own = np.arange(low, high)
                own = own[np.concatenate([[True], node[own][1:] != node[own][:-1]])]  # a repeated row is one
                sets = [flat[(ends[k - 1] if k else 0):ends[k]] for k in own]
                first = int((block[own] == block[own[0]]).sum()) if across[low] else len(own)
                if across[low] and first == len(own):
                    continue
                found = similar_pairs(sets, first, threshold)
                a, b = np.nonzero(found)
                rows_, columns = own[:first], own[first:] if across[low] else own
                links = np.zeros(len(own), np.int64)
                links[:first] = found @ copies[columns]
                if across[low]:
                    links[first:] = copies[rows_] @ found
                forest = Forest(len(own))
                forest.join(a, b + first if across[low] else b)
                roots = forest.roots()
                out.append((node[own], node[own[roots]], links, blocks[own]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["node", "root", "links", "blocks"])

    found = rows.repartition(*keys).sortWithinPartitions(*keys, "block", "node").mapInArrow(verify, "node long, root long, links long, blocks int")
    return settle_table(found, "links")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_links, copies and node of every document.

    Two texts are linked if the Jaccard similarity of their sets of five-word shingles is at least ``threshold``; texts of
    equal words always are.  A class is what links connect, named by its least doc_id; ``n_links`` counts the documents
    linked to this one, ``copies`` those of equal words, itself included.  A text of one to four words has one shingle;
    null texts and texts without a word have no link and are classes of their own.  Rows without an id count, but
    name a class only by null.  Repeated rows are documents of their own; an empty table gives no rows.
    """
    return _classed(docs, threshold).drop("kept")


def _classed(docs: DataFrame, threshold: float) -> DataFrame:
    """``near_duplicates`` with ``kept``, the node that stands for the class: of those with its least doc_id the least."""
    signed = settle_table(signatures(docs), "signatures")
    with_words = signed.where("size > 0")
    nodes = settle_table(with_words.groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("sig").alias("sig")), "nodes")
    edges = settle_table(candidate_edges(nodes, threshold), "stars")
    groups = connected_components(edges)
    found = exact_links(docs, nodes, groups, threshold)
    summed = found.groupBy("node").agg(F.sum("links").alias("links"), F.min("root").alias("root"), F.max("blocks").alias("blocks"))
    cut = found.where("blocks > 1").select(F.col("node").alias("src"), F.col("root").alias("dst")).where("src <> dst")
    joined = connected_components(cut).withColumnRenamed("component", "_far")
    summed = summed.join(joined, "node", "left").select("node", "links", F.when(F.col("blocks") > 1, F.coalesce("_far", "node")).otherwise(F.col("root")).alias("root"))
    known = nodes.select("node", "doc_id", "copies").join(summed, "node", "left").select(
        "node", "doc_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    known = settle_table(known, "roots")
    classes = known.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node"))["node"].alias("kept"))
    known = known.join(classes, "root").select("node", "class_id", "copies", (F.col("links") + F.col("copies") - 1).alias("n_links"), "kept")
    ours = signed.select("doc_id", "node", "size")
    linked = ours.where("size > 0").join(known, "node").select("doc_id", "class_id", "n_links", "copies", "node", "kept")
    alone = ours.where("size = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("copies"), "node", F.col("node").alias("kept"))
    return linked.union(alone)


def with_nodes(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_node``, the number of the text's words in order."""
    schema = docs.selectExpr("*", "0L AS _node").schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(text_nodes(*hashed_words(some.column("text"))))], [*some.schema.names, "_node"])

    return docs.mapInArrow(add, schema)


def one_of_each_class(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with just one document of each class: one that names it.

    Of different texts with that id, and of a class without any id, the one of the least node stays; of rows that repeat
    id and words one.  Texts without a word all stay.
    """
    found = _classed(docs, threshold).where("node <> 0 AND node = kept AND doc_id <=> class_id").select(F.col("doc_id").alias("_doc"), F.col("node").alias("_kept")).distinct()
    rows, back = aside(docs, "doc_id", "text")
    named = with_nodes(rows)
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_node") == F.col("_kept"))
    number = F.row_number().over(Window.partitionBy("doc_id", "_node").orderBy("_node"))
    first = named.where("_node <> 0").join(found, same).withColumn("_number", number).where("_number = 1")
    return back(first).union(back(named.where("_node = 0")))
