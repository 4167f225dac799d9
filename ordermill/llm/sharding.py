"""Shards along a Hilbert curve over several metadata dimensions (operator 8)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.names import aside, free_name
from ordermill.llm.positions import running_sums
from ordermill.llm.storage import settle_table

BITS = 6  # each dimension has at most 2**BITS steps
ROW_BYTES = 16


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``points`` (integers below ``2**bits``, at most 63 bits in all).

    From the highest bit down, each coordinate's reflections and swaps are undone for all rows at once; the Gray code
    of the resulting bits is the index.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(n):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    parity = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        parity ^= np.where(x[n - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= parity
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | ((x[i] >> level) & 1)
    return index


def step_edges(rows: DataFrame, dimensions: list[str], bits: int = BITS) -> list[list]:
    """At most ``2**bits - 1`` values of each dimension, as many rows between each two as whole values allow.

    They are the exact quantiles of all rows with a value: each distinct value is counted, running sums of the counts
    give the places at which it stands in order, and the driver gets the values at the steps' places alone.
    """
    steps = 1 << bits
    edges = []
    for name in dimensions:
        counts = rows.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        placed = running_sums(counts, ["value"], "n")
        total = placed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        first = F.greatest(F.expr(f"(before * {steps} + {max(total, 1) - 1}) DIV {max(total, 1)}"), F.lit(1))  # the first step at or after the value's first place
        at_step = (first < steps) & (F.expr(f"{total}L") * first < (F.col("before") + F.col("n")) * steps)
        edges.append(sorted(r[0] for r in placed.where(at_step).select("value").collect()))
    return edges


def curve_index(rows: DataFrame, dimensions: list[str], edges: list[list], bits: int = BITS) -> DataFrame:
    """``rows`` with ``curve``; a null counts as the lowest step of its dimension."""
    schema = rows.selectExpr("*", "0L AS curve").schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = []
            for name, known in zip(dimensions, edges, strict=True):
                column = batch.column(name)
                filled = np.array(column.fill_null(known[0] if known else column[0]).to_numpy(zero_copy_only=False)) if column.null_count < len(column) and known else None
                step = np.searchsorted(np.array(known, filled.dtype), filled, side="right") if filled is not None else np.zeros(len(column), np.int64)
                step = np.where(np.asarray(column.is_null()), 0, step)
                steps.append(step)
            curve = hilbert_index(np.stack(steps, 1), bits) if batch.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(curve, pa.int64())], [*batch.schema.names, "curve"])

    return rows.mapInArrow(place, schema)


def shard_rows(docs: DataFrame, shards: int) -> DataFrame:
    """Each document's place: doc_id, size, text_crc32, curve, shard and slot.

    The dimensions are source, language, size and id.  Documents follow the curve (then doc_id and text), and runs of
    equally many are cut from it: the counts of two shards differ by at most one, and a shard covers a compact region
    of all dimensions, so that minima and maxima of its file prune it.  ``slot`` is gapless from 0 in each shard.  A null
    text has size 16 and the crc32 of no bytes; null dimensions count as lowest; repeated rows get slots of their own;
    an empty table gives no rows.
    """
    known = docs.select("doc_id", *[c for c in ("lang", "source") if c in docs.columns], "text")
    for c in ("lang", "source"):
        if c not in known.columns:
            known = known.withColumn(c, F.lit(None).cast("string"))
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = settle_table(known.select(
        "doc_id", "lang", "source", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
    ), "shard-sizes")
    dimensions = ["source", "lang", "size", "doc_id"]
    on_curve = curve_index(narrow, dimensions, step_edges(narrow, dimensions)).select("doc_id", "size", "text_crc32", "curve", F.lit(1).cast("long").alias("one"))
    placed = running_sums(on_curve, ["curve", "doc_id", "text_crc32", "size"], "one")
    total = max(narrow.count(), 1)
    shard = F.expr(f"CAST((before * {shards}) DIV {total} AS INT)")
    first = F.expr(f"(shard * {total}L + {shards - 1}) DIV {shards}")  # the first place of the shard
    return (
        placed.withColumn("shard", shard).withColumn("slot", F.col("before") - first)
        .select("doc_id", "size", "text_crc32", "curve", "shard", "slot")
    )


def write_shards(docs: DataFrame, shards: int, folder: str) -> None:
    """The documents themselves as one sorted Parquet folder for each shard.

    Rows meet their place by id, size and checksum of the text; rows equal in these three are interchangeable.  The
    folders are named by ``_shard``, with underscores added while ``docs`` has a column of that name.
    """
    rows, back = aside(docs, "doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    named = rows.withColumns({"_size": (F.octet_length(text) + ROW_BYTES).cast("long"), "_crc": F.crc32(text)})
    keys = ["doc_id", "_size", "_crc"]
    number = F.row_number().over(_copies(keys))
    places = shard_rows(docs, shards).withColumnsRenamed({"size": "_size", "text_crc32": "_crc", "doc_id": "_id"})
    places = places.select(F.col("_id"), "_size", "_crc", F.col("shard").alias("_shard"), F.col("slot").alias("_slot")).withColumn("_copy", F.row_number().over(_copies(["_id", "_size", "_crc"])))
    left, right = named.withColumn("_copy", number).alias("l"), places.alias("r")
    same = F.expr("l.doc_id <=> r._id AND l._size = r._size AND l._crc = r._crc AND l._copy = r._copy")
    joined = left.join(right, same).select(*[F.col(f"l.{c}") for c in rows.columns], "r._shard", "r._slot")
    placed = joined.repartitionByRange("_shard").sortWithinPartitions("_shard", "_slot")
    shard = free_name("_shard", docs.columns)
    back(placed, F.col("_shard").alias(shard)).write.partitionBy(shard).parquet(folder)


def _copies(keys: list[str]):
    return Window.partitionBy(*keys).orderBy(*keys)
