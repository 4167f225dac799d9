"""Exact histogram of encoded lengths with suffix sums (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.storage import settle_table
from ordermill.llm.tokens import encoded

BLOCK = 1024


def encoded_lengths(docs: DataFrame, tokenizer: str, by: list[str]) -> DataFrame:
    """Columns ``by`` and ``length``, the number of ids of the whole text (null and empty: 0), one row per document."""
    rows = docs.select(*by, "text")
    schema = rows.drop("text").selectExpr("*", "0L AS length").schema

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in encoded(batches, "text", tokenizer):
            kept = [batch.column(c) for c in by]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([len(x) // 4 for x in found], pa.int64())], [*by, "length"])

    return rows.mapInArrow(measure, schema)


def length_histogram(docs: DataFrame, tokenizer: str, by: list[str]) -> DataFrame:
    """Documents of each encoded length, for each group of ``by`` (null is a group).

    With suffix sums: for a context limit equal to ``length``, ``docs_at_least`` documents of ``tokens_at_least``
    tokens reach it, and the group cut off at the limit keeps ``truncated_tokens``.  Only (group, length) pairs are
    shuffled.  The sums run in blocks of lengths, so that the window of a hot group holds one block.  An empty table
    gives an empty histogram.
    """
    counted = encoded_lengths(docs, tokenizer, by).groupBy(*by, "length").agg(F.count(F.lit(1)).alias("docs"))
    return with_suffix_sums(settle_table(counted, "lengths"), by)


def with_suffix_sums(counted: DataFrame, by: list[str]) -> DataFrame:
    rows = counted.withColumn("tokens", F.col("docs") * F.col("length")).withColumn("_block", F.floor(F.col("length") / BLOCK))
    blocks = rows.groupBy(*by, "_block").agg(F.sum("docs").alias("_docs"), F.sum("tokens").alias("_tokens"))
    down = Window.partitionBy(*by).orderBy(F.desc("_block"))
    above = down.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    blocks = blocks.select(
        *[F.col(c).alias(f"_{c}") for c in by], F.col("_block").alias("_at"),
        F.coalesce(F.sum("_docs").over(above), F.lit(0)).alias("_docs"),
        F.coalesce(F.sum("_tokens").over(above), F.lit(0)).alias("_tokens"),
        F.sum("_docs").over(whole).alias("group_docs"), F.sum("_tokens").over(whole).alias("group_tokens"),
    )
    same = F.col("_block") == F.col("_at")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    within = Window.partitionBy(*by, "_block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    summed = (
        rows.withColumn("_d", F.sum("docs").over(within)).withColumn("_t", F.sum("tokens").over(within)).join(blocks, same)
        .withColumn("docs_at_least", F.col("_d") + F.col("_docs")).withColumn("tokens_at_least", F.col("_t") + F.col("_tokens"))
    )
    kept = F.col("group_tokens") - F.col("tokens_at_least") + F.col("docs_at_least") * F.col("length")
    return summed.select(*by, "length", "docs", "tokens", "docs_at_least", "tokens_at_least", kept.alias("truncated_tokens"), "group_docs", "group_tokens")


def length_quantiles(histogram: DataFrame, by: list[str], shares: list[float]) -> DataFrame:
    """The smallest length that at least a share of the group's documents do not exceed, one row for each share."""
    reached = F.col("group_docs") - F.col("docs_at_least") + F.col("docs")
    columns = [F.min(F.when(reached >= F.ceil(F.lit(q) * F.col("group_docs")), F.col("length"))).alias(f"q{i}") for i, q in enumerate(shares)]
    found = histogram.groupBy(*by).agg(*columns)
    pairs = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("share"), F.col(f"q{i}").alias("length")) for i, q in enumerate(shares)]))
    return found.select(*by, pairs.alias("_q")).select(*by, "_q.share", "_q.length")


def truncated_total(histogram: DataFrame, by: list[str], limit: int) -> DataFrame:
    """Tokens left of each group when every document is cut at ``limit``, which need not be a length that occurs."""
    past, long = F.col("length") > limit, F.col("length") <= limit
    kept = F.sum(F.when(long, F.col("tokens")).otherwise(F.col("docs") * limit))
    return histogram.groupBy(*by).agg(kept.alias("tokens"), F.sum(F.when(past, F.col("docs")).otherwise(0)).alias("docs_cut"))
