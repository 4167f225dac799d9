"""Joins of many rows with keyed tables, safe against keys that hold a large share of the rows.

A join is left to Spark: tables small by their bytes are broadcast, others joined by key, and adaptive execution splits
partitions that a hot key makes large.  No job runs while a query is built.  Who knows that adaptive execution is off, or
that a hot key is worth a look at the data, asks for it by ``small_rows`` or ``hot_rows``: then a table of few rows is
broadcast after it was counted, and rows of hot keys are cut into slices.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL_ROWS = 100_000
PIECES = 1000
HOT_ROWS = 1_000_000
TRACKED = 20  # keys tracked per piece; more make the frequency sketch sharper

Hot = list[tuple[object, int]]


def is_small(table: DataFrame, max_rows: int = SMALL_ROWS) -> bool:
    """Whether ``table`` has at most ``max_rows`` rows; reads no more than one row beyond that."""
    return table.select(F.lit(1)).offset(max_rows).isEmpty()


def hot_keys(rows: DataFrame, keys: list[str], pieces: int = PIECES, min_rows: int = HOT_ROWS) -> dict[str, Hot]:
    """Values of each key that hold more than one ``pieces``-th of the rows, and how many slices each needs.

    One pass over the key columns with a frequent-items sketch: nothing is shuffled but the sketches.
    It cannot miss a value that frequent, and its counts, a little off, only decide how thinly rows are
    spread.  Per key at most ``pieces`` values pass, with at most twice as many slices in all.
    """
    top = [F.expr(f"approx_top_k(`{key}`, {pieces}, {pieces * TRACKED})").alias(f"_{i}") for i, key in enumerate(keys)]
    seen = rows.select(*keys).agg(F.count(F.lit(1)).alias("_total"), *top).first()
    threshold = max(min_rows, seen["_total"] / pieces)
    return {
        key: [(e["item"], math.ceil(e["count"] * pieces / seen["_total"])) for e in seen[f"_{i}"] if e["count"] > threshold]
        for i, key in enumerate(keys)
    }


def join_each(
    rows: DataFrame,
    tables: dict[str, DataFrame],
    how: str = "inner",
    spread_by: list[str] | None = None,
    small_rows: int | None = None,
    pieces: int = PIECES,
    hot_rows: int | None = None,
) -> DataFrame:
    """``rows`` joined with several tables, key column -> table with one row per key.

    ``spread_by`` names columns that tell rows of one key apart (an id); rows of a hot key are sliced by
    them.  Without it all columns are used, and then all of them have to be read.
    The key columns of ``rows`` are read once more, for all large tables together; ``settle`` costly
    rows first.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"rows keep their side in an inner or left join, not in a {how} join")
    if small_rows is None and hot_rows is None:
        for key, table in tables.items():
            rows = rows.join(table, key, how)
        return rows
    small_rows, hot_rows = SMALL_ROWS if small_rows is None else small_rows, HOT_ROWS if hot_rows is None else hot_rows
    large = [key for key, table in tables.items() if not is_small(table, small_rows)]
    hot = hot_keys(rows, large, pieces, hot_rows) if large else {}
    joined = rows
    for key, table in tables.items():
        if key not in hot:
            joined = joined.join(F.broadcast(table), key, how)
            continue
        if how == "inner":
            joined = joined.where(F.col(key).isNotNull())
        joined = _sliced_join(joined, table, key, how, hot[key], pieces, spread_by or rows.columns) if hot[key] else joined.join(table, key, how)
    return joined


def join_keyed(rows: DataFrame, table: DataFrame, key: str, how: str = "inner", spread_by: list[str] | None = None, **sizes: int) -> DataFrame:
    """``rows`` joined with one table."""
    return join_each(rows, {key: table}, how, spread_by, **sizes)


def _sliced_join(
    rows: DataFrame, table: DataFrame, key: str, how: str, hot: Hot, pieces: int, spread_by: list[str]
) -> DataFrame:
    """Rows of hot keys go to slices by a hash of ``spread_by``; the one table row of such a key is copied to each.

    A hash of the content, unlike a random number, gives the same slice when a lost task runs again.
    Rows without a key match nothing, so they are spread as well.
    """
    fields = T.StructType([T.StructField(key, rows.schema[key].dataType), T.StructField("_slices", T.IntegerType())])
    slices = F.broadcast(rows.sparkSession.createDataFrame(hot, fields))  # at most ``pieces`` rows
    row_hash = F.xxhash64(*[F.col(c) for c in spread_by])
    sliced = (
        rows.join(slices, key, "left")
        .withColumn("_slices", F.when(F.col(key).isNull(), pieces).otherwise(F.coalesce("_slices", F.lit(1))))
        .withColumn("_slice", F.coalesce(F.pmod(row_hash, F.col("_slices")).cast("int"), F.lit(0)))
        .drop("_slices")
    )
    copies = (
        table.join(slices, key, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)))
        .drop("_slices")
    )
    return sliced.join(copies, [key, "_slice"], how).drop("_slice")
