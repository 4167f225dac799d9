"""Positions and running sums in a global order, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.storage import settle_table


def running_sums(rows: DataFrame, order: list, value: str, group: str | None = None) -> DataFrame:
    """``rows`` with ``before``, the sum of ``value`` (long) over all rows that come earlier, of the same group if given.

    ``order`` starts with the group and ends with columns that tell rows apart.  Rows are range-partitioned and
    sorted, each partition adds up its own, and the totals of the partitions (one row each, or one for each group
    in it) give the offsets.  Rows should be narrow: they are written once.  Ties and repeated rows get different
    places in any one order.  An empty table gives an empty table.
    """
    named = rows.withColumn("_group", F.xxhash64(group) if group else F.lit(0).cast("long"))
    schema = named.selectExpr("*", "0L AS before", "0 AS _part").schema

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, so_far = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            groups = batch.column("_group").to_numpy(zero_copy_only=False)
            new = np.flatnonzero(np.concatenate([[groups[0] != last], groups[1:] != groups[:-1]]))
            sums = np.cumsum(values) - values
            base = np.zeros(len(values), np.int64)
            edges = np.concatenate([new, [len(values)]])
            base[: edges[0]] = so_far
            for low, high in zip(edges, edges[1:], strict=False):
                base[low:high] = -sums[low]
            before = sums + base
            last, so_far = groups[-1], int(before[-1] + values[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(before), pa.array(np.full(len(values), part, np.int32))], [*batch.schema.names, "before", "_part"]
            )

    placed = settle_table(named.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(add_up, schema), "places")
    totals = placed.groupBy("_part", "_group").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle_table(totals.select("_part", "_group", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")), "offsets")
    return placed.join(offsets, ["_part", "_group"]).withColumn("before", F.col("before") + F.col("_offset")).drop("_part", "_group", "_offset")
