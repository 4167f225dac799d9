"""Minute statistics that keep what comes late.

Every batch adds partial sums to a log that merges level by level, so no state is held and a repeated batch takes
its own place.  A row whose minute ended before the watermark is set aside, with its batch, and counted; a later
batch folds it into its closed window.  At any moment the statistic and the rows set aside since are the whole stream,
over restarts and whatever the batches.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermill import fixed_values as fixed
from ordermill.sources.versions import BATCH, VersionedTable
from ordermill.streaming import statistics
from ordermill.streaming.jobs import _triggered

STEPS = "batch_id long, newest timestamp, watermark timestamp, late long"


def _summed(log: DataFrame, statistic: str) -> DataFrame:
    """Partial sums of one window and key as one row."""
    keys, number, revenue = statistics.MINUTE_STATISTICS[statistic]
    measures = [F.sum(m).alias(m) for m in (number, revenue) if m]
    return log.groupBy("window_start", *keys).agg(*measures, F.max(BATCH).alias(BATCH))


def _tables(spark: SparkSession, statistic: str, folder: str) -> tuple[VersionedTable, VersionedTable, VersionedTable]:
    return tuple(VersionedTable(spark, f"{folder}/{statistic}/{name}") for name in ("sums", "late", "steps"))


def _steps(table: VersionedTable, before: int | None = None) -> DataFrame | None:
    held = table.read()
    return held if held is None or before is None else held.where(F.col(BATCH) < before)


def add_batch(batch: DataFrame, batch_id: int, statistic: str, folder: str, late_after: str = fixed.LATE_AFTER) -> None:
    """One batch of orders; depends only on the batches before it, so it can be repeated.

    The watermark is the newest event time of earlier batches less ``late_after``; a row without an event time is in no window.
    """
    spark = batch.sparkSession
    sums, late, steps = _tables(spark, statistic, folder)
    earlier = _steps(steps, batch_id)
    last = earlier.agg(F.max("newest").alias("newest"), F.max(BATCH).alias("batch")).first() if earlier is not None else None
    newest = last["newest"] if last else None
    watermark = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {late_after}")
    is_late: Column = F.coalesce(F.date_trunc("minute", "created_at") + F.expr("INTERVAL 1 MINUTE") <= watermark, F.lit(False))
    rows = batch.where(F.col("created_at").isNotNull()).withColumn("_late", is_late).persist()
    try:
        due = rows.where(~F.col("_late")).drop("_late")
        held = late.read()
        if held is not None:  # each late row is folded by the first batch after its own
            since = -1 if last is None else last["batch"]
            due = due.unionByName(held.where((F.col(BATCH) >= since) & (F.col(BATCH) < batch_id)).drop(BATCH))
        sums.append(statistics.per_minute(statistic, due), batch_id)
        late.append(rows.where("_late").drop("_late"), batch_id)
        step = rows.agg(F.max("created_at").alias("newest"), F.count_if("_late").alias("late"))
        step = step.select(F.greatest("newest", F.lit(newest).cast("timestamp")).alias("newest"), watermark.alias("watermark"), "late")
        steps.append(step.coalesce(1), batch_id)
    finally:
        rows.unpersist()
    sums.merge_levels(partial(_summed, statistic=statistic))
    for table in (late, steps):
        table.merge_levels()
    for table in (sums, late, steps):
        table.clean()


def start_audited(
    orders: DataFrame, statistic: str, folder: str, every: str | None = None, name: str | None = None, late_after: str = fixed.LATE_AFTER
) -> StreamingQuery:
    """One of ``statistics.MINUTE_STATISTICS`` over a stream of orders, with its late rows kept."""
    writer = (
        orders.writeStream.queryName(name or f"{statistic}_audited")
        .option("checkpointLocation", f"{folder}/{statistic}/checkpoint")
        .foreachBatch(lambda batch, batch_id: add_batch(batch, batch_id, statistic, folder, late_after))
    )
    return _triggered(writer, every).start()


def read_audited(spark: SparkSession, statistic: str, folder: str, with_unfolded: bool = False) -> DataFrame:
    """The statistic, late rows of all batches but the last folded in; ``with_unfolded`` those of the last one too."""
    sums, _, _ = _tables(spark, statistic, folder)
    held = sums.read()
    if with_unfolded:
        waiting = statistics.per_minute(statistic, unfolded_rows(spark, statistic, folder))
        held = held.unionByName(waiting.withColumn(BATCH, F.lit(-1).cast("long")))
    return _summed(held, statistic).drop(BATCH)


def late_rows(spark: SparkSession, statistic: str, folder: str) -> DataFrame:
    """Every row that came late, with the batch it came in."""
    return _tables(spark, statistic, folder)[1].read()


def unfolded_rows(spark: SparkSession, statistic: str, folder: str) -> DataFrame:
    """Rows that came late in the last batch and are in no window yet."""
    _, late, steps = _tables(spark, statistic, folder)
    return late.read().where(F.col(BATCH) == steps.read().agg(F.max(BATCH)).scalar()).drop(BATCH)


def late_counts(spark: SparkSession, statistic: str, folder: str) -> DataFrame:
    """batch_id, newest, watermark and late (rows) of every batch, over all restarts."""
    return _steps(_tables(spark, statistic, folder)[2]).select(BATCH, "newest", "watermark", "late")
