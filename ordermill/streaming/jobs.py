"""Starting streams: checkpointed queries with keyed, repeatable results."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ordermill import fixed_values as fixed
from ordermill.sources import sinks
from ordermill.streaming import statistics


def _triggered(writer, every: str | None):
    """``every`` is a processing time; without one the stream takes what is there and ends."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_keyed(result: DataFrame, path: str, checkpoint: str, name: str, every: str | None = None, key: list[str] | None = None) -> StreamingQuery:
    """Writes the rows each batch changed; ``sinks.read_keyed`` gives the current table.

    With ``key``, merged batches keep the newest row of each key alone.
    """
    merge = partial(sinks.newest_kept, key=key) if key else None
    writer = (
        result.writeStream.queryName(name)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sinks.each_batch(sinks.append_folder(path, merge)))
    )
    return _triggered(writer, every).start()


def start_complete(result: DataFrame, write: sinks.BatchWriter, checkpoint: str, name: str, every: str | None = None) -> StreamingQuery:
    """Rewrites the whole result with each batch; for results that stay small."""
    writer = (
        result.writeStream.queryName(name)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sinks.each_batch(write))
    )
    return _triggered(writer, every).start()


def start_statistic(
    orders: DataFrame, statistic: str, folder: str, every: str | None = None, name: str | None = None,
    late_after: str | None = fixed.LATE_AFTER, **parameters
) -> StreamingQuery:
    """One of ``statistics.STATISTICS`` over a stream of orders.

    Live streams leave rows behind the watermark out of the windows; ``late_rows`` counts them.  A replay of a table has
    no order to rely on: with ``late_after=None`` every row counts, whatever the number of batches.

    Customer totals have no window, so they are kept for all customers; the changed rows alone are
    written, and the state belongs in the disk-backed store (``session.build_session``).
    """
    aggregate, key, _ = statistics.KEPT[statistic]
    result = aggregate(statistics.with_watermark(orders, late_after), **parameters)
    return start_keyed(result, f"{folder}/{statistic}/rows", f"{folder}/{statistic}/checkpoint", name or statistic, every, key)


def read_statistic(spark: SparkSession, statistic: str, folder: str, **parameters) -> DataFrame:
    """The statistic as it stands; ``parameters`` are those of the reader, as the width of windows."""
    _, key, finish = statistics.KEPT[statistic]
    kept = sinks.read_keyed(spark, f"{folder}/{statistic}/rows", key)
    return finish(kept, **parameters) if finish else kept


def start_all(orders: DataFrame, folder: str, every: str | None = "10 seconds", totals_every: str | None = "5 seconds") -> list[StreamingQuery]:
    """The four live statistics side by side, each with its own checkpoint."""
    windowed = ["category_stats", "payment_stats", "age_payment_stats"]
    queries = [start_statistic(orders, s, folder, every) for s in windowed]
    return queries + [start_statistic(orders, "user_totals", folder, totals_every)]


def await_all(queries: list[StreamingQuery]) -> None:
    """Waits for every query; one that fails raises within seconds, also while others go on."""
    while queries:
        queries = [query for query in queries if not query.awaitTermination(1)]


def late_rows(query: StreamingQuery) -> dict[int, int]:
    """Batch -> rows the watermark kept out, over the batches whose progress Spark keeps.

    A row is what reaches the state: rows of one key and window in one task count once.
    """
    return {p.batchId: sum(s.numRowsDroppedByWatermark for s in p.stateOperators) for p in query.recentProgress}


def start_refresh(spark: SparkSession, action: Callable[[int], None], checkpoint: str, every: str, name: str) -> StreamingQuery:
    """Runs ``action`` at a fixed pace: pools every 50 seconds, grades every 600."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        ticks.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .foreachBatch(lambda _, batch_id: action(batch_id))
        .start()
    )
