"""Sinks: topics, per-batch parts, keyed results, replaced tables, pool snapshots.

What a stream or job writes is a ``versions.VersionedTable``: a batch that is repeated after a failure takes its own
place, and readers see whole versions.  Keyed results are a log of such batches; readers take the newest row per key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed
from ordermill.functions.times import Moment, moment
from ordermill.session import settle
from ordermill.sources.versions import BATCH, Merge, VersionedTable

BatchWriter = Callable[[DataFrame, int], None]


def publish_events(messages: DataFrame, topic: str, fmt: str = "kafka", path: str | None = None, **options) -> None:
    """(key, value) messages to a topic, or to files split as the topic's partitions would be."""
    if fmt == "kafka":
        messages.select("key", "value").write.format("kafka").option("topic", topic).options(**options).save()
        return
    split = F.pmod(F.hash("key"), F.lit(fixed.TOPIC_PARTITIONS)).alias("partition")
    messages.select("key", "value", split).write.mode("append").partitionBy("partition").format(fmt).options(**options).save(f"{path}/{topic}")


def append_folder(path: str, merge: Merge | None = None) -> BatchWriter:
    """Appends each batch as a part of a table; ``merge`` shrinks the rows of several batches into fewer, in steps."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table = VersionedTable(batch.sparkSession, path)
        table.append(batch, batch_id)
        table.merge_levels(merge)
        table.clean()

    return write


def append_jdbc(table: str, column_types: str | None = None, **options) -> BatchWriter:
    """Appends each batch to a database table; ``batch_id`` lets readers keep the newest row per key."""
    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.withColumn("batch_id", F.lit(batch_id)).write.format("jdbc").option("dbtable", table).options(**options)
        if column_types:
            writer = writer.option("createTableColumnTypes", column_types)
        writer.mode("append").save()

    return write


def overwrite_table(target: str, fmt: str = "parquet", **options) -> BatchWriter:
    """Replaces the whole result with each batch (complete mode)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite").format(fmt).options(**options)
        if fmt == "jdbc":
            writer.option("dbtable", target).option("truncate", "true").save()
        else:
            writer.save(target)

    return write


def replace_table(path: str) -> BatchWriter:
    """Replaces the whole result with each batch (complete mode); readers see the last version until the next is whole."""
    return lambda batch, batch_id: VersionedTable(batch.sparkSession, path).publish(batch, batch_id)


def each_batch(*writers: BatchWriter) -> BatchWriter:
    """Runs the writers on one evaluation of the batch; an empty batch writes nothing."""
    def run(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            if not kept.isEmpty():
                for write in writers:
                    write(kept, batch_id)
        finally:
            kept.unpersist()

    return run


def batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table of batches with their batch_id."""
    rows = VersionedTable(spark, path).read()
    if rows is None:
        raise FileNotFoundError(f"no batch was written to {path}")
    return rows


def newest_kept(log: DataFrame, key: list[str], version: str = BATCH) -> DataFrame:
    """The newest row per key with its version; can be applied in steps."""
    rest = [c for c in log.columns if c not in key]
    newest = F.max_by(F.struct(*rest), F.col(version)).alias("_row")
    return log.groupBy(*key).agg(newest).select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in log.columns])


def newest_rows(log: DataFrame, key: list[str], version: str = BATCH) -> DataFrame:
    """The newest row per key."""
    rest = [c for c in log.columns if c not in key and c != version]
    return newest_kept(log, key, version).select(*key, *rest)


def read_keyed(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """The current row of every key."""
    return newest_rows(batches(spark, path), key)


def compact_keyed(spark: SparkSession, path: str, key: list[str]) -> int:
    """Merges all batches so far into one part; returns the last of them.  A stream may go on writing meanwhile."""
    return VersionedTable(spark, path).merge_all(lambda log: newest_kept(log, key)).last


def _base(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """The last batch that merged parts cover, and their rows."""
    table = VersionedTable(spark, path)
    merged = tuple(p for p in table.manifest().parts if p.level)
    return max((p.last for p in merged), default=-1), table.read(merged)


def write_pool_snapshot(pool: DataFrame, path: str, as_of: Moment) -> None:
    """A new version of the pool with its size and time; readers see it once it is complete.  An older ``as_of`` changes nothing."""
    pool = settle(pool)  # selected once, counted and written from there
    size = pool.agg(F.count(F.lit(1))).scalar()
    stamped = pool.withColumns({"count": size, "updated_at": F.lit(moment(as_of).isoformat())})
    table = VersionedTable(pool.sparkSession, path)
    table.publish(stamped, int(f"{moment(as_of):%Y%m%d%H%M%S}"))
    table.clean()


def read_pool(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the pool."""
    return batches(spark, path)
