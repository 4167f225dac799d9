"""Ingestion of order, customer and product events: decode, set aside, insert once, move counters once.

Everything a batch changes goes to versioned tables, as a part named by its batch id.  A repeated batch writes the same
rows again in its own place, and counters, which are sums over the inserted rows, cannot move twice.

Which rows are known already is answered by the filters of ``sources.known_ids``; copies shrink to one row before, so
no key is hot there.  Customers and products are kept current by merging: orders add (key, change) rows to a log of
their own, merged level by level into one row per key, and a reader joins them with the inserted rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermill import fixed_values as fixed
from ordermill import schemas
from ordermill.operators import ingest
from ordermill.sources import envelopes, sinks
from ordermill.sources.known_ids import KnownIds
from ordermill.sources.versions import BATCH, VersionedTable
from ordermill.streaming.jobs import _triggered


# entity -> (payload, column that must not be missing); what the topic of the entity carries
PAYLOADS = {
    "order": (schemas.ORDERS, "created_at"),
    "user": (schemas.USERS, None),
    "product": (schemas.PRODUCTS, None),
}


def _checked(raw: DataFrame, entity: str) -> DataFrame:
    payload, event_time = PAYLOADS[entity]
    reason = ingest.reject_reason(F.col(entity), schemas.required_key(payload), event_time)
    return envelopes.decode(raw, entity, payload).withColumn("reason", reason)


def _accepted(checked: DataFrame, entity: str, *keep: str) -> DataFrame:
    return checked.where(F.col("reason").isNull()).select(f"{entity}.*", *keep)


def _rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNotNull()).select(F.col("value").cast("string").alias("value"), "reason")


def _last_orders(log: DataFrame) -> DataFrame:
    return log.groupBy("user_id").agg(F.max("last_ordered_at").alias("last_ordered_at"), F.max(BATCH).alias(BATCH))


def _order_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("product_id").agg(F.sum("orders").alias("orders"), F.max(BATCH).alias(BATCH))


CHANGES = {"user_orders": _last_orders, "product_orders": _order_counts}  # log -> how its batches merge


def _add_changes(inserted: DataFrame, batch_id: int, folder: str) -> None:
    """What a batch's new orders change in customers and products."""
    spark = inserted.sparkSession
    per_product = inserted.groupBy("product_id").agg(F.count(F.lit(1)).alias("orders"))
    VersionedTable(spark, f"{folder}/product_orders").append(per_product, batch_id)
    per_user = inserted.groupBy("user_id").agg(F.max("created_at").alias("last_ordered_at"))
    VersionedTable(spark, f"{folder}/user_orders").append(per_user, batch_id)


def start_ingest(
    raw: DataFrame, folder: str, arrival: tuple[str, ...], every: str | None = None, name: str = "ingest", entity: str = "order"
) -> list[StreamingQuery]:
    """One query on the stream of messages; each batch is a ``load_batch``: new rows, counters, rejected messages.

    The first copy of a row wins: within a batch by ``arrival`` (an offset, a time), else the earlier batch.  Each message
    is read once.
    """
    writer = (
        raw.writeStream.queryName(f"{name}_{entity}")
        .option("checkpointLocation", f"{folder}/checkpoint/{entity}")
        .foreachBatch(lambda batch, batch_id: load_batch(batch, batch_id, folder, entity, arrival))
    )
    return [_triggered(writer, every).start()]


def load_batch(
    batch: DataFrame,
    batch_id: int,
    folder: str,
    entity: str = "order",
    arrival: tuple[str, ...] = ("arrived_at",),
) -> None:
    """One bulk load of messages; ``arrival`` columns say which copy came first.

    Depends only on the loads before it, so it can be repeated.  Levels are merged when all is written: then no
    table has merged a batch that another still lacks.
    """
    spark = batch.sparkSession
    key = schemas.required_key(PAYLOADS[entity][0])
    table, rejected = VersionedTable(spark, f"{folder}/{fixed.TOPICS[entity]}"), VersionedTable(spark, f"{folder}/rejected/{entity}")
    known = KnownIds(table, key)
    checked = _checked(batch, entity).persist()
    try:
        arrived = ingest.first_arrivals(_accepted(checked, entity, *arrival), [key], list(arrival)).drop(*arrival).persist()
        try:
            earlier = known.among(arrived, before=batch_id)
            fresh = arrived if earlier is None else arrived.join(earlier, F.col(key) == F.col("_id"), "left_anti")
            part = table.append(fresh, batch_id, known.index)
        finally:
            arrived.unpersist()
        if part and entity == "order":
            _add_changes(table.read((part,)), batch_id, folder)
        rejected.append(_rejected(checked), batch_id)
    finally:
        checked.unpersist()
    table.merge_levels(beside=known.index)
    rejected.merge_levels()
    table.clean()
    rejected.clean()
    for name, merge in CHANGES.items() if entity == "order" else ():
        log = VersionedTable(spark, f"{folder}/{name}")
        log.merge_levels(merge)
        log.clean()


def ingested(spark: SparkSession, folder: str, entity: str = "order") -> DataFrame:
    return sinks.batches(spark, f"{folder}/{fixed.TOPICS[entity]}").drop(BATCH)


def rejected_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages set aside, of all entities fed to ``folder``."""
    held = [rows for entity in PAYLOADS if (rows := VersionedTable(spark, f"{folder}/rejected/{entity}").read()) is not None]
    return reduce(DataFrame.union, held).drop(BATCH)


def product_order_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per product over all batches."""
    return _order_counts(sinks.batches(spark, f"{folder}/product_orders")).select("product_id", F.col("orders").alias("order_count"))


def user_last_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _last_orders(sinks.batches(spark, f"{folder}/user_orders")).drop(BATCH)


def current_users(spark: SparkSession, folder: str, users: DataFrame | None = None) -> DataFrame:
    """Customers with the time of their last order, as far as ``folder`` has been fed; ``users`` instead of the ingested ones."""
    users = ingested(spark, folder, "user") if users is None else users
    latest = user_last_orders(spark, folder).withColumnRenamed("last_ordered_at", "_latest")
    return users.join(latest, "user_id", "left").withColumn("last_ordered_at", F.greatest("last_ordered_at", "_latest")).drop("_latest")


def current_products(spark: SparkSession, folder: str, products: DataFrame | None = None) -> DataFrame:
    """Products with their number of orders; null counts as 0 once an order arrives."""
    products = ingested(spark, folder, "product") if products is None else products
    counted = product_order_counts(spark, folder).withColumnRenamed("order_count", "_more")
    grown = F.coalesce(F.coalesce("order_count", F.lit(0)) + F.col("_more"), F.col("order_count"))
    return products.join(counted, "product_id", "left").withColumn("order_count", grown).drop("_more")


def drop_recent_copies(orders: DataFrame, key: str = "order_id", late_after: str = fixed.LATE_AFTER) -> DataFrame:
    """Drops copies that arrive within the watermark only; its state stays bounded."""
    return orders.withWatermark("created_at", late_after).dropDuplicatesWithinWatermark([key])
