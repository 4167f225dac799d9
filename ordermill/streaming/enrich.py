"""Order streams joined with customers and products that may come later than their orders.

An order whose customer or product is not there yet waits, and every batch tries those that wait again, against the
tables as they are then.  It waits while its time is within ``wait`` of the newest order time of earlier batches and its
own; then it is set aside with what was missing.  Each batch leaves its own parts: the orders it released, those
that expired, and all that still wait.  The next batch starts from the last of these, so a repeated one finds what it found.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermill.operators import basket
from ordermill.sources.versions import BATCH, VersionedTable
from ordermill.streaming.jobs import _triggered

Read = Callable[[SparkSession], DataFrame]
WAIT = "1 hour"


def _tables(spark: SparkSession, folder: str) -> dict[str, VersionedTable]:
    return {name: VersionedTable(spark, f"{folder}/{name}") for name in ("orders", "expired", "waiting", "times")}


def _waiting_before(table: VersionedTable, batch_id: int | None) -> DataFrame | None:
    """What waited after the last batch before this one."""
    parts = [p for p in table.manifest().parts if batch_id is None or p.last < batch_id]
    return table.read((max(parts, key=lambda p: p.last),)).drop(BATCH) if parts else None


def add_batch(batch: DataFrame, batch_id: int, folder: str, users: Read, products: Read, wait: str = WAIT) -> None:
    """One batch of orders (user_id, product_id, created_at and more); an order without a time does not wait.

    ``users`` and ``products`` read the tables as they are now, with a key once.
    """
    spark = batch.sparkSession
    tables = _tables(spark, folder)
    times = tables["times"].read()
    newest = times.where(F.col(BATCH) < batch_id).agg(F.max("newest")).first()[0] if times is not None else None
    held = _waiting_before(tables["waiting"], batch_id)
    due = batch if held is None else batch.unionByName(held)
    columns = due.columns
    who = basket.customer_labels(users(spark)).withColumn("_user", F.lit(True))
    what = basket.product_labels(products(spark)).withColumn("_product", F.lit(True))
    tried = due.join(who, "user_id", "left").join(what, "product_id", "left").persist()
    try:
        limit = F.greatest(F.lit(newest).cast("timestamp"), F.lit(batch.agg(F.max("created_at")).first()[0]).cast("timestamp"))
        missing = F.array_compact(F.array(F.when(F.col("_user").isNull(), "customer"), F.when(F.col("_product").isNull(), "product")))
        early = F.coalesce(F.col("created_at") >= limit - F.expr(f"INTERVAL {wait}"), F.lit(False))
        found, open_ = F.size(missing) == 0, tried.where(F.size(missing) > 0)
        tables["orders"].append(basket.with_labels(tried.where(found), columns), batch_id)
        tables["expired"].append(open_.where(~early).select(*columns, F.concat_ws(" and ", missing).alias("missing")), batch_id)
        tables["waiting"].append(open_.where(early).select(*columns), batch_id)
        tables["times"].append(tried.select(limit.alias("newest")).limit(1), batch_id)
    finally:
        tried.unpersist()
    for name in ("orders", "expired", "times"):
        tables[name].merge_levels()
    latest = sorted(tables["waiting"].manifest().parts, key=lambda p: p.last)[-2:]  # this batch's, and the one a repeat begins with
    tables["waiting"].commit(lambda old: replace(old, parts=tuple(latest)))
    for table in tables.values():
        table.clean()


def start_enriched(orders: DataFrame, folder: str, users: Read, products: Read, wait: str = WAIT, every: str | None = None, name: str = "enriched") -> StreamingQuery:
    writer = (
        orders.writeStream.queryName(name)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .foreachBatch(lambda batch, batch_id: add_batch(batch, batch_id, folder, users, products, wait))
    )
    return _triggered(writer, every).start()


def enriched_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with category, region, gender and age group."""
    return _tables(spark, folder)["orders"].read().drop(BATCH)


def expired_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that waited too long, with what was missing."""
    return _tables(spark, folder)["expired"].read().drop(BATCH)


def waiting_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _waiting_before(_tables(spark, folder)["waiting"], None)
