"""Arrival of new rows: first copy wins, counters move once, bad records go aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.times import Moment, literal


def first_arrivals(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key, the smallest by ``order``.

    A minimum, not a sorted window: copies shrink before the shuffle, so a key with very many copies
    does not end up in one task.
    """
    rest = [c for c in rows.columns if c not in key and c not in order]
    packed = F.min(F.struct(*order, *rest)).alias("_first")
    return rows.groupBy(*key).agg(packed).select(*[F.col(c) if c in key else F.col(f"_first.{c}").alias(c) for c in rows.columns])


def insert_if_absent(arrivals: DataFrame, key: list[str], order: list[str], target: DataFrame | None = None) -> DataFrame:
    """Rows to append: the first arrival of each key that ``target`` does not hold yet."""
    fresh = first_arrivals(arrivals, key, order)
    return fresh if target is None else fresh.join(target.select(*key), key, "left_anti")


def maintain_last_ordered(users: DataFrame, new_orders: DataFrame) -> DataFrame:
    """users.last_ordered_at as the latest order time, whatever the order of arrival."""
    latest = new_orders.groupBy("user_id").agg(F.max("created_at").alias("_latest"))
    newer = F.greatest("last_ordered_at", "_latest")  # greatest skips NULL
    return users.join(latest, "user_id", "left").withColumn("last_ordered_at", newer).drop("_latest")


def maintain_order_count(products: DataFrame, new_orders: DataFrame) -> DataFrame:
    """products.order_count plus one per new order; NULL counts as 0 once an order arrives."""
    delta = new_orders.groupBy("product_id").agg(F.count(F.lit(1)).alias("_new"))
    grown = F.coalesce("order_count", F.lit(0)) + F.col("_new")
    return (
        products.join(delta, "product_id", "left")
        .withColumn("order_count", F.coalesce(grown, F.col("order_count")))
        .drop("_new")
    )


def merge_snapshot(old: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``old`` with changed columns replaced and new keys added; a NULL in ``changes`` keeps the old value."""
    value_columns = [c for c in old.columns if c != key]
    renamed = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in value_columns if c in changes.columns])
    merged = old.join(renamed, key, "full")
    return merged.select(
        key,
        *[F.coalesce(f"_new_{c}", c).alias(c) if f"_new_{c}" in renamed.columns else F.col(c) for c in value_columns],
    )


def quarantine(decoded: DataFrame, entity: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Split decoded messages into usable rows and rejected ones with a reason.

    ``decoded`` has the raw text as ``value`` and the decoded struct as ``entity``.
    """
    reason = reject_reason(F.col(entity), key)
    marked = decoded.withColumn("reason", reason)
    good = marked.where(F.col("reason").isNull()).select(f"{entity}.*")
    bad = marked.where(F.col("reason").isNotNull()).select("value", "reason")
    return good, bad


def reject_reason(entity: Column, key: str, event_time: str | None = "created_at") -> Column:
    reason = F.when(entity.isNull(), "undecodable").when(entity[key].isNull(), "missing key")
    return reason.when(entity[event_time].isNull(), "missing event time") if event_time else reason


def normalise_types(rows: DataFrame, as_of: Moment, text_flags: list[str] = ["marketing_agree"], moments: list[str] = ["last_login_at", "created_at"]) -> DataFrame:
    """Flags as lower-case text, ISO text as timestamps, a missing created_at set to ``as_of``.

    A malformed time becomes null, also in created_at, for ``reject_reason`` to set the row aside.
    """
    changed: dict[str, Column] = {c: F.lower(F.col(c).cast("string")) for c in text_flags if c in rows.columns}
    for c in moments:
        if c in rows.columns:
            changed[c] = F.try_to_timestamp(F.col(c)) if dict(rows.dtypes)[c] == "string" else F.col(c)
    if "created_at" in changed:
        changed["created_at"] = F.when(F.col("created_at").isNull(), literal(as_of).cast("timestamp")).otherwise(changed["created_at"])
    return rows.withColumns(changed)
