"""Data-quality lists, alert counters and key checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed
from ordermill.functions import checks, times
from ordermill.functions.times import Moment


def stockout_list(products: DataFrame) -> DataFrame:
    return products.where(checks.out_of_stock(F.col("stock"))).select("product_id", "name", "stock").orderBy("stock", "product_id")


def integrity_errors(products: DataFrame, max_rate: float = 100) -> DataFrame:
    """Impossible discount rates and prices above the list price."""
    wrong = checks.inconsistent_price(F.col("discount_rate"), F.col("price"), F.col("org_price"), max_rate)
    return products.where(wrong).select("product_id", "name", "price", "org_price", "discount_rate")


def abnormal_orders(orders: DataFrame, limit: float = fixed.ABNORMAL_AMOUNT, k: int = 100) -> DataFrame:
    """Newest orders with a negative or very large amount."""
    return (
        orders.where(checks.abnormal_amount(F.col("total_amount"), limit))
        .select("order_id", "total_amount", "created_at")
        .orderBy(F.col("created_at").desc_nulls_first(), "order_id")
        .limit(k)
        .select("order_id", "total_amount", times.clock_text(F.col("created_at")).alias("ordered_at"))
    )


def abnormal_recent(orders: DataFrame, as_of: Moment, limit: float = fixed.ABNORMAL_AMOUNT, minutes: float = 10) -> DataFrame:
    """How many abnormal orders the last ``minutes`` brought."""
    recent = times.within(F.col("created_at"), as_of, minutes=minutes)
    return orders.where(recent & checks.abnormal_amount(F.col("total_amount"), limit)).agg(F.count(F.lit(1)).alias("abnormal_orders"))


def alert_counts(products: DataFrame, orders: DataFrame, limit: float = fixed.ABNORMAL_AMOUNT, max_rate: float = 100) -> DataFrame:
    """The three alert counters; both product counters come from one pass."""
    wrong = checks.inconsistent_price(F.col("discount_rate"), F.col("price"), F.col("org_price"), max_rate)
    on_products = products.agg(
        F.count_if(checks.out_of_stock(F.col("stock"))).alias("stockout"), F.count_if(wrong).alias("integrity")
    ).select(F.expr("stack(2, 'stockout', stockout, 'integrity', integrity) AS (alert, alerts)"))
    on_orders = orders.agg(F.count_if(checks.abnormal_amount(F.col("total_amount"), limit)).alias("alerts")).select(
        F.lit("abnormal").alias("alert"), "alerts"
    )
    return on_products.unionByName(on_orders)


def alert_level(counts: DataFrame, steps: dict[str, list[tuple[int, str]]] | None = None) -> DataFrame:
    """Level of each counter by its own steps."""
    steps = steps or {
        "stockout": fixed.STOCK_LEVELS,
        "integrity": fixed.INTEGRITY_LEVELS,
        "abnormal": fixed.ABNORMAL_LEVELS,
    }
    levels = [F.when(F.col("alert") == alert, checks.level(F.col("alerts"), rule)) for alert, rule in steps.items()]
    return counts.withColumn("level", F.coalesce(*levels))


def duplicate_keys(table: DataFrame, name: str, key: list[str]) -> DataFrame:
    """How many key values occur more than once."""
    doubled = table.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1)
    return doubled.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(f"pk:{name}").alias("rule"), "violations")


def missing_references(child: DataFrame, parent: DataFrame, name: str, key: str) -> DataFrame:
    """How many distinct key values of ``child`` have no row in ``parent``.

    Distinct first: each side then holds a key once, so a very common key costs no more than any other.
    """
    keys = child.where(F.col(key).isNotNull()).select(key).distinct()
    return (
        keys.join(parent.select(key), key, "left_anti")
        .agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit(f"fk:{name}").alias("rule"), "violations")
    )


def fk_pk_checks(users: DataFrame, products: DataFrame, orders: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Unique keys of the three tables and the references of orders (``lines`` where products are kept apart)."""
    detail = orders if lines is None else lines
    found = [
        duplicate_keys(users, "users", ["user_id"]),
        duplicate_keys(products, "products", ["product_id"]),
        duplicate_keys(orders, "orders", ["order_id"]),
        missing_references(orders, users, "orders.user_id", "user_id"),
        missing_references(detail, products, "orders.product_id", "product_id"),
    ]
    return reduce(DataFrame.unionByName, found)
