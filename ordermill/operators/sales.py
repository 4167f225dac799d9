"""Sales metrics.  ``orders`` has order_id, created_at, user_id, product_id, total_amount, status, ..."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed
from ordermill.functions import money, times
from ordermill.functions.times import Moment


def _since(orders: DataFrame, since: Moment | None) -> DataFrame:
    return orders if since is None else orders.where(times.on_or_after(F.col("created_at"), since))


def total_revenue(orders: DataFrame, since: Moment | None = None) -> DataFrame:
    """Sum of all amounts, whatever the status."""
    return _since(orders, since).agg(money.total(F.col("total_amount")).alias("total_revenue"))


def order_count(orders: DataFrame, since: Moment | None = None) -> DataFrame:
    return _since(orders, since).agg(F.count(F.lit(1)).alias("order_count"))


def avg_order_value(orders: DataFrame, since: Moment | None = None) -> DataFrame:
    """Mean amount in whole won."""
    return _since(orders, since).agg(F.round(money.mean(F.col("total_amount"))).alias("avg_order_value"))


def pivot_count(orders: DataFrame, row: str, column: str, values: list[str], since: Moment | None = None) -> DataFrame:
    """Row counts of ``row`` by the given ``values`` of ``column``; one pass, fixed output columns."""
    cells = [F.count_if(F.col(column) == v).alias(v) for v in values]
    return _since(orders, since).groupBy(row).agg(*cells).orderBy(row)


def payment_by_age(orders: DataFrame, since: Moment | None = None) -> DataFrame:
    return pivot_count(orders, "user_age_group", "payment_method", fixed.PAYMENT_METHODS, since)


def share_of_count(orders: DataFrame, by: str, since: Moment | None = None) -> DataFrame:
    """Percent of the rows per value of ``by``, one decimal.

    The total is a scalar subquery over the per-value counts, so no row meets all others in one task.
    """
    counts = _since(orders, since).groupBy(by).agg(F.count(F.lit(1)).alias("orders"))
    total = counts.agg(F.sum("orders")).scalar()
    return counts.select(by, F.round(F.col("orders") * 100.0 / total, 1).cast("double").alias("percentage"))


def trend(orders: DataFrame, minutes: int = 5, shift_hours: int = 0, since: Moment | None = None) -> DataFrame:
    """Orders per ``minutes``-wide slot."""
    slot = times.bucket_start(F.col("created_at"), minutes, shift_hours)
    return _since(orders, since).groupBy(slot.alias("bucket")).agg(F.count(F.lit(1)).alias("orders")).orderBy("bucket")


def hour_profile(orders: DataFrame, as_of: Moment, days: int = 1) -> DataFrame:
    """Orders per hour of day over the last ``days``, in numeric hour order."""
    return (
        orders.where(times.within(F.col("created_at"), as_of, days=days))
        .groupBy(F.hour("created_at").alias("hour"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy("hour")
        .select(F.concat(F.col("hour").cast("string"), F.lit(fixed.HOUR_SUFFIX)).alias("hour_label"), "orders")
    )


def dow_hour_matrix(orders: DataFrame, as_of: Moment, days: int = 7) -> DataFrame:
    """Orders and revenue per weekday and hour over the last ``days``, Sunday first."""
    ts = F.col("created_at")
    labels = F.array(*[F.lit(x) for x in fixed.WEEKDAY_LABELS])
    return (
        orders.where(times.within(ts, as_of, days=days))
        .groupBy(times.sunday_first(ts).alias("dow"), F.hour(ts).alias("hour"))
        .agg(F.count(F.lit(1)).alias("orders"), money.total(F.col("total_amount")).alias("revenue"))
        .orderBy("dow", "hour")
        .select(
            F.element_at(labels, F.col("dow") + 1).alias("weekday"),
            F.concat(F.col("hour").cast("string"), F.lit(fixed.HOUR_SUFFIX)).alias("hour_label"),
            "orders",
            "revenue",
        )
    )


def customer_frequency_value(orders: DataFrame) -> DataFrame:
    """Successful orders and mean amount per customer."""
    return (
        orders.where(F.col("status") == fixed.SUCCESS)
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("frequency"), money.mean(F.col("total_amount")).alias("avg_amount"))
    )


def _per_key(orders: DataFrame, key: str) -> DataFrame:
    """Counts and amounts per key before a join: each side then holds one row per key."""
    return orders.groupBy(key).agg(
        F.count(F.lit(1)).alias("orders"), money.total(F.col("total_amount")).alias("revenue")
    )


def brand_revenue_topk(orders: DataFrame, products: DataFrame, since: Moment | None = None, k: int = 20) -> DataFrame:
    return (
        _per_key(_since(orders, since), "product_id")
        .join(products.select("product_id", "brand"), "product_id")
        .groupBy("brand")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.desc("revenue"), "brand")
        .limit(k)
    )


def gender_category_topk(orders: DataFrame, k: int = 10) -> DataFrame:
    """Successful orders of men and women per category, most orders first."""
    known = orders.where(
        (F.col("status") == fixed.SUCCESS) & F.col("user_gender").isNotNull() & F.col("category").isNotNull()
    )
    return (
        known.groupBy("category")
        .agg(F.count_if(F.col("user_gender") == "M").alias("male"), F.count_if(F.col("user_gender") == "F").alias("female"))
        .orderBy(F.desc(F.col("male") + F.col("female")), "category")
        .limit(k)
    )


def districts(spark, rows=None) -> DataFrame:
    """District coordinates, a constant table."""
    return spark.createDataFrame(rows or fixed.DISTRICTS, "district string, latitude double, longitude double")


def _by_region(orders: DataFrame, users: DataFrame) -> DataFrame:
    return (
        _per_key(orders.where(F.col("user_id").isNotNull()), "user_id")
        .join(users.select("user_id", F.col("address_district").alias("district")), "user_id")
        .groupBy("district")
        .agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
    )


def region_orders(orders: DataFrame, users: DataFrame, geo: DataFrame | None = None) -> DataFrame:
    """Orders per district with its coordinates; a district off the map has none."""
    geo = districts(orders.sparkSession) if geo is None else geo
    return _by_region(orders, users).join(geo, "district", "left").select("district", "orders", "latitude", "longitude")


def region_revenue(orders: DataFrame, users: DataFrame, geo: DataFrame | None = None) -> DataFrame:
    geo = districts(orders.sparkSession) if geo is None else geo
    return _by_region(orders, users).join(geo, "district", "left").select("district", "revenue", "latitude", "longitude")


def monthly_orders(orders: DataFrame, start: Moment, end: Moment) -> DataFrame:
    """Orders per month in [start, end)."""
    ts = F.col("created_at")
    return (
        orders.where(times.on_or_after(ts, start) & times.before(ts, end))
        .groupBy(F.trunc(ts.cast("date"), "MM").alias("month"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy("month")
    )


def top_products(products: DataFrame, k: int = 20) -> DataFrame:
    return (
        products.select("product_id", "name", "order_count")
        .orderBy(F.col("order_count").desc_nulls_last(), "product_id")
        .limit(k)
    )


def purchased_vs_new(users: DataFrame) -> DataFrame:
    """Customers with and without an order, in one pass."""
    seen = F.col("last_ordered_at").isNotNull()
    return users.agg(F.count_if(seen).alias("purchased"), F.count_if(~seen).alias("new_users"))


def age_group_orders(orders: DataFrame) -> DataFrame:
    return orders.groupBy("user_age_group").agg(F.count("order_id").alias("orders")).orderBy("user_age_group")
