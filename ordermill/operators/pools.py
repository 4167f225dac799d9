"""Candidate pools: new entries first up to a limit, the rest filled from the known ones."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed
from ordermill.functions import seeded
from ordermill.functions.times import Moment, moment


def _fill(newest: DataFrame, known: DataFrame, size: int, order: list[Column], **extra: str) -> DataFrame:
    """``newest`` whole, then ``known`` up to ``size`` rows.

    Both arrive cut to at most ``size`` rows, so the one window over their union is small by construction.
    """
    both = newest.withColumn("part", F.lit("new")).unionByName(known.withColumn("part", F.lit("known")))
    place = F.row_number().over(Window.orderBy(F.when(F.col("part") == "new", 0).otherwise(1), *order))
    return both.withColumn("place", place).where(F.col("place") <= size)


def user_pool(users: DataFrame, size: int = fixed.POOL_SIZE, new_limit: int = fixed.POOL_NEW_USERS) -> DataFrame:
    """Customers who never ordered, newest first, then those whose last order is oldest.

    A shortage of new customers is filled from the known ones, not the other way round.
    """
    newest_first = F.col("created_at").desc_nulls_first()
    oldest_order = F.col("last_ordered_at").asc_nulls_last()
    fresh = users.where(F.col("last_ordered_at").isNull()).orderBy(newest_first, "user_id").limit(min(new_limit, size))
    known = users.where(F.col("last_ordered_at").isNotNull()).orderBy(oldest_order, "user_id").limit(size)
    recency = F.when(F.col("part") == "new", F.col("created_at")).desc_nulls_first()
    return _fill(fresh, known, size, [recency, oldest_order, F.col("user_id")])


def product_pool(products: DataFrame, size: int = fixed.POOL_SIZE, new_limit: int = fixed.POOL_NEW_PRODUCTS) -> DataFrame:
    """Products never ordered, newest first, then the most ordered ones."""
    newest_first = F.col("created_at").desc_nulls_first()
    popular = F.col("order_count").desc()
    fresh = products.where(F.col("order_count") == 0).orderBy(newest_first, "product_id").limit(min(new_limit, size))
    known = products.where(F.col("order_count") > 0).orderBy(popular, "product_id").limit(size)
    recency = F.when(F.col("part") == "new", F.col("created_at")).desc_nulls_first()
    return _fill(fresh, known, size, [recency, popular, F.col("product_id")])


def seed_sample(users: DataFrame, n: int = fixed.POOL_SIZE, seed_column: str = "random_seed", key: str = "user_id") -> DataFrame:
    """The first n by their stored random number."""
    return users.orderBy(F.col(seed_column).asc_nulls_last(), key).limit(n)


def pool_for_day(users: DataFrame, day: Moment, start: Moment, **sizes: int) -> DataFrame:
    """The pool of ``day``: a seeded sample during warm-up, the filled pool afterwards."""
    if moment(day) - moment(start) < timedelta(days=fixed.WARM_UP_DAYS):
        return seed_sample(users, sizes.get("size", fixed.POOL_SIZE))
    return user_pool(users, **sizes)


def random_members(pool: DataFrame, key: str, k: int = 1, seed: int | str = 42) -> DataFrame:
    """k members without replacement, the same for the same seed."""
    return pool.orderBy(seeded.draw32(F.col(key), seed), key).limit(k)
