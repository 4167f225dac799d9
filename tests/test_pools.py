from datetime import datetime, timedelta

import pytest

from ordermill.operators import pools

T0 = datetime(2025, 1, 1)
USERS = "user_id int, created_at timestamp_ntz, last_ordered_at timestamp_ntz, random_seed double"


def users(spark, new, known):
    data = [(i, T0 + timedelta(days=i % 7), None, (i * 37 % 100) / 100) for i in range(new)]
    data += [(1000 + i, T0, T0 + timedelta(days=i % 11), 0.5) for i in range(known)]
    return spark.createDataFrame(data, USERS)


@pytest.mark.parametrize("new,known,expect_new,expect_known", [(10, 50, 4, 6), (2, 50, 2, 8), (50, 3, 4, 3), (0, 4, 0, 4), (0, 0, 0, 0)])
def test_only_a_shortage_of_new_customers_is_filled(spark, new, known, expect_new, expect_known):
    pool = pools.user_pool(users(spark, new, known), size=10, new_limit=4).collect()
    assert sum(r["part"] == "new" for r in pool) == expect_new
    assert sum(r["part"] == "known" for r in pool) == expect_known
    assert sorted(r["place"] for r in pool) == list(range(1, len(pool) + 1))


def test_user_pool_order(spark):
    pool = sorted(pools.user_pool(users(spark, 10, 50), size=10, new_limit=4).collect(), key=lambda r: r["place"])
    fresh = [r["user_id"] for r in pool if r["part"] == "new"]
    known = [r["user_id"] for r in pool if r["part"] == "known"]
    assert fresh == sorted(range(10), key=lambda i: (-(i % 7), i))[:4]
    assert known == sorted((1000 + i for i in range(50)), key=lambda u: ((u - 1000) % 11, u))[:6]


def test_product_pool(spark):
    data = [(i, T0 + timedelta(days=i), 0) for i in range(5)] + [(100 + i, T0, i + 1) for i in range(20)] + [(999, T0, None)]
    products = spark.createDataFrame(data, "product_id int, created_at timestamp_ntz, order_count int")
    pool = [r["product_id"] for r in sorted(pools.product_pool(products, size=8, new_limit=3).collect(), key=lambda r: r["place"])]
    assert pool == [4, 3, 2, 119, 118, 117, 116, 115]


def test_warm_up_uses_the_stored_seed(spark):
    table = users(spark, 20, 0)
    first = [r["user_id"] for r in pools.pool_for_day(table, T0 + timedelta(days=6), T0, size=5).collect()]
    assert first == sorted(range(20), key=lambda i: (i * 37 % 100, i))[:5]
    later = pools.pool_for_day(table, T0 + timedelta(days=7), T0, size=5)
    assert "place" in later.columns


def test_random_members_repeat_by_seed(spark):
    table = users(spark, 100, 0)
    draw = lambda seed: {r["user_id"] for r in pools.random_members(table, "user_id", 10, seed).collect()}
    assert draw(1) == draw(1) and len(draw(1)) == 10 and draw(1) != draw(2)
