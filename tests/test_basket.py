from datetime import datetime

from pyspark.sql import functions as F

from ordermill.functions import people
from ordermill.operators import basket

T0 = datetime(2025, 5, 1, 10)


def test_copurchase_counts_customers_once_and_needs_enough(spark, rows):
    bought = {f"u{i}": ["A", "B"] for i in range(5)} | {f"v{i}": ["B", "C", "C"] for i in range(4)} | {"w": ["A"]}
    data = [(u, c, "Success") for u, cs in bought.items() for c in cs] + [("v9", "B", "Success"), ("v9", "C", "Cancelled"), ("x", None, "Success")]
    orders = spark.createDataFrame(data, "user_id string, category string, status string")
    assert rows(basket.category_copurchase(orders)) == [("A + B", 5)]
    assert rows(basket.category_copurchase(orders, min_users=4)) == [("A + B", 5), ("B + C", 4)]


def test_denormalise_fills_gaps_only(spark):
    users = spark.createDataFrame(
        [("u1", "서울시 강남구", "F", 25), ("u2", "  부산시  해운대구", "M", 60), ("u3", None, "M", 0), ("u4", "   ", None, None), ("u5", "대구시", "F", 9)],
        "user_id string, address string, gender string, age int",
    )
    products = spark.createDataFrame([("p1", "캠핑")], "product_id string, category string")
    orders = spark.createDataFrame(
        [(1, "u1", "p1", None), (2, "u2", "p1", "own"), (3, "u3", "p1", None), (4, "u4", "p1", None), (5, "u5", "p1", None), (6, "zz", "p1", None), (7, "u1", "zz", None)],
        "order_id int, user_id string, product_id string, category string",
    )
    out = {r["order_id"]: (r["category"], r["user_region"], r["user_gender"], r["user_age_group"]) for r in basket.denormalise_orders(orders, users, products).collect()}
    assert out == {
        1: ("캠핑", "서울시", "F", "20대"), 2: ("own", "부산시", "M", "60대"), 3: ("캠핑", "Unknown", "M", "Unknown"),
        4: ("캠핑", "Unknown", None, "Unknown"), 5: ("캠핑", "대구시", "F", "0대"),
    }
    rejected = {r["order_id"]: r["reason"] for r in basket.reject_orphans(orders, users, products).collect()}
    assert rejected == {6: "user not found", 7: "product not found"}


def test_denormalise_with_other_labels(spark):
    users = spark.createDataFrame([("u1", "서울시 강남구", "서울", "F", 64)], "user_id string, address string, address_district string, gender string, age int")
    products = spark.createDataFrame([("p1", "캠핑")], "product_id string, category string")
    orders = spark.createDataFrame([(1, "u1", "p1")], "order_id int, user_id string, product_id string")
    out = basket.denormalise_orders(orders, users, products, region=F.col("address_district"), age_group=people.age_band(F.col("age"))).first()
    assert (out["user_region"], out["user_age_group"], out["category"]) == ("서울", "50대이상", "캠핑")


def test_abnormal_detail_keeps_orders_of_unknown_buyers(spark):
    orders = spark.createDataFrame(
        [(1, "u", -1, T0), (2, "u", 0, T0), (3, "u", 9_999_999, T0), (4, "gone", 10_000_000, T0)],
        "order_id int, user_id string, total_amount int, created_at timestamp_ntz",
    )
    users = spark.createDataFrame([("u", "Kim")], "user_id string, name string")
    out = [tuple(r) for r in basket.abnormal_order_detail(orders, users).collect()]
    assert out == [(1, "Kim", -1, "2025-05-01 10:00:00"), (4, None, 10_000_000, "2025-05-01 10:00:00")]


def test_basket_sizes_and_mean(spark, rows):
    lines = spark.createDataFrame([("u", T0)] * 3 + [("v", T0), ("w", T0)], "user_id string, created_at timestamp_ntz")
    sizes = basket.basket_sizes(lines)
    assert rows(sizes) == [(1, 2), (3, 1)]
    assert basket.mean_basket_size(sizes).first()[0] == 5 / 3


def test_amounts_and_derivations(spark):
    lines = spark.createDataFrame([(100, 2, 2500, 50), (100, 1, 0, 500)], "price int, quantity int, shipping_cost int, discount_amount int")
    assert [int(r["total_amount"]) for r in basket.order_amounts(lines).collect()] == [2650, 0]
    products = spark.createDataFrame(
        [(1250, 1000, 1001, 4.6), (1000, 1000, 1000, 4.9), (900, 1099, 5000, 4.5), (None, 100, 5000, 4.9)],
        "org_price int, price int, review_count int, rating double",
    )
    got = [(r["discount_rate"], r["is_best"], r["price_floor"]) for r in basket.product_derivations(products).collect()]
    assert got == [(0.2, "Y", 1000), (0.0, "N", 1000), (0.0, "N", 1000), (0.0, "Y", 100)]


def test_copurchase_of_very_many_categories_forms_pairs_of_frequent_ones_alone(spark, rows):
    import random

    rng = random.Random(5)
    bought = {f"u{i}": {f"rare{rng.randrange(50_000)}" for _ in range(150)} | set(rng.sample(["A", "B", "C", "D"], 2)) for i in range(300)}
    bought["all"] = {f"rare{k}" for k in range(50_000)} | {"A", "B"}
    data = [(u, c, "Success") for u, cs in bought.items() for c in cs]
    orders = spark.createDataFrame(data, "user_id string, category string, status string").repartition(4)
    support = {}
    for cs in bought.values():
        for c in cs:
            support[c] = support.get(c, 0) + 1
    frequent, want = {c for c, n in support.items() if n >= 8}, {}
    for cs in bought.values():
        held = sorted(cs & frequent)
        for i, a in enumerate(held):
            for b in held[i + 1 :]:
                want[f"{a} + {b}"] = want.get(f"{a} + {b}", 0) + 1
    assert rows(basket.category_copurchase(orders, min_users=8, k=1000)) == sorted(((p, n) for p, n in want.items() if n >= 8), key=repr)
