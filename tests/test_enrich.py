import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ordermill.operators import basket
from ordermill.streaming import enrich

T0 = datetime(2025, 5, 1, 10)
ORDER = "order_id string, user_id string, product_id string, created_at timestamp, category string, amount int"


def world(spark, seed=1, n=240):
    rng = random.Random(seed)
    orders = [(f"o{i}", f"u{rng.randrange(30)}" if i % 31 else None, f"p{rng.randrange(12)}", T0 + timedelta(minutes=i) if i % 41 else None, "own" if i % 5 == 0 else None, i) for i in range(n)]
    users = [(f"u{k}", f"Seoul Street {k}", "F" if k % 2 else "M", 20 + k) for k in range(29)]  # u29 never comes
    products = [(f"p{k}", f"C{k % 3}") for k in range(11)]  # nor does p11
    return orders, users, products, lambda some: spark.createDataFrame(some, ORDER)


def tables(spark, users, products):
    return (lambda s: s.createDataFrame(users, "user_id string, address string, gender string, age int"), lambda s: s.createDataFrame(products, "product_id string, category string"))


def test_late_dimensions_give_the_batch_result_and_the_rest_is_listed(spark, tmp_path, rows):
    orders, users, products, frame = world(spark)
    folder = str(tmp_path)
    for n in range(6):  # a sixth of the orders, and of customers and products as many as have come by then
        seen = tables(spark, users[: 5 * (n + 1)], products[: 2 * (n + 1)])
        for _ in range(2 if n in (2, 4) else 1):  # two batches are repeated
            enrich.add_batch(frame(orders[n * 40 : (n + 1) * 40]), n, folder, *seen, wait="10 hours")
    whole_users, whole_products = (read(spark) for read in tables(spark, users, products))
    known = [o for o in orders if o[1] and o[1] != "u29" and o[2] != "p11"]
    timeless = {o[0] for o in known if o[3] is None}
    expired = enrich.expired_orders(spark, folder)
    gone = {r["order_id"]: r["missing"] for r in expired.collect()}
    want = basket.denormalise_orders(frame([o for o in known if o[0] not in gone]), whole_users, whole_products)
    assert rows(enrich.enriched_orders(spark, folder)) == rows(want) and want.count() > 180
    assert set(gone) & {o[0] for o in known} <= timeless  # within ten hours, only what has no time expires
    waiting = {r["order_id"] for r in enrich.waiting_orders(spark, folder).collect()}
    assert waiting == {o[0] for o in orders if o not in known and o[3] is not None}
    released = {r["order_id"] for r in enrich.enriched_orders(spark, folder).collect()}
    assert not released & set(gone) and released | set(gone) | waiting == {o[0] for o in orders}
    assert len(enrich._tables(spark, folder)["waiting"].manifest().parts) == 2


def test_orders_wait_no_longer_than_they_may(spark, tmp_path):
    orders, users, products, frame = world(spark, 2, 120)
    folder, seen = str(tmp_path), tables(spark, users, products)
    for n in range(3):
        enrich.add_batch(frame(orders[n * 40 : (n + 1) * 40]), n, folder, *seen, wait="30 minutes")
    gone = {r["order_id"]: r["missing"] for r in enrich.expired_orders(spark, folder).collect()}
    missing = {o[0]: " and ".join(["customer"] * (o[1] in (None, "u29")) + ["product"] * (o[2] == "p11")) for o in orders}
    newest = max(o[3] for o in orders if o[3])
    assert gone == {o[0]: missing[o[0]] for o in orders if missing[o[0]] and (o[3] is None or o[3] < newest - timedelta(minutes=30))}
    assert {r["order_id"] for r in enrich.waiting_orders(spark, folder).collect()} == {k for k, m in missing.items() if m and k not in gone}


def test_an_empty_batch_tries_again(spark, tmp_path, rows):
    orders, users, products, frame = world(spark, 3, 40)
    folder = str(tmp_path)
    enrich.add_batch(frame(orders), 0, folder, *tables(spark, users[:1], products))
    before = enrich.enriched_orders(spark, folder).count()
    enrich.add_batch(frame(orders).limit(0), 1, folder, *tables(spark, users, products))
    assert enrich.enriched_orders(spark, folder).count() > before
    assert enrich.enriched_orders(spark, folder).where(F.col("user_gender").isNull() | F.col("category").isNull()).isEmpty()
