from datetime import datetime

from ordermill.operators import ingest

T = [datetime(2025, 1, 1, h) for h in range(6)]


def test_first_copy_wins_and_known_keys_stay_out(spark, rows):
    arrivals = spark.createDataFrame([("a", 2, "late"), ("a", 1, "first"), ("b", 5, "x"), ("c", 3, None), ("c", 4, "y")], "id string, at int, v string")
    assert rows(ingest.first_arrivals(arrivals, ["id"], ["at"])) == [("a", 1, "first"), ("b", 5, "x"), ("c", 3, None)]
    target = spark.createDataFrame([("b",), ("z",)], "id string")
    assert rows(ingest.insert_if_absent(arrivals, ["id"], ["at"], target)) == [("a", 1, "first"), ("c", 3, None)]


def test_counters(spark, rows):
    users = spark.createDataFrame([("u1", T[3]), ("u2", None), ("u3", None)], "user_id string, last_ordered_at timestamp_ntz")
    orders = spark.createDataFrame([("u1", "p1", T[2]), ("u2", "p1", T[5]), ("u2", "p2", T[4])], "user_id string, product_id string, created_at timestamp_ntz")
    assert rows(ingest.maintain_last_ordered(users, orders)) == [("u1", T[3]), ("u2", T[5]), ("u3", None)]
    products = spark.createDataFrame([("p1", 5), ("p2", None), ("p3", None)], "product_id string, order_count int")
    assert rows(ingest.maintain_order_count(products, orders)) == [("p1", 7), ("p2", 1), ("p3", None)]


def test_merge_snapshot(spark, rows):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, name string, n int")
    changes = spark.createDataFrame([(2, None, 21), (3, "c", 30)], "id int, name string, n int")
    assert rows(ingest.merge_snapshot(old, changes, "id")) == [(1, "a", 10), (2, "b", 21), (3, "c", 30)]
    partial = spark.createDataFrame([(1, 11)], "id int, n int")
    assert rows(ingest.merge_snapshot(old, partial, "id")) == [(1, "a", 11), (2, "b", 20)]


def test_normalise_types(spark):
    raw = spark.createDataFrame(
        [(True, "2025-01-01T03:00:00", None), (False, "not a time", "2025-01-01T01:00:00.5")], "marketing_agree boolean, last_login_at string, created_at string"
    )
    got = [tuple(r) for r in ingest.normalise_types(raw, "2025-02-01").collect()]
    assert got == [("true", T[3], datetime(2025, 2, 1)), ("false", None, datetime(2025, 1, 1, 1, 0, 0, 500000))]
    broken = spark.createDataFrame([("never",), (None,)], "created_at string")
    assert [r[0] for r in ingest.normalise_types(broken, "2025-02-01").collect()] == [None, datetime(2025, 2, 1)]
