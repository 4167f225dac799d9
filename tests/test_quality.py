from datetime import datetime, timedelta

from ordermill.operators import quality, sales

NOW = datetime(2025, 5, 1, 12)


def orders(spark):
    return spark.createDataFrame(
        [(1, -1, NOW), (2, 0, NOW), (3, 9_999_999, NOW), (4, 10_000_000, NOW - timedelta(minutes=10)), (5, 10_000_000, NOW - timedelta(minutes=11))],
        "order_id int, total_amount int, created_at timestamp_ntz",
    )


def products(spark):
    return spark.createDataFrame(
        [("null", None, 100, None, 1), ("same", 100, 100, 0.0, 0), ("below", 100, 90, -0.01, -3), ("top", 100, 90, 100.0, 5), ("over", 100, 90, 100.01, 5), ("dear", 100, 101, 0.0, 5)],
        "product_id string, org_price int, price int, discount_rate double, stock int",
    ).selectExpr("*", "product_id AS name")


def test_integrity_has_three_valued_logic(spark):
    ids = lambda df: {r["product_id"] for r in df.collect()}
    assert ids(quality.integrity_errors(products(spark))) == {"below", "over", "dear"}
    assert ids(quality.integrity_errors(products(spark), max_rate=1.0)) == {"below", "top", "over", "dear"}


def test_stockouts_and_abnormal_orders(spark):
    assert [r["stock"] for r in quality.stockout_list(products(spark)).collect()] == [-3, 0]
    assert [r["order_id"] for r in quality.abnormal_orders(orders(spark)).collect()] == [1, 4, 5]
    assert quality.abnormal_orders(orders(spark), k=1).first()["ordered_at"] == "2025-05-01 12:00:00"
    assert quality.abnormal_recent(orders(spark), NOW).first()[0] == 2


def test_alert_levels(spark):
    counts = quality.alert_counts(products(spark), orders(spark))
    assert {r["alert"]: (r["alerts"], r["level"]) for r in quality.alert_level(counts).collect()} == {
        "stockout": (2, "yellow"), "integrity": (3, "red"), "abnormal": (3, "yellow")
    }
    none = spark.createDataFrame([("stockout", 0), ("integrity", 0), ("abnormal", 5)], "alert string, alerts int")
    assert [r["level"] for r in quality.alert_level(none).collect()] == ["green", "green", "red"]


def test_key_checks(spark):
    users = spark.createDataFrame([("u1",), ("u1",), ("u2",)], "user_id string")
    goods = spark.createDataFrame([("p1",)], "product_id string")
    placed = spark.createDataFrame([(1, "u1", "p1"), (1, "zz", "p1"), (2, "zz", "qq"), (3, None, "rr")], "order_id int, user_id string, product_id string")
    got = {r["rule"]: r["violations"] for r in quality.fk_pk_checks(users, goods, placed).collect()}
    assert got == {"pk:users": 1, "pk:products": 0, "pk:orders": 1, "fk:orders.user_id": 1, "fk:orders.product_id": 2}


def test_gender_counts_skip_unknowns(spark, rows):
    data = [("a", "M", "Success"), ("a", "F", "Success"), ("a", "X", "Success"), ("a", None, "Success"), (None, "M", "Success"), ("b", "M", "Cancelled"), ("c", "X", "Success")]
    df = spark.createDataFrame(data, "category string, user_gender string, status string")
    assert rows(sales.gender_category_topk(df)) == [("a", 1, 1), ("c", 0, 0)]


def test_shares_and_regions(spark, rows):
    df = spark.createDataFrame([("Card", NOW)] * 2 + [("Bank", NOW)], "payment_method string, created_at timestamp_ntz")
    assert rows(sales.share_of_count(df, "payment_method")) == [("Bank", 33.3), ("Card", 66.7)]
    placed = spark.createDataFrame([(1, "u1", 5), (2, "u1", 6), (3, "u2", 7), (4, "gone", 8)], "order_id int, user_id string, total_amount int")
    users = spark.createDataFrame([("u1", "서울"), ("u2", "달")], "user_id string, address_district string")
    assert rows(sales.region_orders(placed, users)) == [("달", 1, None, None), ("서울", 2, 37.5665, 126.978)]
    assert rows(sales.region_revenue(placed, users)) == [("달", 7, None, None), ("서울", 11, 37.5665, 126.978)]


def test_payment_by_age(spark, rows):
    df = spark.createDataFrame([("20대", "Card"), ("20대", "Bank"), ("20대", "Card"), ("30대", "Cash")], "user_age_group string, payment_method string")
    assert rows(sales.payment_by_age(df)) == [("20대", 2, 0, 0, 1), ("30대", 0, 0, 0, 0)]
