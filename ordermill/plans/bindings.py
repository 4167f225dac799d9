"""The star-schema test tables seen as customers, products, orders, order lines and order events.

Every method is lazy and selects only what it names, so scans read only the columns a query uses.
The SQL constants state the same views for the oracle queries.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions import money, seeded
from ordermill.operators import ingest
from ordermill.operators.joins import join_keyed

# First day from which on a customer or product counts as not ordered yet.
USER_CUT = "1995-06-01"
PRODUCT_CUT = "1995-02-01"
SEED = 42


# Columns of the test tables; a given schema spares each read the look into a file.
RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def u32(key: str, seed: int | str = SEED) -> str:
    """``seeded.draw32`` in SQL."""
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 8) AS BIGINT)"


# Columns that tell order lines apart; an order may repeat a line number.
LINE_IDENTITY = ["order_id", "line", "product_id"]


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        status = (
            F.when(F.col("o_orderstatus") == "F", "Success").when(F.col("o_orderstatus") == "O", "Pending").otherwise("Cancelled")
        )
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_custkey").alias("user_id"),
            money.money(F.col("o_totalprice")).alias("total_amount"),
            status.alias("status"),
            F.col("o_orderpriority").alias("payment_method"),
        )

    @cached_property
    def users(self) -> DataFrame:
        key, balance = F.col("c_custkey"), F.col("c_acctbal")
        place = self.raw("nation").join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return (
            self.raw("customer")
            .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                key.alias("user_id"),
                F.col("c_name").alias("name"),
                F.concat(F.lit("c"), key.cast("string"), F.lit("@mail")).alias("email"),
                F.when(key % 17 != 0, 15 + key % 50).cast("int").alias("age"),
                F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
                F.when(key % 19 != 0, F.concat("n_name", F.lit(" "), "c_mktsegment")).alias("address"),
                F.col("r_name").alias("address_district"),
                F.when(balance < 0, "BRONZE").when(balance < 3000, "SILVER").when(balance < 7000, "GOLD").otherwise("VIP").alias("grade"),
                F.when(key % 5 == 0, "DORMANT").otherwise("ACTIVE").alias("status"),
                F.when(key % 3 == 0, "true").otherwise("false").alias("marketing_agree"),
                money.money(balance).alias("balance"),
                F.date_add(F.lit("1992-01-01").cast("date"), (key % 1000).cast("int")).alias("created_at"),
                seeded.uniform(key, SEED).alias("random_seed"),
            )
        )

    @cached_property
    def users_at_cut(self) -> DataFrame:
        """Customers with last_ordered_at as of USER_CUT."""
        early = self.orders.where(F.col("created_at") < USER_CUT)
        return ingest.maintain_last_ordered(self.users.withColumn("last_ordered_at", F.lit(None).cast("timestamp_ntz")), early)

    @cached_property
    def products(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        return self.raw("part").select(
            key.alias("product_id"),
            F.col("p_type").alias("category"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("brand"),
            money.money(F.col("p_retailprice")).alias("price"),
            (900 + 2 * size).cast("decimal(18,2)").alias("org_price"),
            ((size % 21) / F.lit(20.0) - F.lit(0.05)).alias("discount_rate"),
            (size - 5).alias("stock"),
            (F.lit(3.0) + (key % 21) / F.lit(10.0)).alias("rating"),
            (key * 7 % 2500).alias("review_count"),
            F.date_add(F.lit("1994-01-01").cast("date"), (key % 365).cast("int")).alias("created_at"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines as shipped; the shipping day is their moment."""
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            money.money(F.col("l_extendedprice")).alias("total_amount"),
            F.col("l_shipdate").alias("created_at"),
        )

    @cached_property
    def products_at_cut(self) -> DataFrame:
        """Products with order_count as of PRODUCT_CUT."""
        early = self.lines.where(F.col("created_at") < PRODUCT_CUT)
        return ingest.maintain_order_count(self.products.withColumn("order_count", F.lit(0).cast("bigint")), early)

    def lines_with(self, *order_columns: str) -> DataFrame:
        """Lines with columns of their order; an order with very many lines is spread."""
        kept = self.lines.drop("created_at") if "created_at" in order_columns else self.lines
        return join_keyed(kept, self.orders.select("order_id", *order_columns), "order_id", spread_by=["line", "product_id"])

    def lines_by_category(self, *order_columns: str) -> DataFrame:
        """Lines with columns of their order and the category of their product."""
        category = self.products.select("product_id", "category")
        return join_keyed(self.lines_with(*order_columns), category, "product_id", spread_by=["order_id", "line"])

    @cached_property
    def events(self) -> DataFrame:
        return order_events(self.raw("events"))


def order_events(events: DataFrame) -> DataFrame:
    """Click-stream events as orders; works on a table and on a stream."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.col("event_id").alias("order_id"),
        F.col("ts").alias("created_at"),
        "user_id",
        F.col("event_type").alias("category"),
        k.alias("quantity"),
        money.money(F.col("value")).alias("total_amount"),
        F.concat(F.lit("P"), (k % 4).cast("string")).alias("payment_method"),
        F.concat(F.lit("G"), (F.col("user_id") % 5).cast("string")).alias("user_age_group"),
    )


ORDERS = """orders_v AS (
  SELECT o_orderkey AS order_id, o_orderdate AS created_at, o_custkey AS user_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
         CASE o_orderstatus WHEN 'F' THEN 'Success' WHEN 'O' THEN 'Pending' ELSE 'Cancelled' END AS status,
         o_orderpriority AS payment_method
  FROM orders)"""

USERS = f"""users_v AS (
  SELECT c_custkey AS user_id, c_name AS name, 'c' || c_custkey || '@mail' AS email,
         CASE WHEN c_custkey % 17 <> 0 THEN 15 + c_custkey % 50 END AS age,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN c_custkey % 19 <> 0 THEN n_name || ' ' || c_mktsegment END AS address,
         r_name AS address_district,
         CASE WHEN c_acctbal < 0 THEN 'BRONZE' WHEN c_acctbal < 3000 THEN 'SILVER' WHEN c_acctbal < 7000 THEN 'GOLD' ELSE 'VIP' END AS grade,
         CASE WHEN c_custkey % 5 = 0 THEN 'DORMANT' ELSE 'ACTIVE' END AS status,
         CASE WHEN c_custkey % 3 = 0 THEN 'true' ELSE 'false' END AS marketing_agree,
         CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
         CAST(DATE '1992-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS DATE) AS created_at,
         {u32('c_custkey')} / 4294967296.0::DOUBLE AS random_seed,
         (SELECT max(o_orderdate) FROM orders WHERE o_custkey = c_custkey AND o_orderdate < TIMESTAMP '{USER_CUT}') AS last_ordered_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

PRODUCTS = f"""products_v AS (
  SELECT p_partkey AS product_id, p_type AS category, p_name AS name, p_brand AS brand,
         CAST(p_retailprice AS DECIMAL(18,2)) AS price, CAST(900 + 2 * p_size AS DECIMAL(18,2)) AS org_price,
         (p_size % 21) / 20.0::DOUBLE - 0.05::DOUBLE AS discount_rate, p_size - 5 AS stock,
         3.0::DOUBLE + (p_partkey % 21) / 10.0::DOUBLE AS rating, p_partkey * 7 % 2500 AS review_count,
         CAST(DATE '1994-01-01' + CAST(p_partkey % 365 AS INTEGER) AS DATE) AS created_at,
         (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey AND l_shipdate < TIMESTAMP '{PRODUCT_CUT}') AS order_count
  FROM part)"""

LINES = """lines_v AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS total_amount, l_shipdate AS created_at
  FROM lineitem)"""

EVENTS = """events_v AS (
  SELECT event_id AS order_id, ts AS created_at, user_id, event_type AS category,
         CAST(props->>'$.k' AS INTEGER) AS quantity, CAST(value AS DECIMAL(18,2)) AS total_amount,
         'P' || (CAST(props->>'$.k' AS INTEGER) % 4) AS payment_method, 'G' || (user_id % 5) AS user_age_group
  FROM events)"""


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views)
