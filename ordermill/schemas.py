"""Logical schemas of the tables and of the event payloads."""

from pyspark.sql import types as T

USERS = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("birth_year", T.IntegerType()),
    T.StructField("address", T.StringType()),
    T.StructField("address_district", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("grade", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("last_login_at", T.TimestampType()),
    T.StructField("marketing_agree", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("last_ordered_at", T.TimestampType()),
    T.StructField("random_seed", T.DoubleType()),
    T.StructField("created_datetime", T.TimestampType()),
    T.StructField("updated_datetime", T.TimestampType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("category", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("org_price", T.IntegerType()),
    T.StructField("price", T.IntegerType()),
    T.StructField("discount_rate", T.DoubleType()),
    T.StructField("description", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("stock", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("review_count", T.IntegerType()),
    T.StructField("is_best", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("order_count", T.IntegerType()),
    T.StructField("created_datetime", T.TimestampType()),
    T.StructField("updated_datetime", T.TimestampType()),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("total_amount", T.IntegerType()),
    T.StructField("shipping_cost", T.IntegerType()),
    T.StructField("discount_amount", T.IntegerType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("user_region", T.StringType()),
    T.StructField("user_gender", T.StringType()),
    T.StructField("user_age_group", T.StringType()),
    T.StructField("created_datetime", T.TimestampType()),
    T.StructField("updated_datetime", T.TimestampType()),
])

# The part of an order that the live statistics read.
ORDER_EVENT = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("total_amount", T.IntegerType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("user_region", T.StringType()),
    T.StructField("user_age_group", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])


def required_key(schema: T.StructType) -> str:
    """The first column of every table schema is its primary key."""
    return schema.fields[0].name
