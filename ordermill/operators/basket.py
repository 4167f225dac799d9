"""Baskets, co-purchases and order rows joined with their customer and product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed
from ordermill.functions import checks, money, people, times
from ordermill.operators.joins import join_each


def category_copurchase(orders: DataFrame, min_users: int = 5, k: int = 20) -> DataFrame:
    """Category pairs bought by the same customers, most common first.

    A pair has no more customers than either of its categories, so categories with fewer than ``min_users`` go first.
    What is left of a customer is a set of frequent categories; equal sets become one counted row, and only then are
    pairs formed.  Their number depends on how many different sets of frequent categories exist.
    """
    bought = orders.where((F.col("status") == fixed.SUCCESS) & F.col("category").isNotNull() & F.col("user_id").isNotNull()).select("user_id", "category").distinct()
    frequent = bought.groupBy("category").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_users).select("category")
    sets = (
        bought.join(frequent, "category", "left_semi")
        .groupBy("user_id")
        .agg(F.collect_list("category").alias("categories"))
        .where(F.size("categories") > 1)
        .groupBy(F.sort_array("categories").alias("categories"))
        .agg(F.count(F.lit(1)).alias("users"))
    )
    first = sets.select("categories", "users", F.posexplode("categories").alias("at", "a"))
    pairs = first.select("users", "a", F.explode(F.slice("categories", F.col("at") + 2, F.size("categories"))).alias("b"))
    return (
        pairs.groupBy("a", "b")
        .agg(F.sum("users").alias("customers"))
        .where(F.col("customers") >= min_users)
        .select(F.concat(F.col("a"), F.lit(" + "), F.col("b")).alias("category_pair"), "customers")
        .orderBy(F.desc("customers"), "category_pair")
        .limit(k)
    )


def basket_sizes(lines: DataFrame) -> DataFrame:
    """How many baskets have how many lines; a basket shares customer and moment."""
    return (
        lines.groupBy("user_id", "created_at")
        .agg(F.count(F.lit(1)).alias("basket_size"))
        .groupBy("basket_size")
        .agg(F.count(F.lit(1)).alias("baskets"))
        .orderBy("basket_size")
    )


def basket_size_shares(sizes: DataFrame) -> DataFrame:
    """Actual against planned share of each basket size, in percent."""
    total = sizes.agg(F.sum("baskets")).scalar()
    planned = people.lookup(dict(enumerate(fixed.BASKET_SIZE_WEIGHTS, start=1)), F.col("basket_size").cast("int"), 0)
    return sizes.select(
        "basket_size",
        F.round(F.col("baskets") * 100.0 / total, 1).cast("double").alias("actual_share"),
        planned.cast("double").alias("planned_share"),
    )


def mean_basket_size(sizes: DataFrame) -> DataFrame:
    return sizes.agg(
        (F.sum(F.col("basket_size") * F.col("baskets")).cast("double") / F.sum("baskets")).alias("mean_basket_size")
    )


LABELS = {"category": "_category", "user_region": "_region", "user_gender": "_gender", "user_age_group": "_age_group"}


def customer_labels(users: DataFrame, region: Column | None = None, age_group: Column | None = None) -> DataFrame:
    """What an order carries of its customer, once per customer."""
    return users.select(
        "user_id",
        (people.first_region(F.col("address")) if region is None else region).alias("_region"),
        F.col("gender").alias("_gender"),
        (people.age_decade(F.col("age")) if age_group is None else age_group).alias("_age_group"),
    )


def product_labels(products: DataFrame) -> DataFrame:
    return products.select("product_id", F.col("category").alias("_category"))


def with_labels(joined: DataFrame, columns: list[str]) -> DataFrame:
    """Orders (``columns``) joined with both kinds of labels as rows that carry them; what they carry already stays."""
    filled = {c: F.coalesce(F.col(c), F.col(label)) if c in columns else F.col(label) for c, label in LABELS.items()}
    return joined.withColumns(filled).select(*columns, *[c for c in filled if c not in columns])


def denormalise_orders(
    orders: DataFrame,
    users: DataFrame,
    products: DataFrame,
    identity: list[str] = ["order_id"],
    region: Column | None = None,
    age_group: Column | None = None,
    **sizes: int,
) -> DataFrame:
    """Orders with category, region, gender and age group of their customer and product.

    ``identity`` names the columns that tell orders apart, see ``joins.join_each``.  ``region`` and
    ``age_group`` are expressions on the customer; by default the first word of the address and the
    decade of the age, and for instance ``address_district`` and ``people.age_band`` instead.

    Labels are made on the customer side, once per customer and not once per order.
    """
    who, what = customer_labels(users, region, age_group), product_labels(products)
    joined = join_each(orders, {"user_id": who, "product_id": what}, spread_by=identity, **sizes)
    return with_labels(joined, orders.columns)


def reject_orphans(
    orders: DataFrame, users: DataFrame, products: DataFrame, identity: list[str] = ["order_id"], **sizes: int
) -> DataFrame:
    """Orders whose customer or product is missing, with the reason."""
    known_user = users.select("user_id", F.lit(True).alias("_user"))
    known_product = products.select("product_id", F.lit(True).alias("_product"))
    checked = join_each(orders, {"user_id": known_user, "product_id": known_product}, "left", identity, **sizes)
    no_user, no_product = F.col("_user").isNull(), F.col("_product").isNull()
    return (
        checked.where(no_user | no_product)
        .withColumn(
            "reason",
            F.when(no_user & no_product, "user and product not found")
            .when(no_user, "user not found")
            .otherwise("product not found"),
        )
        .select(*orders.columns, "reason")
    )


def abnormal_order_detail(orders: DataFrame, users: DataFrame, limit: float = fixed.ABNORMAL_AMOUNT, k: int = 100) -> DataFrame:
    """Newest abnormal orders with the buyer's name, kept when the buyer is unknown.

    The k rows are chosen before the join, so the customer table is only probed for them.
    """
    newest = (
        orders.where(checks.abnormal_amount(F.col("total_amount"), limit))
        .select("order_id", "user_id", "total_amount", "created_at")
        .orderBy(F.col("created_at").desc_nulls_first(), "order_id")
        .limit(k)
    )
    buyers = users.select("user_id", "name").join(F.broadcast(newest.select("user_id").distinct()), "user_id", "left_semi")
    return (
        newest.join(F.broadcast(buyers), "user_id", "left")
        .orderBy(F.col("created_at").desc_nulls_first(), "order_id")
        .select("order_id", F.col("name").alias("buyer"), "total_amount", times.clock_text(F.col("created_at")).alias("ordered_at"))
    )


def order_amounts(lines: DataFrame) -> DataFrame:
    """total_amount from price, quantity, shipping_cost and discount_amount."""
    amount = money.order_amount(F.col("price"), F.col("quantity"), F.col("shipping_cost"), F.col("discount_amount"))
    return lines.withColumn("total_amount", amount)


def product_derivations(products: DataFrame) -> DataFrame:
    """discount_rate, is_best and the price floored to hundreds."""
    best = (F.col("review_count") > 1000) & (F.col("rating") > 4.5)
    return products.withColumns({
        "discount_rate": money.discount_rate(F.col("org_price"), F.col("price")),
        "is_best": F.when(best, "Y").otherwise("N"),
        "price_floor": money.floor_to_hundred(F.col("price")),
    })
