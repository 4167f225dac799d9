"""Category rules and demand scenarios, read from their JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed

RULES_SCHEMA = """
    categories map<string, struct<
        price_min: int, price_max: int, order_frequency: int,
        quantity_options: array<int>, quantity_weights: array<int>,
        templates: array<string>, keywords: map<string, array<string>>>>
"""
SCENARIO_SCHEMA = """
    map<string, struct<
        gender_weights: map<string, double>, age_group_weights: map<string, double>,
        category_weights: map<string, double>, quantity_weights: array<double>,
        order_volume: struct<min: int, max: int>>>
"""


def document(spark: SparkSession, path: str) -> DataFrame:
    """A JSON file as one text row."""
    return spark.read.text(path, wholetext=True)


def _ints(values: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def rules_dim(documents: DataFrame, value: str = "value") -> DataFrame:
    """One row per category, missing settings replaced by the defaults."""
    rules = documents.select(F.explode(F.from_json(value, RULES_SCHEMA)["categories"]).alias("category", "r"))
    return rules.select(
        "category",
        F.col("r.price_min").alias("price_min"),
        F.col("r.price_max").alias("price_max"),
        F.coalesce("r.order_frequency", F.lit(fixed.DEFAULT_FREQUENCY)).alias("order_frequency"),
        F.coalesce("r.quantity_options", _ints(fixed.DEFAULT_QUANTITIES)).alias("quantity_options"),
        F.coalesce("r.quantity_weights", _ints(fixed.DEFAULT_QUANTITY_WEIGHTS)).alias("quantity_weights"),
    )


def load_rules_dim(spark: SparkSession, path: str) -> DataFrame:
    return rules_dim(document(spark, path))


def quantity_choices(rules: DataFrame) -> DataFrame:
    """(category, position, quantity, weight), one row per quantity a category allows."""
    return rules.select(
        "category", F.posexplode(F.arrays_zip("quantity_options", "quantity_weights")).alias("position", "z")
    ).select("category", "position", F.col("z.quantity_options").alias("quantity"), F.col("z.quantity_weights").alias("weight"))


def _parsed_scenarios(documents: DataFrame, value: str) -> DataFrame:
    parsed = documents.select(F.explode(F.from_json(value, SCENARIO_SCHEMA)).alias("id", "s"))
    return parsed.select(F.col("id").cast("int").alias("scenario_id"), "s")


def scenario_weights(documents: DataFrame, value: str = "value") -> DataFrame:
    """Long form (scenario_id, dim, key, weight) with dims gender, age, category and quantity."""
    scenarios = _parsed_scenarios(documents, value)
    by_quantity = F.transform("s.quantity_weights", lambda w, i: F.struct((i + 1).cast("string").alias("key"), w.alias("value")))
    entries = [
        ("gender", F.map_entries("s.gender_weights")),
        ("age", F.map_entries("s.age_group_weights")),
        ("category", F.map_entries("s.category_weights")),
        ("quantity", by_quantity),
    ]

    def tagged(dim: str, pairs: Column) -> Column:
        none = F.array().cast("array<struct<key:string,value:double>>")
        row = lambda x: F.struct(F.lit(dim).alias("dim"), x["key"].alias("key"), x["value"].alias("weight"))
        return F.transform(F.coalesce(pairs, none), row)

    return scenarios.select("scenario_id", F.inline(F.concat(*[tagged(dim, pairs) for dim, pairs in entries])))


def scenario_settings(documents: DataFrame, value: str = "value", weights: DataFrame | None = None) -> DataFrame:
    """One row per scenario: weights as one map ("dim:key" -> weight) and the order volume.

    ``weights`` replaces the table read from the documents, for instance by the completed one.
    """
    long = scenario_weights(documents, value) if weights is None else weights
    volume = _parsed_scenarios(documents, value).select(
        "scenario_id", F.col("s.order_volume.min").alias("volume_min"), F.col("s.order_volume.max").alias("volume_max")
    )
    named = F.struct(F.concat_ws(":", "dim", "key").alias("key"), F.col("weight").alias("value"))
    maps = long.groupBy("scenario_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(named))).alias("weights")
    )
    return maps.join(volume, "scenario_id")
