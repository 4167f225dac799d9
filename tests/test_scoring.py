import pytest
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed
from ordermill.functions import people
from ordermill.operators import scoring
from ordermill.sources import rules
import json


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(
        [("best", 35, "F", "ACTIVE", "true", "VIP"), ("teen", 19, "M", "DORMANT", "false", "BRONZE"), ("blank", None, None, None, None, None),
         ("zero", 0, "X", "GONE", "maybe", "?"), ("old", 50, "F", "ACTIVE", "true", "GOLD")],
        "user_id string, age int, gender string, status string, marketing_agree string, grade string",
    )


def test_base_score(users):
    got = {r["user_id"]: r["base_score"] for r in scoring.base_score(users).collect()}
    assert got == {
        "best": 25 + 15 + 20 + 15 + 25, "teen": 12 + 12 + 5 + 8 + 10, "blank": 25 + 12 + 10 + 8 + 10, "zero": 25 + 12 + 10 + 8 + 10,
        "old": 18 + 15 + 20 + 15 + 20,
    }
    assert max(got.values()) == 100


def test_age_labels(spark):
    ages = spark.createDataFrame([(a,) for a in (None, 0, 9, 19, 20, 49, 50, 64)], "age int")
    got = ages.select(people.age_decade(F.col("age")), people.age_band(F.col("age")), people.age_band(F.col("age"), zero_is_missing=False), people.payment_class(F.col("age"))).collect()
    assert [tuple(r) for r in got] == [
        ("Unknown", "30대", "30대", "40s"), ("Unknown", "30대", "10대", "40s"), ("0대", "10대", "10대", "1020"), ("10대", "10대", "10대", "1020"),
        ("20대", "20대", "20대", "1020"), ("40대", "40대", "40대", "40s"), ("50대", "50대이상", "50대이상", "50plus"), ("60대", "50대이상", "50대이상", "50plus"),
    ]


def test_hour_factor_by_literal_and_by_column(spark):
    bands = spark.createDataFrame([(b, h) for b in [*fixed.HOUR_ACTIVITY, "unknown"] for h in [0, 13, 23, 24]], "band string, hour int")
    for r in bands.select("band", "hour", scoring.hour_factor(F.col("band"), F.col("hour")).alias("f")).collect():
        row = fixed.HOUR_ACTIVITY.get(r["band"], fixed.HOUR_ACTIVITY["30대"])
        expected = row[r["hour"]] if r["hour"] < 24 else 1.0
        assert r["f"] == expected
        literal = bands.limit(1).select(scoring.hour_factor(F.lit(r["band"]), r["hour"])).first()[0]
        assert literal == expected


def test_expected_and_drawn_propensity(users, spark):
    row = scoring.propensity_score(users.where("user_id = 'best'"), 20).first()
    assert row["propensity"] == pytest.approx(100 * 1.8 * 1.06 * 1.12)
    many = spark.range(4000).select(
        F.col("id").alias("user_id"), F.lit(35).alias("age"), F.lit("F").alias("gender"), F.lit("ACTIVE").alias("status"),
        F.lit("true").alias("marketing_agree"), F.lit("VIP").alias("grade"),
    )
    mean = scoring.propensity_score(many, 20, seed=1).agg(F.avg("propensity")).first()[0]
    assert mean == pytest.approx(100 * 1.8 * 1.06 * 1.12, rel=0.05)


def test_residual_weights(spark):
    overrides = spark.createDataFrame([(1, "a", 30.0), (1, "b", 45.0), (2, "a", 99.0), (3, "a", 15.0), (4, "a", 50.0), (4, "b", 20.0), (4, "c", 10.0), (4, "d", 10.0), (4, "e", 10.0)], "scenario_id int, category string, weight double")
    categories = spark.createDataFrame([(c,) for c in "abcde"], "category string")
    got = {(r["scenario_id"], r["category"]): r["weight"] for r in scoring.residual_weights(overrides, categories).collect()}
    assert {c: got[1, c] for c in "abcde"} == {"a": 30.0, "b": 45.0, "c": 8.3, "d": 8.3, "e": 8.3}
    assert got[2, "b"] == 0.5  # never below one half
    assert got[3, "b"] == 21.2  # 21.25, rounded half to even
    assert [got[4, c] for c in "abcde"] == [50.0, 20.0, 10.0, 10.0, 10.0]


def document(spark):
    return spark.createDataFrame([(json.dumps(fixed.HOUR_SCENARIO_DOCUMENT, ensure_ascii=False),)], "value string")


def test_scenario_weights_and_hours(spark, users):
    long = rules.scenario_weights(document(spark))
    assert long.where("scenario_id = 17 AND dim = 'quantity'").orderBy("key").select("weight").rdd.flatMap(list).collect() == [40, 25, 20, 10, 5]
    live = {r["user_id"]: r["weight"] for r in scoring.scenario_user_weight(users, long, 17, live=True).collect()}
    assert live["best"] == 65 * 35 and live["teen"] == 35 * 5 and live["blank"] == 35 * 35 and live["zero"] == 50 * 35
    planned = scoring.scenario_user_weight(users.withColumn("propensity", F.lit(0.001)), long, 17)
    assert planned.agg(F.min("weight"), F.max("weight")).first() == (0.1, 0.1)
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    got = {r["hour"]: r for r in scoring.scenario_for_hour(rules.scenario_settings(document(spark)), hours).collect()}
    assert [got[h]["scenario_id"] for h in (0, 5, 6, 20, 21, 23)] == [19, 19, 0, 0, 17, 17]
    assert (got[3]["volume_min"], got[3]["volume_max"], got[22]["volume_min"], got[22]["volume_max"]) == (3, 15, 10, 50)
    assert got[22]["weights"]["gender:F"] == 65 and got[12]["weights"]["gender:F"] == 55


def test_product_weights(spark):
    products = spark.createDataFrame([("p1", "a"), ("p2", "b"), ("p3", None)], "product_id string, category string")
    weights = spark.createDataFrame([(1, "category", "a", 20.0)], "scenario_id int, dim string, key string, weight double")
    table = spark.createDataFrame([("a", 2)], "category string, order_frequency int")
    get = lambda df: {r["product_id"]: r["weight"] for r in df.collect()}
    assert get(scoring.scenario_product_weight(products, weights, table, 1)) == {"p1": 4.0, "p2": 5.0, "p3": 5.0}
    assert get(scoring.scenario_product_weight(products, weights, table, 1, live=True)) == {"p1": 20.0, "p2": 1.0, "p3": 1.0}
    assert get(scoring.frequency_weight(products, table)) == {"p1": 2.0, "p2": 10.0, "p3": 10.0}


def test_rules_defaults(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"common_prefixes": ["x"], "categories": {
        "a": {"price_min": 10, "price_max": 20, "order_frequency": 3, "quantity_options": [1, 2], "quantity_weights": [70, 30], "templates": ["{brand}"], "keywords": {"brand": ["z"]}},
        "b": {}}}, indent=2), encoding="utf-8")
    got = {r["category"]: r for r in rules.load_rules_dim(spark, str(path)).collect()}
    assert got["a"]["order_frequency"] == 3 and got["a"]["quantity_options"] == [1, 2]
    assert got["b"]["order_frequency"] == 10 and got["b"]["quantity_weights"] == [80, 10, 5, 3, 2]
    choices = rules.quantity_choices(rules.load_rules_dim(spark, str(path)))
    assert choices.count() == 7


def test_scenarios_are_completed_to_all_categories(spark):
    full = scoring.complete_category_weights(rules.scenario_weights(document(spark)))
    got = {(r["scenario_id"], r["key"]): r["weight"] for r in full.where("dim = 'category'").collect()}
    assert len(got) == 3 * len(fixed.CATEGORIES)
    assert got[17, "육류/가공"] == 25 and got[17, "골프"] == 1.8  # (100 - 73) / 15
    assert got[0, "영양제"] == 6
    settings = {r["scenario_id"]: r["weights"] for r in rules.scenario_settings(document(spark), weights=full).collect()}
    assert settings[17]["category:골프"] == 1.8 and settings[17]["gender:M"] == 35


@pytest.mark.parametrize("scenario", [17, 19])
def test_a_scenario_given_twice_is_an_error_for_hours(spark, scenario):
    settings = rules.scenario_settings(document(spark))
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    with pytest.raises(Exception, match=f"given once; scenario {scenario}"):
        scoring.scenario_for_hour(settings.union(settings.where(F.col("scenario_id") == scenario)), hours).collect()
