"""Purchase propensity and scenario weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed
from ordermill.functions import people, seeded
from ordermill.operators.joins import join_keyed


def base_points(age: Column, gender: Column, status: Column, marketing: Column, grade: Column) -> Column:
    d = fixed.POINTS_DEFAULT
    return (
        people.lookup(fixed.AGE_POINTS, people.age_band(age), d["age"])
        + people.lookup(fixed.GENDER_POINTS, gender, d["gender"])
        + people.lookup(fixed.STATUS_POINTS, status, d["status"])
        + people.lookup(fixed.MARKETING_POINTS, marketing, d["marketing"])
        + people.lookup(fixed.GRADE_POINTS, grade, d["grade"])
    ).cast("double")


def base_score(users: DataFrame) -> DataFrame:
    """Sum of age, gender, status, marketing and grade points, at most 100."""
    points = base_points(*[F.col(c) for c in ("age", "gender", "status", "marketing_agree", "grade")])
    return users.withColumn("base_score", points)


def hour_factor(band: Column, hour: Column | int) -> Column:
    """Activity of an age band at an hour; an unknown band acts like the default one, an unknown hour gives 1."""
    if isinstance(hour, int):
        if not 0 <= hour <= 23:
            return F.lit(1.0)
        at_hour = {name: row[hour] for name, row in fixed.HOUR_ACTIVITY.items()}
        return people.lookup(at_hour, band, at_hour[fixed.AGE_BAND_DEFAULT])
    rows = [x for name, row in fixed.HOUR_ACTIVITY.items() for x in (F.lit(name), F.array(*[F.lit(v) for v in row]))]
    default = F.array(*[F.lit(v) for v in fixed.HOUR_ACTIVITY[fixed.AGE_BAND_DEFAULT]])
    row = F.coalesce(F.try_element_at(F.create_map(*rows), band), default)
    return F.coalesce(F.get(row, hour), F.lit(1.0))


def time_variation(scored: DataFrame, hour: Column | int) -> DataFrame:
    """base_score times the activity of the customer's age band."""
    return scored.withColumn("hour_score", F.col("base_score") * hour_factor(people.age_band(F.col("age")), hour))


def marketing_factor(marketing: Column, key: Column, seed: int | None) -> Column:
    """Promotion boost: its mean without a seed, a reproducible draw with one."""
    if seed is None:
        boost = F.lit(1 + (fixed.PROMO_FACTOR - 1) * fixed.PROMO_PERCENT / 100)
        return F.when(marketing == "true", boost).otherwise(1.0)
    hit = (marketing == "true") & (seeded.percent(key, f"promo{seed}") < fixed.PROMO_PERCENT)
    return F.when(hit, fixed.PROMO_FACTOR).otherwise(1.0)


def life_event_factor(key: Column, seed: int | None) -> Column:
    shares, factors = fixed.LIFE_EVENT_PERCENT, fixed.LIFE_EVENT_FACTOR
    if seed is None:
        return F.lit(sum(s * f for s, f in zip(shares, factors)) / 100)
    draw = seeded.percent(key, f"event{seed}")
    return F.when(draw < shares[0], factors[0]).when(draw < shares[0] + shares[1], factors[1]).otherwise(factors[2])


def propensity_score(users: DataFrame, hour: Column | int, seed: int | None = None) -> DataFrame:
    """Base score x hour x promotion x life event; expected value unless a seed is given."""
    key = F.col("user_id")
    timed = time_variation(base_score(users), hour)
    score = F.col("hour_score") * marketing_factor(F.col("marketing_agree"), key, seed) * life_event_factor(key, seed)
    return timed.withColumn("propensity", score)


def top_buyers(users: DataFrame, n: int, hour: int, seed: int | None = None) -> DataFrame:
    return propensity_score(users, hour, seed).orderBy(F.desc("propensity"), "user_id").limit(n)


def _with_weight(
    rows: DataFrame, identity: str, weights: DataFrame, scenario: int, dim: str, key: Column, default: float, name: str
) -> DataFrame:
    """Adds the weight of ``key`` in one dimension of one scenario; ``weights`` is (scenario_id, dim, key, weight)."""
    chosen = weights.where((F.col("scenario_id") == scenario) & (F.col("dim") == dim))
    chosen = chosen.select(F.col("key").alias("_key"), F.col("weight").alias(name))
    joined = join_keyed(rows.withColumn("_key", key), chosen, "_key", "left", spread_by=[identity])
    return joined.withColumn(name, F.coalesce(name, F.lit(default))).drop("_key")


def scenario_user_weight(users: DataFrame, weights: DataFrame, scenario: int, live: bool = False) -> DataFrame:
    """Weight of a customer under a scenario, at least 0.1.

    Planned: propensity x gender weight / 50 x age weight / 20.  Live: gender weight x age weight.
    """
    known = _with_weight(users, "user_id", weights, scenario, "gender", F.coalesce("gender", F.lit("M")), 50.0, "_g")
    known = _with_weight(known, "user_id", weights, scenario, "age", people.age_band(F.col("age")), 20.0, "_a")
    g, a = F.col("_g"), F.col("_a")
    raw = g * a if live else F.col("propensity") * (g / 50) * (a / 20)
    return known.withColumn("weight", F.greatest(raw, F.lit(0.1))).drop("_g", "_a")


def _with_frequency(products: DataFrame, rules: DataFrame) -> DataFrame:
    frequency = rules.select("category", F.col("order_frequency").cast("double").alias("_f"))
    joined = join_keyed(products, frequency, "category", "left", spread_by=["product_id"])
    return joined.withColumn("_f", F.coalesce("_f", F.lit(float(fixed.DEFAULT_FREQUENCY))))


def scenario_product_weight(
    products: DataFrame, weights: DataFrame, rules: DataFrame, scenario: int, live: bool = False
) -> DataFrame:
    """Weight of a product, at least 0.1: category weight x order frequency / 10, or the category weight alone (live)."""
    if live:
        known = _with_weight(products, "product_id", weights, scenario, "category", F.col("category"), 1.0, "_c")
        return known.withColumn("weight", F.greatest("_c", F.lit(0.1))).drop("_c")
    known = _with_weight(products, "product_id", weights, scenario, "category", F.col("category"), 5.0, "_c")
    raw = F.col("_c") * (F.col("_f") / 10)
    return _with_frequency(known, rules).withColumn("weight", F.greatest(raw, F.lit(0.1))).drop("_c", "_f")


def frequency_weight(products: DataFrame, rules: DataFrame) -> DataFrame:
    """Weight by order frequency alone."""
    return _with_frequency(products, rules).withColumnRenamed("_f", "weight")


def residual_weights(overrides: DataFrame, categories: DataFrame) -> DataFrame:
    """Category weights per scenario: given ones stay, the others share what is left of 100.

    ``overrides`` is (scenario_id, category, weight), ``categories`` one column of distinct names; the
    list of names is a dimension and travels as one array per scenario.
    """
    per_scenario = overrides.groupBy("scenario_id").agg(
        F.sum("weight").alias("_given"),
        F.map_from_entries(F.collect_list(F.struct("category", F.col("weight").cast("double")))).alias("_weights"),
        F.collect_set("category").alias("_named"),
    )
    names = categories.agg(F.sort_array(F.collect_set("category"))).scalar()
    rest = F.greatest((100 - F.col("_given")).cast("double") / F.size(F.array_except("_all", "_named")), F.lit(0.5))
    return (
        per_scenario.withColumn("_all", names)
        .withColumn("_rest", F.when(F.size(F.array_except("_all", "_named")) > 0, F.bround(rest, 1)))
        .select("scenario_id", F.explode(F.array_union("_all", "_named")).alias("category"), "_weights", "_rest")
        .select("scenario_id", "category", F.coalesce(F.try_element_at("_weights", F.col("category")), F.col("_rest")).alias("weight"))
    )


def complete_category_weights(weights: DataFrame, categories: list[str] = fixed.CATEGORIES) -> DataFrame:
    """The long weight table with every category of every scenario: given weights stay, the rest is shared."""
    is_category = F.col("dim") == "category"
    given = weights.where(is_category).select("scenario_id", F.col("key").alias("category"), "weight")
    names = weights.sparkSession.createDataFrame([(c,) for c in categories], "category string")
    filled = residual_weights(given, names).select(
        "scenario_id", F.lit("category").alias("dim"), F.col("category").alias("key"), "weight"
    )
    return weights.where(~is_category).unionByName(filled)


def scenario_of_hour(hour: Column, default: int = 0) -> Column:
    return people.lookup(fixed.HOUR_SCENARIO, hour, default).cast("int")


def scenario_for_hour(scenarios: DataFrame, hours: DataFrame) -> DataFrame:
    """Settings in force per hour: weights of the hour's scenario, volume of the baseline.

    Only the night scenario brings its own volume.  ``scenarios`` has one row per scenario with
    ``weights`` (a map) and ``volume_min``/``volume_max``, and one given twice is an error; ``hours`` has a column ``hour``.
    """
    base = scenarios.where(F.col("scenario_id") == 0)
    weights, low, high = [base.select(c).scalar() for c in ("weights", "volume_min", "volume_max")]
    named = [0, *sorted(set(fixed.HOUR_SCENARIO.values()))]
    rows = scenarios.where(F.col("scenario_id").isin(named)).groupBy("scenario_id").agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in ("weights", "volume_min", "volume_max")])  # at most three rows
    twice = F.raise_error(F.concat(F.lit("a scenario must be given once; scenario "), F.col("scenario_id").cast("string"))).cast("int")
    settings = rows.where(F.when(F.col("_n") > 1, twice).otherwise(1) == 1).drop("_n")
    night = F.col("scenario_id") == fixed.NIGHT_SCENARIO
    return (
        hours.withColumn("scenario_id", scenario_of_hour(F.col("hour")))
        .join(F.broadcast(settings), "scenario_id", "left")
        .select(
            *hours.columns,
            "scenario_id",
            F.coalesce("weights", weights).alias("weights"),
            F.when(night, F.coalesce("volume_min", low)).otherwise(low).alias("volume_min"),
            F.when(night, F.coalesce("volume_max", high)).otherwise(high).alias("volume_max"),
        )
    )
