"""Scoring, sampling and planning queries on the test tables."""

import json

from pyspark.sql import functions as F

from ordermill import fixed_values as fixed
from ordermill.functions import people, times
from ordermill.operators import planning, sampling, scoring
from ordermill.operators.joins import join_keyed
from ordermill.plans.bindings import ORDERS, PRODUCTS, SEED, USERS, Tables, u32, with_views
from ordermill.plans.registry import query
from ordermill.sources import rules

HOUR = 20
BAND = "CASE WHEN age IS NULL OR age = 0 THEN '30대' WHEN age < 20 THEN '10대' WHEN age < 30 THEN '20대' WHEN age < 40 THEN '30대' WHEN age < 50 THEN '40대' ELSE '50대이상' END"


def case(column: str, table: dict, default) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in table.items()) + f" ELSE {default} END"


d = fixed.POINTS_DEFAULT
SCORED = f"""scored AS (SELECT *, CAST({case(BAND, fixed.AGE_POINTS, d['age'])} + {case('gender', fixed.GENDER_POINTS, d['gender'])}
    + {case('status', fixed.STATUS_POINTS, d['status'])} + {case('marketing_agree', fixed.MARKETING_POINTS, d['marketing'])}
    + {case('grade', fixed.GRADE_POINTS, d['grade'])} AS DOUBLE) AS base_score, {BAND} AS band FROM users_v)"""
ACTIVITY = "activity(band, hour, factor) AS (VALUES " + ", ".join(
    f"('{band}', {h}, {v}::DOUBLE)" for band, row in fixed.HOUR_ACTIVITY.items() for h, v in enumerate(row)
) + ")"
PROPENSITY = f"""scored_p AS (SELECT s.*, base_score * factor
      * (CASE WHEN marketing_agree = 'true' THEN {1 + (fixed.PROMO_FACTOR - 1) * fixed.PROMO_PERCENT / 100!r}::DOUBLE ELSE 1.0::DOUBLE END)
      * {sum(s * f for s, f in zip(fixed.LIFE_EVENT_PERCENT, fixed.LIFE_EVENT_FACTOR)) / 100!r}::DOUBLE AS propensity
    FROM scored s JOIN activity a ON a.band = s.band AND a.hour = {HOUR})"""

query("propensity_base", f"{with_views(USERS, SCORED)} SELECT user_id, base_score FROM scored")(
    lambda t: scoring.base_score(t.users).select("user_id", "base_score")
)
query(
    "propensity_by_hour",
    f"{with_views(USERS, SCORED, ACTIVITY)} SELECT user_id, hour, base_score * factor AS hour_score FROM scored JOIN activity USING (band)",
)(
    lambda t: scoring.time_variation(
        scoring.base_score(t.users).withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23)))), F.col("hour")
    ).select("user_id", "hour", "hour_score")
)
query("propensity_score", f"{with_views(USERS, SCORED, ACTIVITY, PROPENSITY)} SELECT user_id, propensity FROM scored_p")(
    lambda t: scoring.propensity_score(t.users, HOUR).select("user_id", "propensity")
)
query(
    "propensity_score_drawn",
    f"""{with_views(USERS, SCORED, ACTIVITY)}, u AS (SELECT *, {u32('user_id', f'event{SEED}')} % 100 AS e, {u32('user_id', f'promo{SEED}')} % 100 AS m FROM scored)
        SELECT user_id, base_score * factor * (CASE WHEN marketing_agree = 'true' AND m < 20 THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END)
        * (CASE WHEN e < 85 THEN 1.0::DOUBLE WHEN e < 97 THEN 1.5::DOUBLE ELSE 3.0::DOUBLE END) AS propensity
        FROM u JOIN activity a ON a.band = u.band AND a.hour = {HOUR}""",
)(lambda t: scoring.propensity_score(t.users, HOUR, seed=SEED).select("user_id", "propensity"))
query(
    "top_buyers",
    f"{with_views(USERS, SCORED, ACTIVITY, PROPENSITY)} SELECT user_id, propensity FROM scored_p ORDER BY propensity DESC, user_id LIMIT 100",
)(lambda t: scoring.top_buyers(t.users, 100, HOUR).select("user_id", "propensity"))


def scenario_document(t: Tables):
    return t.spark.createDataFrame([(json.dumps(fixed.HOUR_SCENARIO_DOCUMENT, ensure_ascii=False),)], "value string")


LATE = fixed.HOUR_SCENARIO_DOCUMENT[str(fixed.LATE_SCENARIO)]
GENDER_W = case("gender", {k: f"{v}.0::DOUBLE" for k, v in LATE["gender_weights"].items()}, "50.0::DOUBLE")
AGE_W = case("band", {k: f"{v}.0::DOUBLE" for k, v in LATE["age_group_weights"].items()}, "20.0::DOUBLE")
query(
    "scenario_user_weight",
    f"""{with_views(USERS, SCORED, ACTIVITY, PROPENSITY)} SELECT user_id,
        greatest(propensity * (({GENDER_W}) / 50) * (({AGE_W}) / 20), 0.1::DOUBLE) AS weight FROM scored_p""",
)(
    lambda t: scoring.scenario_user_weight(
        scoring.propensity_score(t.users, HOUR), rules.scenario_weights(scenario_document(t)), fixed.LATE_SCENARIO
    ).select("user_id", "weight")
)
query(
    "scenario_user_weight_live",
    f"{with_views(USERS, SCORED)} SELECT user_id, greatest(({GENDER_W}) * ({AGE_W}), 0.1::DOUBLE) AS weight FROM scored",
)(
    lambda t: scoring.scenario_user_weight(
        t.users, rules.scenario_weights(scenario_document(t)), fixed.LATE_SCENARIO, live=True
    ).select("user_id", "weight")
)


# Rules and category weights that the parts themselves imply.
def rules_document(t: Tables):
    """Category rules drawn from the parts, as the JSON document a caller would supply."""
    per_category = t.products.groupBy("category").agg(
        F.min("stock").alias("price_min"), F.max("stock").alias("price_max"),
        F.count(F.lit(1)).alias("parts"), F.sum("stock").alias("stock"),
    )
    sized = F.col("category").isin("ECONOMY", "LARGE", "SMALL")
    rule = F.struct(
        "price_min", "price_max",
        F.when(sized, (F.col("stock") % 23).cast("int") + 1).alias("order_frequency"),
        F.when(sized, F.array(F.lit(1), F.lit(2), F.lit(3))).alias("quantity_options"),
        F.when(sized, F.array((F.col("parts") % 50).cast("int") + 1, F.lit(20), F.lit(10))).alias("quantity_weights"),
    )
    entries = F.map_from_entries(F.collect_list(F.struct("category", rule)))
    return per_category.agg(F.to_json(F.struct(entries.alias("categories"))).alias("value"))


RULES_SQL = f"""rules_v AS (SELECT category, min(stock) AS price_min, max(stock) AS price_max,
    CASE WHEN category IN ('ECONOMY', 'LARGE', 'SMALL') THEN CAST(sum(stock) % 23 AS INTEGER) + 1 ELSE 10 END AS order_frequency,
    CASE WHEN category IN ('ECONOMY', 'LARGE', 'SMALL') THEN '1,2,3' ELSE '1,2,3,4,5' END AS quantity_options,
    CASE WHEN category IN ('ECONOMY', 'LARGE', 'SMALL') THEN (count(*) % 50 + 1) || ',20,10' ELSE '80,10,5,3,2' END AS quantity_weights
    FROM products_v GROUP BY category)"""
query("rules_dim", f"{with_views(PRODUCTS, RULES_SQL)} SELECT * FROM rules_v")(
    lambda t: rules.rules_dim(rules_document(t)).withColumns({
        c: F.concat_ws(",", F.col(c).cast("array<string>")) for c in ("quantity_options", "quantity_weights")
    })
)
query(
    "quantity_choices",
    f"""{with_views(PRODUCTS, RULES_SQL)}, l AS (SELECT category, unnest(string_split(quantity_options, ',')) AS q, unnest(string_split(quantity_weights, ',')) AS w FROM rules_v)
        SELECT category, CAST(q AS INTEGER) AS quantity, CAST(w AS INTEGER) AS weight FROM l""",
)(lambda t: rules.quantity_choices(rules.rules_dim(rules_document(t))).drop("position"))


def category_weights(t: Tables):
    """Weight of a category: its share of bestselling sizes, a long table for scenario 1."""
    big = t.products.where("stock > 40").groupBy("category").agg((F.count(F.lit(1)) / F.lit(4.0)).alias("weight"))
    kept = big.where("category <> 'MEDIUM'")
    return kept.select(F.lit(1).alias("scenario_id"), F.lit("category").alias("dim"), F.col("category").alias("key"), "weight")


CATEGORY_W = "cw AS (SELECT category, count(*) / 4.0::DOUBLE AS w FROM products_v WHERE stock > 40 AND category <> 'MEDIUM' GROUP BY 1)"
query(
    "scenario_product_weight",
    f"""{with_views(PRODUCTS, RULES_SQL, CATEGORY_W)} SELECT product_id, greatest(coalesce(w, 5.0::DOUBLE) * (CAST(order_frequency AS DOUBLE) / 10), 0.1::DOUBLE) AS weight
        FROM products_v JOIN rules_v USING (category) LEFT JOIN cw USING (category)""",
)(
    lambda t: scoring.scenario_product_weight(t.products, category_weights(t), rules.rules_dim(rules_document(t)), 1).select("product_id", "weight")
)
query(
    "scenario_product_weight_live",
    f"{with_views(PRODUCTS, CATEGORY_W)} SELECT product_id, greatest(coalesce(w, 1.0::DOUBLE), 0.1::DOUBLE) AS weight FROM products_v LEFT JOIN cw USING (category)",
)(
    lambda t: scoring.scenario_product_weight(t.products, category_weights(t), rules.rules_dim(rules_document(t)), 1, live=True).select("product_id", "weight")
)
query(
    "frequency_weight",
    f"{with_views(PRODUCTS, RULES_SQL)} SELECT product_id, CAST(order_frequency AS DOUBLE) AS weight FROM products_v JOIN rules_v USING (category)",
)(lambda t: scoring.frequency_weight(t.products, rules.rules_dim(rules_document(t))).select("product_id", "weight"))
query(
    "residual_weights",
    """WITH o AS (SELECT p_brand AS scenario_id, p_type AS category, count(*) AS w FROM part WHERE p_size > 45 GROUP BY 1, 2),
        c AS (SELECT DISTINCT p_type AS category FROM part),
        s AS (SELECT scenario_id, sum(w) AS given, count(*) AS named FROM o GROUP BY 1)
        SELECT s.scenario_id, c.category, coalesce(CAST(o.w AS DOUBLE), round_even(greatest(CAST(100 - given AS DOUBLE) / ((SELECT count(*) FROM c) - named), 0.5), 1)) AS weight
        FROM s CROSS JOIN c LEFT JOIN o ON o.scenario_id = s.scenario_id AND o.category = c.category""",
)(
    lambda t: scoring.residual_weights(
        t.raw("part").where("p_size > 45").groupBy(F.col("p_brand").alias("scenario_id"), F.col("p_type").alias("category")).agg(F.count(F.lit(1)).alias("weight")),
        t.raw("part").select(F.col("p_type").alias("category")),
    )
)
query(
    "scenario_for_hour",
    """SELECT hour(ts) AS hour, count(*) AS orders, CASE WHEN hour(ts) < 6 THEN 19 WHEN hour(ts) >= 21 THEN 17 ELSE 0 END AS scenario_id,
        CASE WHEN hour(ts) < 6 THEN 3 ELSE 10 END AS volume_min, CASE WHEN hour(ts) < 6 THEN 15 ELSE 50 END AS volume_max,
        CASE WHEN hour(ts) < 6 THEN 45.0::DOUBLE WHEN hour(ts) >= 21 THEN 65.0::DOUBLE ELSE 55.0::DOUBLE END AS female_weight FROM events GROUP BY hour(ts)""",
)(
    lambda t: scoring.scenario_for_hour(
        rules.scenario_settings(scenario_document(t)),
        t.events.groupBy(F.hour("created_at").alias("hour")).agg(F.count(F.lit(1)).alias("orders")),
    ).select("hour", "orders", "scenario_id", "volume_min", "volume_max", F.col("weights")["gender:F"].alias("female_weight"))
)

# sampling
query(
    "weighted_sample",
    f"""SELECT c_custkey AS user_id FROM customer WHERE c_acctbal > 0
        ORDER BY -ln(({u32('c_custkey')} + 0.5::DOUBLE) / 4294967296.0::DOUBLE) / c_acctbal, c_custkey LIMIT 50""",
)(lambda t: sampling.weighted_sample(t.users.select("user_id", "balance"), "user_id", "balance", 50, SEED).select("user_id"))
query(
    "prefix_sums",
    f"""{with_views(USERS)} SELECT user_id, CAST(sum(balance) OVER w AS DOUBLE) AS high, CAST(sum(balance) OVER w - balance AS DOUBLE) AS low
        FROM users_v WHERE balance > 0 WINDOW w AS (ORDER BY substr(md5(user_id || '|order'), 1, 3), user_id)""",
)(lambda t: sampling.prefix_sums(t.users.select("user_id", "balance").where("balance > 0"), "user_id", "balance").select("user_id", "low", "high"))
query(
    "weighted_draws",
    f"""{with_views(USERS)}, w AS (SELECT user_id, sum(balance) OVER (ORDER BY substr(md5(user_id || '|order'), 1, 3), user_id) AS high, balance FROM users_v WHERE balance > 0),
        draws AS (SELECT o_orderkey AS order_id, {u32('o_orderkey')} / 4294967296.0::DOUBLE * (SELECT CAST(sum(balance) AS DOUBLE) FROM w) AS point FROM orders)
        SELECT order_id, user_id FROM draws JOIN w ON point >= CAST(high - balance AS DOUBLE) AND point < CAST(high AS DOUBLE)""",
)(lambda t: sampling.weighted_draws(t.orders.select("order_id"), "order_id", t.users.select("user_id", "balance"), "user_id", "balance", SEED))
query(
    "whole_draws",
    f"""{with_views(USERS)}, i AS (SELECT user_id, CAST(floor(balance) AS BIGINT) AS w FROM users_v WHERE floor(balance) >= 1),
        l AS (SELECT user_id, w, {u32('user_id', 'order')} % (SELECT (count(*) + 63) // 64 FROM i) AS leaf FROM i),
        t AS (SELECT user_id, w, sum(w) OVER (ORDER BY leaf, user_id) AS high FROM l),
        draws AS (SELECT o_orderkey AS order_id, CAST('0x' || substr(md5(o_orderkey || '|{SEED}'), 1, 16) AS UBIGINT)::HUGEINT * (SELECT sum(w) FROM i)::HUGEINT // 18446744073709551616 AS point FROM orders)
        SELECT order_id, user_id FROM draws ASOF JOIN (SELECT user_id, high - w AS low FROM t) ON point >= low""",
)(lambda t: sampling.whole_draws(t.orders.select("order_id"), "order_id", t.users.select("user_id", "balance"), "user_id", "balance", SEED, 64))
CHOICES = "choices(class, method, low, high) AS (VALUES " + ", ".join(
    f"('{group}', '{method}', {sum(w for g, _, w in fixed.PAYMENT_CHOICE[:i] if g == group)}.0::DOUBLE / 100.0::DOUBLE, "
    f"{sum(w for g, _, w in fixed.PAYMENT_CHOICE[:i + 1] if g == group)}.0::DOUBLE / 100.0::DOUBLE)"
    for i, (group, method, _) in enumerate(fixed.PAYMENT_CHOICE)
) + ")"


@query(
    "categorical_assign",
    f"""{with_views(ORDERS, USERS, CHOICES)} SELECT order_id, method FROM (SELECT order_id, {u32('order_id')} / 4294967296.0::DOUBLE AS u,
        CASE WHEN age IS NULL THEN '40s' WHEN age < 30 THEN '1020' WHEN age < 40 THEN '30s' WHEN age < 50 THEN '40s' ELSE '50plus' END AS class
        FROM orders_v JOIN users_v USING (user_id)) JOIN choices USING (class) WHERE u >= low AND u < high""",
)
def categorical_assign(t: Tables):
    options = [(i, *row) for i, row in enumerate(fixed.PAYMENT_CHOICE)]
    choices = sampling.choice_table(
        t.spark.createDataFrame(options, "position int, class string, method string, weight int"), "class", "method", "weight", "position"
    )
    buyers = join_keyed(t.orders.select("order_id", "user_id"), t.users.select("user_id", "age"), "user_id", spread_by=["order_id"])
    classed = buyers.select("order_id", people.payment_class(F.col("age")).alias("class"))
    return sampling.categorical_assign(classed, "order_id", choices, "class", "method", SEED).select("order_id", "method")


query(
    "quantity_assign",
    f"""{with_views(PRODUCTS, RULES_SQL)}, l AS (SELECT category, unnest(string_split(quantity_options, ',')) AS q, unnest(string_split(quantity_weights, ',')) AS w FROM rules_v),
        c AS (SELECT category, CAST(q AS INTEGER) AS quantity, CAST(w AS DOUBLE) AS w, sum(CAST(w AS DOUBLE)) OVER (PARTITION BY category ORDER BY q) AS upto, sum(CAST(w AS DOUBLE)) OVER (PARTITION BY category) AS whole FROM l)
        SELECT product_id, c.quantity FROM products_v p JOIN c USING (category)
        WHERE {u32('product_id')} / 4294967296.0::DOUBLE >= (upto - w) / whole AND {u32('product_id')} / 4294967296.0::DOUBLE < upto / whole""",
)(
    lambda t: sampling.categorical_assign(
        t.products.select("product_id", "category"), "product_id",
        sampling.choice_table(rules.quantity_choices(rules.rules_dim(rules_document(t))), "category", "quantity", "weight", "position"),
        "category", "quantity", SEED,
    ).select("product_id", "quantity")
)

# planning
WEEK = "CAST(least(4, (day(d) + (isodow(date_trunc('month', d)) - 1) - 1) // 7 + 1) AS INTEGER)"
query("week_of_month", f"WITH x AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) SELECT d AS day, {WEEK} AS week FROM x")(
    lambda t: t.orders.select(F.col("created_at").cast("date").alias("day")).distinct().withColumn("week", times.week_of_month(F.col("day")))
)
PLAN = "plan(month, week, base, scenario_id, weight) AS (VALUES " + ", ".join(
    f"({m}, {w}, {base}, {s}, {x}::DOUBLE)" for m, (base, weeks) in fixed.MONTH_PLAN.items() for w, (s, x) in enumerate(weeks, 1)
) + ")"
DAILY = f"""daily AS (SELECT d AS day, w AS week, scenario_id, CAST(floor(base::DOUBLE / day(last_day(d)) * weight
    * (CASE WHEN isodow(d) >= 6 THEN 1.3::DOUBLE WHEN isodow(d) = 5 THEN 1.15::DOUBLE ELSE 0.95::DOUBLE END)) AS INTEGER) AS planned_orders
    FROM (SELECT d, {WEEK} AS w FROM x) JOIN plan ON plan.month = month(d) AND plan.week = w)"""
query("calendar_plan", f"WITH {PLAN}, x AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), {DAILY} SELECT * FROM daily")(
    lambda t: planning.calendar_plan(t.orders.select(F.col("created_at").cast("date").alias("day")).distinct())
)
VOLUME = "volume(hour, share) AS (VALUES " + ", ".join(f"({h}, {v / sum(fixed.HOUR_VOLUME)!r}::DOUBLE)" for h, v in enumerate(fixed.HOUR_VOLUME)) + ")"
CUT = f"""{with_views(VOLUME)}, d AS (SELECT CAST(o_orderdate AS DATE) AS day, CAST(floor(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1000) AS BIGINT) AS orders FROM orders GROUP BY 1),
    c AS (SELECT day, orders, hour, CAST(floor(orders * share) AS BIGINT) AS n, floor(orders * share) - orders * share AS lack FROM d CROSS JOIN volume),
    r AS (SELECT *, orders - sum(n) OVER (PARTITION BY day) AS rest, row_number() OVER (PARTITION BY day ORDER BY lack, hour) AS turn FROM c)"""


def daily_volume(t: Tables):
    """A daily figure to allocate: thousands of revenue per order day."""
    thousands = F.floor(F.sum("total_amount") / 1000).cast("bigint")
    return t.orders.groupBy(F.col("created_at").cast("date").alias("day")).agg(thousands.alias("orders"))


query(
    "hourly_allocation",
    f"""{CUT} SELECT day, orders, hour, n + CASE WHEN (hour = 20 AND rest >= 1) OR (hour = 19 AND rest >= 2) OR (hour = 18 AND rest >= 3) OR (hour = 21 AND rest >= 4) THEN 1 ELSE 0 END AS hour_orders FROM r""",
)(lambda t: planning.hourly_allocation(daily_volume(t)))
query("hourly_allocation_exact", f"{CUT} SELECT day, orders, hour, n + CASE WHEN turn <= rest THEN 1 ELSE 0 END AS hour_orders FROM r")(
    lambda t: planning.hourly_allocation(daily_volume(t), exact=True)
)
COMPARED = f"""WITH {PLAN}, x AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2002-12-31', INTERVAL 1 DAY)) AS DATE) AS d), {DAILY},
    a AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1),
    compared AS (SELECT coalesce(daily.day, a.day) AS day, coalesce(scenario_id, 0) AS scenario_id, coalesce(planned_orders, 0) AS planned_orders,
      coalesce(n, 0) AS actual_orders, coalesce(n, 0) - coalesce(planned_orders, 0) AS variance FROM daily FULL JOIN a ON daily.day = a.day)"""


def compared(t: Tables):
    return planning.plan_vs_actual(planning.calendar_plan(planning.days_between(t.spark, "1995-01-01", "2002-12-31")), t.orders)


query("plan_vs_actual", f"{COMPARED} SELECT * FROM compared")(compared)
query(
    "scenario_effect",
    f"""{COMPARED} SELECT scenario_id, count(*) AS days, CAST(sum(planned_orders) AS BIGINT) AS planned_orders,
        CAST(sum(actual_orders) AS BIGINT) AS actual_orders, CAST(sum(variance) AS BIGINT) AS variance FROM compared GROUP BY 1""",
)(lambda t: planning.scenario_effect(compared(t)))
