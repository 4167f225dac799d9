"""Sales, data-quality and table queries on the test tables."""

from pyspark.sql import functions as F

from ordermill.operators import ingest, quality, sales
from ordermill.plans.bindings import EVENTS, LINE_IDENTITY, LINES, ORDERS, PRODUCTS, USERS, Tables, with_views
from ordermill.plans.registry import query
from ordermill.sources import tables

SINCE = "1997-01-01"
EVENTS_SINCE = "2024-01-10"
EVENTS_AS_OF = "2024-01-31"
GEO = [("AFRICA", 1.5, 20.0), ("AMERICA", 10.25, -84.5), ("EUROPE", 50.0, 10.125), ("MIDDLE EAST", 29.0, 45.5)]
GEO_SQL = "geo(district, latitude, longitude) AS (VALUES " + ", ".join(
    f"('{d}', {lat}::DOUBLE, {lon}::DOUBLE)" for d, lat, lon in GEO
) + ")"
ABNORMAL = 495_000
MAX_RATE = 0.9

query("total_revenue", f"{with_views(ORDERS)} SELECT CAST(sum(total_amount) AS DOUBLE) AS total_revenue FROM orders_v WHERE created_at >= TIMESTAMP '{SINCE}'")(
    lambda t: sales.total_revenue(t.orders, SINCE)
)
query("order_count", f"SELECT count(*) AS order_count FROM orders WHERE o_orderdate >= TIMESTAMP '{SINCE}'")(
    lambda t: sales.order_count(t.orders, SINCE)
)
query("avg_order_value", f"{with_views(ORDERS)} SELECT round(CAST(sum(total_amount) AS DOUBLE) / count(*)) AS avg_order_value FROM orders_v WHERE created_at >= TIMESTAMP '{SINCE}'")(
    lambda t: sales.avg_order_value(t.orders, SINCE)
)
query(
    "age_payment_pivot",
    f"""{with_views(EVENTS)} SELECT user_age_group,
        count(*) FILTER (WHERE payment_method = 'P0') AS "P0", count(*) FILTER (WHERE payment_method = 'P1') AS "P1",
        count(*) FILTER (WHERE payment_method = 'P2') AS "P2", count(*) FILTER (WHERE payment_method = 'P3') AS "P3"
        FROM events_v WHERE created_at >= TIMESTAMP '{EVENTS_SINCE}' GROUP BY 1""",
)(lambda t: sales.pivot_count(t.events, "user_age_group", "payment_method", ["P0", "P1", "P2", "P3"], EVENTS_SINCE))
query(
    "payment_share",
    f"""{with_views(ORDERS)} SELECT payment_method,
        round(CAST(count(*) * 100.0 / sum(count(*)) OVER () AS DOUBLE), 1) AS percentage
        FROM orders_v WHERE created_at >= TIMESTAMP '{SINCE}' GROUP BY payment_method""",
)(lambda t: sales.share_of_count(t.orders, "payment_method", SINCE))
query(
    "trend_5min",
    f"""SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS bucket, count(*) AS orders
        FROM events WHERE ts >= TIMESTAMP '{EVENTS_SINCE}' GROUP BY 1""",
)(lambda t: sales.trend(t.events, 5, since=EVENTS_SINCE))
query(
    "trend_5min_shifted",
    """SELECT time_bucket(INTERVAL 5 MINUTES, ts - INTERVAL 9 HOURS) AS bucket, count(*) AS orders
        FROM events GROUP BY 1""",
)(lambda t: sales.trend(t.events, 5, shift_hours=-9))
query(
    "hour_profile",
    f"""SELECT hour(ts) || '시' AS hour_label, count(*) AS orders FROM events
        WHERE ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 1 DAY GROUP BY hour(ts)""",
)(lambda t: sales.hour_profile(t.events, EVENTS_AS_OF))
query(
    "dow_hour_matrix",
    f"""{with_views(EVENTS)} SELECT ['일','월','화','수','목','금','토'][dayofweek(created_at) + 1] AS weekday,
        hour(created_at) || '시' AS hour_label, count(*) AS orders, CAST(sum(total_amount) AS DOUBLE) AS revenue
        FROM events_v WHERE created_at >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 7 DAYS
        GROUP BY dayofweek(created_at), hour(created_at)""",
)(lambda t: sales.dow_hour_matrix(t.events, EVENTS_AS_OF))
query(
    "freq_vs_value",
    f"""{with_views(ORDERS)} SELECT user_id, count(*) AS frequency, CAST(sum(total_amount) AS DOUBLE) / count(*) AS avg_amount
        FROM orders_v WHERE status = 'Success' GROUP BY user_id""",
)(lambda t: sales.customer_frequency_value(t.orders))
query(
    "brand_revenue_top",
    f"""{with_views(LINES)} SELECT p_brand AS brand, CAST(sum(total_amount) AS DOUBLE) AS revenue
        FROM lines_v JOIN part ON product_id = p_partkey WHERE created_at >= TIMESTAMP '{SINCE}'
        GROUP BY 1 ORDER BY sum(total_amount) DESC, brand LIMIT 20""",
)(lambda t: sales.brand_revenue_topk(t.lines, t.products, SINCE, 20))


@query(
    "gender_category_top",
    f"""{with_views(LINES, ORDERS, USERS, PRODUCTS)}, sold AS (SELECT product_id, user_id, count(*) AS lines FROM lines_v JOIN orders_v USING (order_id)
        WHERE status = 'Success' GROUP BY ALL),
        held AS (SELECT products_v.category, gender, sum(lines)::BIGINT AS lines FROM sold JOIN products_v USING (product_id) JOIN users_v USING (user_id) GROUP BY ALL),
        sides AS (PIVOT held ON gender IN ('M' AS male, 'F' AS female) USING sum(lines)::BIGINT GROUP BY category)
        SELECT category, coalesce(male, 0) AS male, coalesce(female, 0) AS female FROM sides
        ORDER BY coalesce(male, 0) + coalesce(female, 0) DESC, category LIMIT 10""",
)
def gender_category_top(t: Tables):
    from ordermill.operators.basket import denormalise_orders

    return sales.gender_category_topk(denormalise_orders(t.lines_with("user_id", "status"), t.users, t.products, LINE_IDENTITY))


REGION_SQL = f"""{with_views(ORDERS, USERS, GEO_SQL)},
    r AS (SELECT address_district AS district, count(order_id) AS orders, CAST(sum(total_amount) AS DOUBLE) AS revenue
          FROM orders_v JOIN users_v USING (user_id) GROUP BY 1)
    SELECT district, {{value}}, latitude, longitude FROM r LEFT JOIN geo USING (district)"""
query("region_orders", REGION_SQL.format(value="orders"))(
    lambda t: sales.region_orders(t.orders, t.users, sales.districts(t.spark, GEO))
)
query("region_revenue", REGION_SQL.format(value="revenue"))(
    lambda t: sales.region_revenue(t.orders, t.users, sales.districts(t.spark, GEO))
)
query(
    "monthly_orders",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS orders FROM orders
        WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1""",
)(lambda t: sales.monthly_orders(t.orders, "1996-01-01", "1998-01-01"))
query(
    "top_products",
    """SELECT p_partkey AS product_id, p_name AS name, count(*) AS order_count
        FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 20""",
)(lambda t: sales.top_products(ingest.maintain_order_count(t.products.withColumn("order_count", F.lit(0).cast("bigint")), t.lines)))
query(
    "purchased_vs_new",
    f"""{with_views(USERS)} SELECT count(*) FILTER (WHERE last_ordered_at IS NOT NULL) AS purchased,
        count(*) FILTER (WHERE last_ordered_at IS NULL) AS new_users FROM users_v""",
)(lambda t: sales.purchased_vs_new(t.users_at_cut))
query("age_group_orders", f"{with_views(EVENTS)} SELECT user_age_group, count(order_id) AS orders FROM events_v GROUP BY 1")(
    lambda t: sales.age_group_orders(t.events)
)

# tables
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
query("table_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}" for n in TABLES))(
    lambda t: tables.table_counts({n: t.raw(n) for n in TABLES})
)
query(
    "table_page",
    "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 50 OFFSET 100",
)(lambda t: tables.page(t.raw("customer").select("c_custkey", "c_name", "c_acctbal"), [F.desc("c_acctbal"), "c_custkey"], 50, 100))

# data quality
query("stockout_list", f"{with_views(PRODUCTS)} SELECT product_id, name, stock FROM products_v WHERE stock <= 0")(
    lambda t: quality.stockout_list(t.products)
)
query(
    "integrity_errors",
    f"""{with_views(PRODUCTS)} SELECT product_id, name, CAST(price AS DOUBLE) AS price, CAST(org_price AS DOUBLE) AS org_price, discount_rate
        FROM products_v WHERE discount_rate < 0 OR discount_rate > {MAX_RATE} OR price > org_price""",
)(lambda t: quality.integrity_errors(t.products, MAX_RATE))
query(
    "abnormal_orders",
    f"""{with_views(ORDERS)} SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS ordered_at
        FROM orders_v WHERE total_amount < 0 OR total_amount >= {ABNORMAL} ORDER BY created_at DESC, order_id LIMIT 100""",
)(lambda t: quality.abnormal_orders(t.orders, ABNORMAL))
query(
    "alert_abnormal_recent",
    f"""{with_views(EVENTS)} SELECT count(*) AS abnormal_orders FROM events_v
        WHERE (total_amount < 0 OR total_amount >= 100) AND created_at >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 1 DAY""",
)(lambda t: quality.abnormal_recent(t.events, EVENTS_AS_OF, 100, minutes=1440))
ALERTS_SQL = f"""{with_views(PRODUCTS, ORDERS)}, alerts AS (
    SELECT 'stockout' AS alert, count(*) AS alerts FROM products_v WHERE stock <= 0
    UNION ALL SELECT 'integrity', count(*) FROM products_v WHERE discount_rate < 0 OR discount_rate > {MAX_RATE} OR price > org_price
    UNION ALL SELECT 'abnormal', count(*) FROM orders_v WHERE total_amount < 0 OR total_amount >= {ABNORMAL})"""
query("alert_counts", f"{ALERTS_SQL} SELECT alert, alerts FROM alerts")(
    lambda t: quality.alert_counts(t.products, t.orders, ABNORMAL, MAX_RATE)
)
query(
    "alert_level",
    f"""{ALERTS_SQL} SELECT alert, alerts, CASE WHEN alert = 'integrity' THEN CASE WHEN alerts >= 1 THEN 'red' ELSE 'green' END
        WHEN alerts >= 5 THEN 'red' WHEN alerts >= 1 THEN 'yellow' ELSE 'green' END AS level FROM alerts""",
)(lambda t: quality.alert_level(quality.alert_counts(t.products, t.orders, ABNORMAL, MAX_RATE)))
query(
    "fk_pk_checks",
    """SELECT 'pk:users' AS rule, count(*) AS violations FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'pk:products', count(*) FROM (SELECT p_partkey FROM part GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'pk:orders', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'fk:orders.user_id', count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT 'fk:orders.product_id', count(DISTINCT l_partkey) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
        UNION ALL SELECT 'pk:lines', count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""",
)(
    lambda t: quality.fk_pk_checks(t.users, t.products, t.orders, t.lines).unionByName(
        quality.duplicate_keys(t.lines, "lines", ["order_id", "line"])
    )
)
