"""Customer, grade, basket, ingestion and pool queries on the test tables."""

import uuid

from pyspark.sql import functions as F

from ordermill.operators import basket, customers, grades, ingest, pools
from ordermill.plans.bindings import LINE_IDENTITY, LINES, ORDERS, PRODUCTS, USERS, Tables, u32, with_views
from ordermill.plans.registry import query
from ordermill.session import shared_folder
from ordermill.streaming.grade_runs import GradeRuns

AS_OF = "2001-08-01"
LOOKBACK = 730
SINCE = "1999-08-02"
RULES = [("VIP", 1_500_000, 6), ("GOLD", 800_000, 4), ("SILVER", 300_000, 2), ("BRONZE", 0, 0)]
# the thresholds grow together, so a rank is how many are met
RANK_SQL = "(" + " + ".join(f"({{a}} >= {amount} AND {{n}} >= {n})::INT" for _, amount, n in RULES[:-1]) + ")"
NAMES_SQL = "['BRONZE', 'SILVER', 'GOLD', 'VIP']"

SPEND = f"""spend AS (
  SELECT user_id, sum(total_amount) AS amount, count(order_id) AS n,
         {RANK_SQL.format(a='sum(total_amount)', n='count(order_id)')} AS rank
  FROM orders_v WHERE created_at >= TIMESTAMP '{SINCE}' AND status = 'Success' GROUP BY user_id)"""


@query(
    "grade_detail",
    f"""{with_views(ORDERS, SPEND)}, held AS (SELECT rank, count(user_id) AS customers, CAST(sum(amount) AS DOUBLE) AS revenue FROM spend GROUP BY rank)
        SELECT {NAMES_SQL}[rank + 1] AS grade, customers, round(customers * 100.0 / sum(customers) OVER (), 1) AS share, revenue,
        round(revenue / customers, 0) AS revenue_per_customer FROM held""",
)
def grade_detail(t: Tables):
    return customers.grade_detail(t.orders, SINCE, RULES)


query("grade_distribution", f"{with_views(ORDERS, SPEND)} SELECT {NAMES_SQL}[rank + 1] AS grade, count(*) AS customers FROM spend GROUP BY rank")(
    lambda t: customers.grade_distribution(t.orders, SINCE, RULES)
)
query("grade_revenue", f"{with_views(ORDERS, SPEND)} SELECT {NAMES_SQL}[rank + 1] AS grade, CAST(sum(amount) AS DOUBLE) AS revenue FROM spend GROUP BY rank")(
    lambda t: customers.grade_revenue(t.orders, SINCE, RULES)
)
query("stored_grade_counts", f"{with_views(USERS)} SELECT grade, count(*) AS customers FROM users_v GROUP BY grade")(
    lambda t: customers.stored_grade_counts(t.users)
)
SEGMENT_SQL = f"""{with_views(ORDERS)}, s AS (SELECT user_id, coalesce(sum(total_amount), 0) AS amount, count(*) AS n
    FROM orders_v WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL {{days}} DAYS GROUP BY user_id),
    g AS (SELECT CASE WHEN amount >= 5000000 AND n >= 30 THEN 'VIP' WHEN amount >= 10000 THEN '일반' ELSE '휴면' END AS segment, amount FROM s)"""
query("segment_distribution", f"{SEGMENT_SQL.format(days=30)} SELECT segment, count(*) AS customers FROM g GROUP BY 1")(
    lambda t: customers.segment_distribution(t.orders, AS_OF)
)
query("segment_revenue", f"{SEGMENT_SQL.format(days=30)} SELECT segment, CAST(sum(amount) AS DOUBLE) AS revenue FROM g GROUP BY 1")(
    lambda t: customers.segment_revenue(t.orders, AS_OF)
)
query(
    "top_fraction_customers",
    f"""{with_views(ORDERS, USERS)}, totals AS (SELECT user_id, sum(total_amount) AS amount, count(order_id) AS orders FROM orders_v
        WHERE status = 'Success' AND created_at >= TIMESTAMP '1996-01-01' AND user_id IN (SELECT user_id FROM users_v) GROUP BY user_id),
        amounts AS (SELECT amount, count(*) AS buyers FROM totals GROUP BY amount),
        larger AS (SELECT amount, coalesce(sum(buyers) OVER (ORDER BY amount DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM amounts)
        SELECT user_id, name, email, CAST(amount AS DOUBLE) AS revenue, orders FROM larger JOIN totals USING (amount) JOIN users_v USING (user_id)
        WHERE above <= 0.2 * ((SELECT count(*) FROM totals) - 1)""",
)(lambda t: customers.top_fraction_customers(t.orders, t.users, "1996-01-01", 0.2))

UPDATE_SQL = f"""{with_views(ORDERS, USERS)}, recent AS (SELECT user_id, sum(total_amount) AS amount, count(order_id) AS n FROM orders_v
      WHERE status = 'Success' AND created_at >= TIMESTAMP '{AS_OF}' - INTERVAL {LOOKBACK} DAYS GROUP BY 1),
    ranks AS (SELECT u.user_id, grade AS old_grade, list_position({NAMES_SQL}, grade) - 1 AS old,
      {RANK_SQL.format(a='coalesce(amount, 0)', n='coalesce(n, 0)')} AS target FROM users_v u LEFT JOIN recent r USING (user_id)),
    updated AS (SELECT user_id, old_grade, {NAMES_SQL}[CASE WHEN target >= old THEN target ELSE old - 1 END + 1] AS new_grade,
      CASE WHEN target > old THEN 'upgraded' WHEN target < old THEN 'downgraded' ELSE 'unchanged' END AS change FROM ranks)"""


def updated(t: Tables):
    return grades.update_grades(t.users, t.orders, AS_OF, LOOKBACK, RULES)


query("grade_update", f"{UPDATE_SQL} SELECT * FROM updated")(updated)
query(
    "grade_update_stats",
    f"""{UPDATE_SQL} SELECT count(*) AS total_users, count_if(change = 'upgraded') AS upgraded, count_if(change = 'downgraded') AS downgraded,
        count_if(change = 'unchanged') AS unchanged, count_if(new_grade = 'VIP') AS vip, count_if(new_grade = 'GOLD') AS gold,
        count_if(new_grade = 'SILVER') AS silver, count_if(new_grade = 'BRONZE') AS bronze FROM updated""",
)(lambda t: grades.grade_update_stats(updated(t), RULES))

RUNS = grades.run_calendar("1996-06-01", AS_OF, 90)
def history_sql(runs: list) -> str:
    days = ", ".join(f"({i}, DATE '{d}')" for i, d in enumerate(runs))
    return f"""WITH RECURSIVE {ORDERS}, {USERS}, runs(run, d) AS (VALUES {days}),
    spend AS (SELECT user_id, run, sum(total_amount) AS amount, count(order_id) AS n FROM orders_v JOIN runs
      ON created_at >= d - INTERVAL 365 DAYS AND created_at < d + INTERVAL 1 DAY WHERE status = 'Success' GROUP BY 1, 2),
    grid AS (SELECT u.user_id, r.run, r.d, {RANK_SQL.format(a='coalesce(amount, 0)', n='coalesce(n, 0)')} AS target
      FROM users_v u CROSS JOIN runs r LEFT JOIN spend s ON s.user_id = u.user_id AND s.run = r.run),
    path AS (SELECT user_id, -1 AS run, CAST(NULL AS DATE) AS d, list_position({NAMES_SQL}, grade) - 1 AS rank FROM users_v
      UNION ALL SELECT p.user_id, g.run, g.d, CASE WHEN g.target >= p.rank THEN g.target ELSE p.rank - 1 END
      FROM path p JOIN grid g ON g.user_id = p.user_id AND g.run = p.run + 1)"""


HISTORY_SQL = history_sql(RUNS)
LAST_RUNS = RUNS[-3:]


def history(t: Tables):
    return grades.grade_history(t.users, t.orders, RUNS, 365, RULES)


query("grade_history", f"{HISTORY_SQL} SELECT user_id, run + 1 AS run, d AS run_date, {NAMES_SQL}[rank + 1] AS grade FROM path WHERE run >= 0")(history)
query(
    "grade_trend",
    f"{HISTORY_SQL} SELECT d AS run_date, {NAMES_SQL}[rank + 1] AS grade, count(*) AS customers FROM path WHERE run >= 0 GROUP BY 1, 2",
)(lambda t: history(t).groupBy("run_date", "grade").agg(F.count(F.lit(1)).alias("customers")))


@query("grade_runs", f"{history_sql(LAST_RUNS)} SELECT user_id, {NAMES_SQL}[rank + 1] AS grade FROM path WHERE run = {len(LAST_RUNS) - 1}")
def grade_runs(t: Tables):
    """The grades after some runs, each reading what changed since the last."""
    kept = GradeRuns(t.spark, f"{shared_folder(t.spark)}/runs/{uuid.uuid4().hex}", 365, RULES)
    kept.start(t.users)
    for number, day in enumerate(LAST_RUNS):
        kept.run(t.orders, number, day, LAST_RUNS[number - 1] if number else None)
    return kept.grades_after(len(LAST_RUNS) - 1)


# baskets and joined orders
query(
    "category_copurchase",
    f"""{with_views(LINES, ORDERS, PRODUCTS)}, held AS (SELECT user_id, list_sort(list(DISTINCT category)) AS c FROM lines_v
        JOIN orders_v USING (order_id) JOIN products_v USING (product_id) WHERE status = 'Success' GROUP BY user_id),
        pairs AS (SELECT unnest(flatten(list_transform(range(1, len(c)), lambda i: list_transform(c[i + 1:], lambda other: c[i] || ' + ' || other)))) AS category_pair FROM held)
        SELECT category_pair, count(*) AS customers FROM pairs GROUP BY 1 HAVING customers >= 5 ORDER BY customers DESC, category_pair LIMIT 20""",
)(lambda t: basket.category_copurchase(t.lines_by_category("user_id", "status")))
BASKET_SQL = """WITH b AS (SELECT o_custkey, o_orderdate, count(*) AS basket_size FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
    s AS (SELECT basket_size, count(*) AS baskets FROM b GROUP BY 1)"""
query("basket_sizes", f"{BASKET_SQL} SELECT basket_size, baskets FROM s")(
    lambda t: basket.basket_sizes(t.lines_with("user_id", "created_at"))
)
query(
    "basket_size_shares",
    f"""{BASKET_SQL} SELECT basket_size, round(CAST(baskets * 100.0 / sum(baskets) OVER () AS DOUBLE), 1) AS actual_share,
        CAST(coalesce([25, 20, 15, 12, 10, 7, 5, 3, 2, 1][basket_size], 0) AS DOUBLE) AS planned_share FROM s""",
)(lambda t: basket.basket_size_shares(basket.basket_sizes(t.lines_with("user_id", "created_at"))))
query(
    "mean_basket_size",
    f"{BASKET_SQL} SELECT CAST(sum(basket_size * baskets) AS DOUBLE) / sum(baskets) AS mean_basket_size FROM s",
)(lambda t: basket.mean_basket_size(basket.basket_sizes(t.lines_with("user_id", "created_at"))))
query(
    "denormalise_orders",
    f"""{with_views(LINES, ORDERS, USERS, PRODUCTS)} SELECT l.order_id, l.line, l.product_id, l.quantity, CAST(l.total_amount AS DOUBLE) AS total_amount,
        l.created_at, o.user_id, p.category, coalesce(split_part(u.address, ' ', 1), 'Unknown') AS user_region, u.gender AS user_gender,
        coalesce((u.age // 10 * 10) || '대', 'Unknown') AS user_age_group
        FROM lines_v l JOIN orders_v o USING (order_id) JOIN users_v u ON u.user_id = o.user_id JOIN products_v p ON p.product_id = l.product_id""",
)(lambda t: basket.denormalise_orders(t.lines_with("user_id"), t.users, t.products, LINE_IDENTITY))
query(
    "reject_orphans",
    """SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id, o_custkey AS user_id,
        CASE WHEN c_custkey IS NULL AND p_partkey IS NULL THEN 'user and product not found' WHEN c_custkey IS NULL THEN 'user not found'
        ELSE 'product not found' END AS reason FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey
        LEFT JOIN (SELECT * FROM part WHERE p_size > 5) ON l_partkey = p_partkey WHERE c_custkey IS NULL OR p_partkey IS NULL""",
)(
    lambda t: basket.reject_orphans(
        t.lines_with("user_id").select("order_id", "line", "product_id", "user_id"),
        t.users.where("balance >= 0"), t.products.where("stock > 0"), LINE_IDENTITY,
    )
)
query(
    "abnormal_order_detail",
    f"""{with_views(ORDERS, USERS)} SELECT o.order_id, u.name AS buyer, CAST(o.total_amount AS DOUBLE) AS total_amount,
        strftime(o.created_at, '%Y-%m-%d %H:%M:%S') AS ordered_at
        FROM orders_v o LEFT JOIN (SELECT * FROM users_v WHERE balance >= 0) u ON o.user_id = u.user_id
        WHERE o.total_amount < 0 OR o.total_amount >= 495000 ORDER BY o.created_at DESC, o.order_id LIMIT 100""",
)(lambda t: basket.abnormal_order_detail(t.orders, t.users.where("balance >= 0"), 495_000))
query(
    "order_amounts",
    """SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id, CAST(greatest(
        CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS INTEGER) + CASE WHEN l_quantity < 10 THEN 2500 ELSE 0 END
        - CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) * 20, 0) AS DOUBLE) AS total_amount FROM lineitem""",
)(
    lambda t: basket.order_amounts(
        t.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("product_id"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.when(F.col("l_quantity") < 10, 2500).otherwise(0).alias("shipping_cost"),
            (F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(4,2)") * 20).alias("discount_amount"),
        )
    ).select("order_id", "line", "product_id", "total_amount")
)
query(
    "product_derivations",
    f"""{with_views(PRODUCTS)} SELECT product_id, CASE WHEN org_price > price THEN CAST(org_price - price AS DOUBLE) / CAST(org_price AS DOUBLE) ELSE 0 END AS discount_rate,
        CASE WHEN review_count > 1000 AND rating > 4.5 THEN 'Y' ELSE 'N' END AS is_best, CAST(floor(price / 100) * 100 AS BIGINT) AS price_floor
        FROM products_v""",
)(lambda t: basket.product_derivations(t.products).select("product_id", "discount_rate", "is_best", "price_floor"))

# arrival of rows
LINE_COLUMNS = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
query(
    "dedup_first",
    f"""SELECT l_orderkey, l_linenumber, {LINE_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
        FROM lineitem) WHERE rn = 1""",
)(lambda t: ingest.first_arrivals(t.raw("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
query(
    "insert_if_absent",
    """SELECT l_orderkey, l_linenumber, min(l_shipdate) AS l_shipdate FROM lineitem a
        WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_shipdate < TIMESTAMP '1996-01-01'
          AND a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber) GROUP BY 1, 2""",
)(
    lambda t: ingest.insert_if_absent(
        t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"), ["l_orderkey", "l_linenumber"], ["l_shipdate"],
        target=t.raw("lineitem").where("l_shipdate < '1996-01-01'"),
    )
)
query("last_ordered_at", f"{with_views(USERS)} SELECT user_id, last_ordered_at FROM users_v")(
    lambda t: t.users_at_cut.select("user_id", "last_ordered_at")
)
query("order_counts", f"{with_views(PRODUCTS)} SELECT product_id, order_count FROM products_v")(
    lambda t: t.products_at_cut.select("product_id", "order_count")
)
query(
    "merge_snapshot",
    f"{UPDATE_SQL} SELECT user_id, name, CASE WHEN change = 'unchanged' THEN old_grade ELSE new_grade END AS grade FROM updated JOIN users_v USING (user_id)",
)(
    lambda t: ingest.merge_snapshot(
        t.users.select("user_id", "name", "grade"),
        updated(t).where("change <> 'unchanged'").select("user_id", F.col("new_grade").alias("grade")),
        "user_id",
    )
)
query(
    "normalise_types",
    """SELECT c_custkey AS user_id, CASE WHEN c_acctbal > 3000 THEN 'true' ELSE 'false' END AS marketing_agree,
        coalesce(first_order, TIMESTAMP '2002-01-01') AS created_at FROM customer
        LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey""",
)(
    lambda t: ingest.normalise_types(
        t.raw("customer").select(F.col("c_custkey").alias("user_id"), (F.col("c_acctbal") > 3000).alias("marketing_agree")).join(
            t.orders.where("status = 'Success'").groupBy("user_id").agg(
                F.date_format(F.min("created_at"), "yyyy-MM-dd'T'HH:mm:ss").alias("created_at")
            ), "user_id", "left",
        ), "2002-01-01",
    )
)

# pools
query(
    "user_pool",
    f"""{with_views(USERS)}, fresh AS (SELECT user_id, 'new' AS part, row_number() OVER (ORDER BY created_at DESC, user_id) AS r FROM users_v
        WHERE last_ordered_at IS NULL QUALIFY r <= 400),
        known AS (SELECT user_id, 'known' AS part, row_number() OVER (ORDER BY last_ordered_at, user_id) AS r FROM users_v WHERE last_ordered_at IS NOT NULL)
        SELECT user_id, part, r AS place FROM fresh UNION ALL SELECT user_id, part, r + (SELECT count(*) FROM fresh) FROM known
        WHERE r <= 1000 - (SELECT count(*) FROM fresh)""",
)(lambda t: pools.user_pool(t.users_at_cut).select("user_id", "part", F.col("place").cast("bigint").alias("place")))
query(
    "product_pool",
    f"""{with_views(PRODUCTS)}, fresh AS (SELECT product_id, 'new' AS part, row_number() OVER (ORDER BY created_at DESC, product_id) AS r FROM products_v
        WHERE order_count = 0 QUALIFY r <= 300),
        known AS (SELECT product_id, 'known' AS part, row_number() OVER (ORDER BY order_count DESC, product_id) AS r FROM products_v WHERE order_count > 0)
        SELECT product_id, part, r AS place FROM fresh UNION ALL SELECT product_id, part, r + (SELECT count(*) FROM fresh) FROM known
        WHERE r <= 1000 - (SELECT count(*) FROM fresh)""",
)(lambda t: pools.product_pool(t.products_at_cut).select("product_id", "part", F.col("place").cast("bigint").alias("place")))
query("seed_sample", f"{with_views(USERS)} SELECT user_id, name, random_seed FROM users_v ORDER BY random_seed, user_id LIMIT 100")(
    lambda t: pools.seed_sample(t.users, 100).select("user_id", "name", "random_seed")
)
query("random_members", f"SELECT c_custkey AS user_id FROM customer ORDER BY {u32('c_custkey', 7)}, c_custkey LIMIT 20")(
    lambda t: pools.random_members(t.users.select("user_id"), "user_id", 20, seed=7)
)
