"""Event queries: envelopes, live statistics on a table and the same statistics run as streams."""

import uuid

from pyspark.sql import functions as F

from ordermill.plans.bindings import EVENTS, Tables, order_events, with_views
from ordermill.plans.registry import query
from ordermill.session import shared_folder
from ordermill.sources import envelopes, events, sinks
from ordermill.streaming import enrich, ingest, jobs, late, statistics

EMITTED = "2024-02-01 12:00:00"


def messages(raw):
    """Order events as the JSON texts a topic would carry: three layouts, broken ones, second copies.

    The event type decides: "error" is not JSON, "signup" has no order id, "click" arrives twice, the
    second time with another amount.
    """
    typed = order_events(raw).withColumn("created_at", F.col("created_at").cast("timestamp"))
    copies = F.when(F.col("category") == "click", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = typed.withColumn("copy", F.explode(copies))
    order = F.struct(
        F.when(F.col("category") != "signup", F.col("order_id").cast("string")).alias("order_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("P"), F.col("quantity").cast("string")).alias("product_id"),
        "category",
        "quantity",
        (F.floor("total_amount") + 1000 * F.col("copy")).cast("int").alias("total_amount"),
        "payment_method",
        F.when(F.col("quantity") % 2 == 0, "Success").otherwise("Cancelled").alias("status"),
        (F.col("quantity") * 100).cast("int").alias("shipping_cost"),
        (F.col("quantity") + F.col("copy")).cast("int").alias("discount_amount"),
        "user_age_group",
        envelopes.iso_text(F.col("created_at")).alias("created_at"),
    )
    head = [F.lit("order_created").alias("event_type"), F.lit("2024-02-01T12:00:00").alias("timestamp")]
    value = (
        F.when(F.col("category") == "error", F.concat(F.lit("not json "), F.col("order_id").cast("string")))
        .when(F.col("category") == "purchase", F.to_json(F.struct(*head, order.alias("data"))))
        .when(F.col("category") == "view", F.to_json(order))
        .otherwise(F.to_json(F.struct(*head, order.alias("order"))))
    )
    return rows.select(value.alias("value"), (F.col("order_id") * 2 + F.col("copy")).alias("arrived_at"))


MESSAGES = f"""{EVENTS}, messages_v AS (SELECT *, unnest(CASE WHEN category = 'click' THEN [0, 1] ELSE [0] END) AS copy FROM events_v)"""
DECODED_COLUMNS = """CAST(user_id AS VARCHAR) AS user_id, 'P' || quantity AS product_id, category, quantity,
    CAST(floor(total_amount) + 1000 * copy AS INTEGER) AS total_amount, payment_method, user_age_group, created_at"""

query(
    "decode_envelope",
    f"""WITH {MESSAGES} SELECT CASE WHEN category <> 'signup' THEN CAST(order_id AS VARCHAR) END AS order_id, {DECODED_COLUMNS}
        FROM messages_v WHERE category <> 'error'""",
)(lambda t: envelopes.decode_envelope(messages(t.raw("events"))).drop("user_region"))
query(
    "encode_envelope",
    f"""{with_views(EVENTS)} SELECT CAST(user_id AS VARCHAR) AS key,
        '{{"event_type":"order_created","timestamp":"2024-02-01T12:00:00","order":{{"order_id":' || order_id || ',"user_id":' || user_id
        || ',"category":"' || category || '","quantity":' || quantity || ',"user_region":null,"created_at":"'
        || strftime(created_at, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(created_at) % 1000000 = 0 THEN '' ELSE strftime(created_at, '.%f') END || '"}}}}' AS value FROM events_v""",
)(
    lambda t: envelopes.encode_envelope(
        t.events.select("order_id", "user_id", "category", "quantity", F.lit(None).cast("string").alias("user_region"), "created_at"),
        "order", EMITTED, "user_id",
    )
)


@query(
    "quarantine_counts",
    "SELECT CASE event_type WHEN 'error' THEN 'undecodable' ELSE 'missing key' END AS reason, count(*) AS messages FROM events WHERE event_type IN ('error', 'signup') GROUP BY 1",
)
def quarantine_counts(t: Tables):
    from ordermill.operators.ingest import quarantine

    _, rejected = quarantine(envelopes.decode(messages(t.raw("events"))), "order", "order_id")
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


# live statistics, on the table and as streams
MINUTE = "date_trunc('minute', created_at)"
STATISTIC_SQL = {
    "category_stats": f"SELECT {MINUTE} AS window_start, category, count(order_id) AS total_orders, CAST(sum(total_amount) AS DOUBLE) AS total_revenue FROM events_v GROUP BY 1, 2",
    "payment_stats": f"SELECT {MINUTE} AS window_start, payment_method, count(order_id) AS count, CAST(sum(total_amount) AS DOUBLE) AS revenue FROM events_v GROUP BY 1, 2",
    "age_payment_stats": f"SELECT {MINUTE} AS window_start, user_age_group, payment_method, count(order_id) AS count FROM events_v GROUP BY 1, 2, 3",
    "user_totals": "SELECT user_id, count(order_id) AS total_count, CAST(sum(total_amount) AS DOUBLE) AS total_spent, CAST(sum(total_amount) AS DOUBLE) / count(order_id) AS avg_ticket FROM events_v GROUP BY 1",
    "abnormal_windows": f"""SELECT s AS window_start, s + INTERVAL 10 MINUTES AS window_end, count(*) AS abnormal_orders FROM (
        SELECT unnest(generate_series({MINUTE} - INTERVAL 9 MINUTES, {MINUTE}, INTERVAL 1 MINUTE)) AS s FROM events_v WHERE total_amount < 0 OR total_amount >= 100) GROUP BY 1""",
}
PARAMETERS = {"abnormal_windows": {"limit": 100}}


def live_events(t: Tables):
    """The events table as a stream of files."""
    stream = events.read_event_stream(
        t.spark, f"{t.folder}/events*.parquet", "parquet", schema=t.raw("events").schema, maxFilesPerTrigger=8
    )
    return order_events(stream).withColumn("created_at", F.col("created_at").cast("timestamp"))


def as_stream(statistic: str):
    def build(t: Tables):
        run = uuid.uuid4().hex
        folder = f"{shared_folder(t.spark)}/streams/{run}"
        started = jobs.start_statistic(live_events(t), statistic, folder, name=f"{statistic}_{run}", late_after=None, **PARAMETERS.get(statistic, {}))
        started.awaitTermination()
        return jobs.read_statistic(t.spark, statistic, folder)

    return build


def as_table(statistic: str):
    aggregate, _ = statistics.STATISTICS[statistic]
    return lambda t: aggregate(t.events, **PARAMETERS.get(statistic, {}))


BATCH_NAMES = {
    "category_stats": "win1m_category",
    "payment_stats": "win1m_payment",
    "age_payment_stats": "win1m_age_payment",
    "user_totals": "user_totals",
    "abnormal_windows": "sliding_abnormal",
}
STREAM_NAMES = {
    "category_stats": "stream_category",
    "payment_stats": "stream_payment",
    "age_payment_stats": "stream_age_payment",
    "user_totals": "stream_user_totals",
    "abnormal_windows": "stream_alerts",
}
for _statistic, _sql in STATISTIC_SQL.items():
    query(BATCH_NAMES[_statistic], f"{with_views(EVENTS)} {_sql}")(as_table(_statistic))
    query(STREAM_NAMES[_statistic], f"{with_views(EVENTS)} {_sql}")(as_stream(_statistic))


query(
    "alert_spans",
    f"""{with_views(EVENTS)}, windows_v AS ({STATISTIC_SQL["abnormal_windows"]}),
        busy AS (SELECT *, window_start - INTERVAL 1 MINUTE * (row_number() OVER (ORDER BY window_start)) AS island FROM windows_v WHERE abnormal_orders >= 2)
        SELECT min(window_start) AS opened_at, max(window_end) AS closed_at, max(abnormal_orders) AS most_orders, count(*) AS windows FROM busy GROUP BY island""",
)(lambda t: statistics.alert_spans(statistics.abnormal_windows(t.events, limit=100), least=2))


@query(
    "stream_late_folded",
    f"{with_views(EVENTS)} {STATISTIC_SQL['category_stats']}",
)
def stream_late_folded(t: Tables):
    """The events by the minute, read in no order: what the watermark sets aside is folded in by the next batch."""
    run = uuid.uuid4().hex
    folder = f"{shared_folder(t.spark)}/streams/{run}"
    orders = t.events.withColumn("created_at", F.col("created_at").cast("timestamp"))
    for batch_id in range(3):
        late.add_batch(orders.where(F.pmod(F.xxhash64("order_id"), F.lit(3)) == batch_id), batch_id, "category_stats", folder)
    return late.read_audited(t.spark, "category_stats", folder, with_unfolded=True)


@query(
    "stream_ingest",
    f"""WITH {MESSAGES} SELECT CAST(order_id AS VARCHAR) AS order_id, {DECODED_COLUMNS},
        CASE WHEN quantity % 2 = 0 THEN 'Success' ELSE 'Cancelled' END AS status, CAST(quantity * 100 AS INTEGER) AS shipping_cost,
        CAST(quantity + copy AS INTEGER) AS discount_amount FROM messages_v WHERE category NOT IN ('error', 'signup') AND copy = 0""",
)
def stream_ingest(t: Tables):
    run = uuid.uuid4().hex
    folder = f"{shared_folder(t.spark)}/streams/{run}"
    raw = events.read_event_stream(t.spark, f"{t.folder}/events*.parquet", "parquet", schema=t.raw("events").schema)
    jobs.await_all(ingest.start_ingest(messages(raw), folder, ("arrived_at",), name=f"ingest_{run}"))
    return ingest.ingested(t.spark, folder).drop("user_region", "user_name", "user_gender", "created_datetime", "updated_datetime")


def fed(t: Tables, entity: str, rows) -> str:
    """A folder into which customers or products were loaded in two halves and the orders streamed."""
    run = uuid.uuid4().hex
    folder = f"{shared_folder(t.spark)}/streams/{run}"
    key = f"{entity}_id"
    sent = envelopes.encode_envelope(rows, entity, EMITTED, key).select("value", F.xxhash64("key").alias("arrived_at"))
    ingest.load_batch(sent.where("arrived_at < 0"), 0, folder, entity)
    ingest.load_batch(sent, 1, folder, entity)
    raw = events.read_event_stream(t.spark, f"{t.folder}/events*.parquet", "parquet", schema=t.raw("events").schema)
    jobs.await_all(ingest.start_ingest(messages(raw), folder, ("arrived_at",), name=f"orders_{run}"))
    return folder


@query(
    "stream_users",
    f"""WITH {MESSAGES} SELECT CAST(c_custkey AS VARCHAR) AS user_id, any_value(c_name) AS name, max(created_at) AS last_ordered_at
        FROM customer LEFT JOIN (SELECT * FROM messages_v WHERE category NOT IN ('error', 'signup') AND copy = 0) ON user_id = c_custkey GROUP BY c_custkey""",
)
def stream_users(t: Tables):
    """Customers as the stream of orders leaves them."""
    users = t.raw("customer").select(F.col("c_custkey").cast("string").alias("user_id"), F.col("c_name").alias("name"))
    return ingest.current_users(t.spark, fed(t, "user", users)).select("user_id", "name", "last_ordered_at")


@query(
    "stream_products",
    f"""WITH {MESSAGES}, sold AS (SELECT quantity, count(*) AS n FROM messages_v WHERE category NOT IN ('error', 'signup') AND copy = 0 GROUP BY 1)
        SELECT 'P' || p_partkey AS product_id, p_name AS name, n AS order_count FROM part LEFT JOIN sold ON quantity = p_partkey""",
)
def stream_products(t: Tables):
    """Products as the stream of orders leaves them."""
    products = t.raw("part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_id"), F.col("p_name").alias("name"))
    return ingest.current_products(t.spark, fed(t, "product", products)).select("product_id", "name", "order_count")


@query(
    "stream_enriched",
    f"""{with_views(EVENTS)} SELECT e.order_id, e.user_id, e.quantity AS product_id, p_type AS category, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS user_gender
        FROM events_v AS e JOIN customer ON e.user_id = c_custkey JOIN part ON e.quantity = p_partkey""",
)
def stream_enriched(t: Tables):
    """Orders that come before half of their customers and products; those that waited are there in the end."""
    folder = f"{shared_folder(t.spark)}/streams/{uuid.uuid4().hex}"
    orders = t.events.select("order_id", "user_id", F.col("quantity").cast("bigint").alias("product_id"), F.col("created_at").cast("timestamp").alias("created_at"))
    for batch_id, half in enumerate(("{} % 2 = 0", "true")):
        users, products = t.users.where(half.format("user_id")), t.products.where(half.format("product_id"))
        batch = orders.where(f"order_id % 2 = {batch_id}")
        enrich.add_batch(batch, batch_id, folder, lambda _, users=users: users, lambda _, products=products: products, wait="10000 days")
    return enrich.enriched_orders(t.spark, folder).select("order_id", "user_id", "product_id", "category", "user_gender")


@query(
    "bulk_load",
    f"""WITH {MESSAGES} SELECT 'P' || quantity AS product_id, count(*) AS order_count FROM messages_v
        WHERE category NOT IN ('error', 'signup') AND copy = 0 GROUP BY 1""",
)
def bulk_load(t: Tables):
    """Two loads, the second repeating half of the first; counters move once per order."""
    folder = f"{shared_folder(t.spark)}/loads/{uuid.uuid4().hex}"
    sent = messages(t.raw("events"))
    ingest.load_batch(sent.where("value LIKE '%\"click\"%'"), 0, folder)
    ingest.load_batch(sent, 1, folder)
    return ingest.product_order_counts(t.spark, folder)


@query(
    "pool_snapshot",
    f"""SELECT c_custkey AS user_id, (SELECT least(count(*), 50) FROM customer) AS count, '2024-02-01T12:00:00' AS updated_at FROM customer
        ORDER BY c_acctbal DESC, c_custkey LIMIT 50""",
)
def pool_snapshot(t: Tables):
    folder = f"{shared_folder(t.spark)}/pools/{uuid.uuid4().hex}"
    richest = t.users.orderBy(F.desc("balance"), "user_id").limit(50).select("user_id")
    sinks.write_pool_snapshot(richest, folder, "2024-01-31 12:00:00")
    sinks.write_pool_snapshot(richest, folder, EMITTED)
    return sinks.read_pool(t.spark, folder)


@query(
    "publish_events",
    f"""{with_views(EVENTS)} SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS messages, 1 AS partitions FROM events_v GROUP BY 1""",
)
def publish_events(t: Tables):
    folder = f"{shared_folder(t.spark)}/topics/{uuid.uuid4().hex}"
    sent = envelopes.encode_envelope(t.events.select("order_id", "user_id", "category"), "order", EMITTED, "user_id")
    sinks.publish_events(sent, "orders", fmt="json", path=folder)
    back = events.read_event_batch(t.spark, f"{folder}/orders", "json", schema="key string, value string, partition int")
    return back.groupBy("key").agg(F.count(F.lit(1)).alias("messages"), F.countDistinct("partition").cast("int").alias("partitions"))
