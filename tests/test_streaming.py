import json
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ordermill import schemas
from ordermill.sources import events, sinks
from ordermill.streaming import ingest, jobs, statistics

T0 = datetime(2025, 5, 1, 10)
SCHEMA = "order_id string, user_id string, category string, total_amount decimal(18,2), payment_method string, user_age_group string, created_at timestamp"


def orders(n, shift=0):
    return [
        (f"o{i}", f"u{i % 7}", "ABC"[i % 3], float(i % 11), "P" + str(i % 2), "G" + str(i % 4), T0 + timedelta(seconds=20 * i + shift)) for i in range(n)
    ]


def put(spark, folder, data, number):
    """One file per chunk, with increasing modification times."""
    rows = [(o, u, c, a, p, g, t) for o, u, c, a, p, g, t in data]
    frame = spark.createDataFrame(rows, SCHEMA.replace("decimal(18,2)", "double")).withColumn("total_amount", F.col("total_amount").cast("decimal(18,2)"))
    frame.coalesce(1).write.mode("append").parquet(str(folder))
    time.sleep(0.02)


def stream(spark, folder):
    return events.read_event_stream(spark, str(folder), "parquet", schema=SCHEMA, maxFilesPerTrigger=1)


@pytest.mark.parametrize("statistic", sorted(statistics.STATISTICS))
def test_stream_equals_batch_over_ordered_chunks(spark, tmp_path, rows, statistic):
    source, out = tmp_path / "in", str(tmp_path / "out")
    data = orders(120)
    for n in range(4):
        put(spark, source, data[n * 30:(n + 1) * 30], n)
    extra = {"limit": 5} if statistic == "abnormal_windows" else {}
    jobs.start_statistic(stream(spark, source), statistic, out, name=f"{statistic}_ordered", **extra).awaitTermination()
    aggregate, _ = statistics.STATISTICS[statistic]
    assert rows(jobs.read_statistic(spark, statistic, out)) == rows(aggregate(spark.read.parquet(str(source)), **extra))


def test_restart_continues_from_the_checkpoint(spark, tmp_path, rows):
    source, out = tmp_path / "in", str(tmp_path / "out")
    data = orders(90)
    put(spark, source, data[:40], 0)
    jobs.start_statistic(stream(spark, source), "category_stats", out, name="first").awaitTermination()
    put(spark, source, data[40:], 1)
    jobs.start_statistic(stream(spark, source), "category_stats", out, name="second").awaitTermination()
    assert rows(jobs.read_statistic(spark, "category_stats", out)) == rows(statistics.category_stats(spark.read.parquet(str(source))))
    log = sinks.batches(spark, f"{out}/category_stats/rows")
    assert log.select("batch_id").distinct().count() >= 2


def test_late_rows_leave_windows_but_not_totals(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    late = [("late", "u0", "A", 1.0, "P0", "G0", T0)]
    on_time = [("on_time", "u0", "A", 1.0, "P0", "G0", T0 + timedelta(hours=1, minutes=52))]
    put(spark, source, orders(10), 0)
    put(spark, source, [("far", "u0", "A", 1.0, "P0", "G0", T0 + timedelta(hours=2))], 1)
    put(spark, source, [("next", "u0", "A", 1.0, "P0", "G0", T0 + timedelta(hours=2))], 2)  # the watermark moves after a batch
    put(spark, source, late + on_time, 3)
    jobs.start_statistic(stream(spark, source), "category_stats", out, name="late_windows").awaitTermination()
    jobs.start_statistic(stream(spark, source), "user_totals", out, name="late_totals").awaitTermination()
    windows = jobs.read_statistic(spark, "category_stats", out)
    assert windows.agg(F.sum("total_orders")).first()[0] == 13 and windows.where(F.col("window_start") == T0).agg(F.sum("total_orders")).first()[0] == 3
    totals = jobs.read_statistic(spark, "user_totals", out)
    assert totals.agg(F.sum("total_count")).first()[0] == 14


def test_complete_mode_overwrites(spark, tmp_path, rows):
    source, target = tmp_path / "in", str(tmp_path / "table")
    data = orders(60)
    put(spark, source, data[:30], 0)
    put(spark, source, data[30:], 1)
    totals = statistics.user_totals(stream(spark, source))
    jobs.start_complete(totals, sinks.overwrite_table(target), str(tmp_path / "cp"), "complete").awaitTermination()
    assert rows(spark.read.parquet(target)) == rows(statistics.user_totals(spark.read.parquet(str(source))))


def test_four_queries_side_by_side(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    put(spark, source, orders(30), 0)
    queries = jobs.start_all(stream(spark, source), out, every=None, totals_every=None)
    jobs.await_all(queries)
    assert len({q.id for q in queries}) == 4
    for statistic in ["category_stats", "payment_stats", "age_payment_stats", "user_totals"]:
        assert not jobs.read_statistic(spark, statistic, out).isEmpty()


def message(i, **changes):
    order = {"order_id": f"o{i}", "user_id": f"u{i % 3}", "product_id": f"p{i % 4}", "category": "A", "quantity": 1, "total_amount": 10 * i,
             "payment_method": "Card", "user_region": "R", "user_age_group": "G", "created_at": (T0 + timedelta(minutes=i)).isoformat()}
    return json.dumps({"event_type": "order_created", "timestamp": "x", "order": order | changes})


def put_messages(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({"arrived_at": a, "value": v}) for a, v in lines), encoding="utf-8")
    time.sleep(0.02)


def ingest_stream(spark, folder):
    return events.read_event_stream(spark, str(folder), "json", schema="arrived_at bigint, value string", maxFilesPerTrigger=1)


def test_ingest_inserts_once_and_counts_once(spark, tmp_path, rows):
    source, out = tmp_path / "in", str(tmp_path / "out")
    put_messages(source, "1.json", [(i, message(i)) for i in range(6)] + [(7, message(0, total_amount=999)), (8, "broken"), (9, message(1, order_id=None))])
    put_messages(source, "2.json", [(20, message(2, total_amount=777)), (21, message(6)), (22, message(7, created_at="never"))])
    put_messages(source, "3.json", [(30, message(6, total_amount=1))])  # copies only
    jobs.await_all(ingest.start_ingest(ingest_stream(spark, source), out, ("arrived_at",)))
    stored = {r["order_id"]: r["total_amount"] for r in ingest.ingested(spark, out).collect()}
    assert stored == {f"o{i}": 10 * i for i in range(7)}
    assert rows(ingest.product_order_counts(spark, out)) == [("p0", 2), ("p1", 2), ("p2", 2), ("p3", 1)]
    assert rows(ingest.user_last_orders(spark, out)) == [("u0", T0 + timedelta(minutes=6)), ("u1", T0 + timedelta(minutes=4)), ("u2", T0 + timedelta(minutes=5))]
    assert sorted(r["reason"] for r in ingest.rejected_messages(spark, out).collect()) == ["missing event time", "missing key", "undecodable"]


def test_a_repeated_batch_changes_nothing(spark, tmp_path, rows):
    out = str(tmp_path / "out")
    first = spark.createDataFrame([(i, message(i)) for i in range(5)], "arrived_at bigint, value string")
    second = spark.createDataFrame([(9, message(1)), (10, message(8))], "arrived_at bigint, value string")
    ingest.load_batch(first, 0, out)
    ingest.load_batch(second, 1, out)
    before = rows(ingest.ingested(spark, out)), rows(ingest.product_order_counts(spark, out))
    ingest.load_batch(second, 1, out)
    ingest.load_batch(first, 0, out)
    assert (rows(ingest.ingested(spark, out)), rows(ingest.product_order_counts(spark, out))) == before
    assert len(before[0]) == 6


def test_recent_copies_are_dropped_in_the_stream(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    put(spark, source, orders(20) + orders(5), 0)
    put(spark, source, orders(3), 1)
    kept = ingest.drop_recent_copies(stream(spark, source))
    query = kept.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).format("parquet").start(target)
    query.awaitTermination()
    assert spark.read.parquet(target).count() == 20


def test_refresh_runs_at_a_pace(spark, tmp_path):
    seen = []
    query = jobs.start_refresh(spark, seen.append, str(tmp_path / "cp"), "1 second", "refresh")
    deadline = time.time() + 40
    while len(seen) < 2 and time.time() < deadline:
        time.sleep(0.2)
    query.stop()
    assert len(seen) >= 2 and seen == sorted(seen)


def test_customers_and_products_are_inserted_once(spark, tmp_path):
    source = tmp_path / "in"
    user = {"user_id": "u1", "name": "Kim", "gender": "F", "age": 30, "marketing_agree": "true", "created_at": None, "random_seed": 0.5}
    texts = [json.dumps({"event_type": "user_created", "timestamp": "x", "user": user | c}) for c in ({}, {"name": "other"}, {"user_id": "u2", "created_at": "2025-01-05"}, {"user_id": None})]
    put_messages(source, "1.json", list(enumerate(texts)))
    out = str(tmp_path / "users")
    jobs.await_all(ingest.start_ingest(ingest_stream(spark, source), out, ("arrived_at",), name="users", entity="user"))
    got = {r["user_id"]: (r["name"], r["created_at"]) for r in ingest.ingested(spark, out, "user").collect()}
    assert got == {"u1": ("Kim", None), "u2": ("Kim", datetime(2025, 1, 5))}
    assert [r["reason"] for r in ingest.rejected_messages(spark, out).collect()] == ["missing key"]
    product = json.dumps({"event_type": "product_created", "timestamp": "x", "product": {"product_id": "p1", "price": 100, "is_best": "Y"}})
    loads = spark.createDataFrame([(0, product), (1, product)], "arrived_at bigint, value string")
    for batch_id in (0, 1):
        ingest.load_batch(loads, batch_id, str(tmp_path / "products"), "product")
    assert ingest.ingested(spark, str(tmp_path / "products"), "product").count() == 1


@pytest.mark.parametrize("statistic", sorted(statistics.STATISTICS))
def test_a_replay_of_unordered_files_loses_nothing(spark, tmp_path, rows, statistic):
    source, out = tmp_path / "in", str(tmp_path / "out")
    data = orders(400)
    random.Random(3).shuffle(data)
    for n in range(6):
        put(spark, source, data[n::6], n)
    extra = {"limit": 5} if statistic == "abnormal_windows" else {}
    jobs.start_statistic(stream(spark, source), statistic, out, name=f"{statistic}_replay", late_after=None, **extra).awaitTermination()
    aggregate, _ = statistics.STATISTICS[statistic]
    assert rows(jobs.read_statistic(spark, statistic, out)) == rows(aggregate(spark.read.parquet(str(source)), **extra))


def test_late_rows_are_counted(spark, tmp_path):
    source = tmp_path / "in"
    for n, moment in enumerate([T0 + timedelta(hours=2), T0 + timedelta(hours=2), T0]):
        put(spark, source, [(f"o{n}", "u0", "A", 1.0, "P0", "G0", moment)], n)
    query = jobs.start_statistic(stream(spark, source), "category_stats", str(tmp_path / "out"), name="late_count")
    query.awaitTermination()
    assert sum(jobs.late_rows(query).values()) == 1


def test_the_first_copy_wins_whatever_the_file_sizes(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    put_messages(source, "1.json", [(i, message(i, status="Success")) for i in range(40)])
    put_messages(source, "2.json", [(100 + i, message(i % 40, status="Cancelled", total_amount=-1)) for i in range(400)])
    raw = events.read_event_stream(spark, str(source), "json", schema="arrived_at bigint, value string")
    jobs.await_all(ingest.start_ingest(raw, out, ("arrived_at",)))
    stored = ingest.ingested(spark, out)
    assert {(r["order_id"], r["total_amount"], r["status"]) for r in stored.collect()} == {(f"o{i}", 10 * i, "Success") for i in range(40)}
    assert stored.count() == 40 and stored.columns == schemas.ORDERS.fieldNames()


def test_waiting_ends_with_any_failure(spark, tmp_path):
    def fail(_, __):
        raise ValueError("broken sink")

    live = spark.readStream.format("rate").load().writeStream.queryName("lives").option("checkpointLocation", str(tmp_path / "a")).foreachBatch(lambda _, __: None)
    source = tmp_path / "in"
    put(spark, source, orders(3), 0)
    broken = stream(spark, source).writeStream.queryName("breaks").option("checkpointLocation", str(tmp_path / "b")).foreachBatch(fail)
    first = live.start()
    try:
        with pytest.raises(StreamingQueryException):
            jobs.await_all([first, broken.start()])
    finally:
        first.stop()
