import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ordermill.operators.ingest import quarantine
from ordermill.session import shared_folder
from ordermill.sources import envelopes, events, sinks, tables

ORDER = {"order_id": "o1", "user_id": "u1", "product_id": "p1", "category": "캠핑", "quantity": 2, "total_amount": 100, "payment_method": "Card",
         "user_region": "서울", "user_age_group": "20대", "created_at": "2025-05-01T10:00:00.250000"}


def raw(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string")


def wrapped(key, **changes):
    return json.dumps({"event_type": "order_created", "timestamp": "2025-05-01T10:00:01", key: ORDER | changes}, ensure_ascii=False)


def test_all_layouts_decode_alike(spark):
    out = envelopes.decode_envelope(raw(spark, [wrapped("order"), wrapped("data"), json.dumps(ORDER)])).collect()
    assert len(out) == 3 and len(set(out)) == 1
    assert out[0]["category"] == "캠핑" and out[0]["created_at"] == datetime(2025, 5, 1, 10, 0, 0, 250000)


def test_bad_messages_go_aside_with_a_reason(spark):
    texts = [wrapped("order"), "not json", json.dumps({"event_type": "x"}), wrapped("order", order_id=None), wrapped("order", created_at="yesterday"), wrapped("order", quantity="many"), None]
    good, bad = quarantine(envelopes.decode(raw(spark, texts)), "order", "order_id")
    kept = good.collect()
    assert len(kept) == 2 and sorted(r["quantity"] is None for r in kept) == [False, True]  # a wrong field is NULL, its row stays
    assert sorted(r["reason"] for r in bad.collect()) == ["missing event time", "missing key", "undecodable", "undecodable", "undecodable"]


def test_binary_values_decode(spark):
    assert envelopes.decode_envelope(raw(spark, [wrapped("order")]).withColumn("value", F.encode("value", "UTF-8"))).count() == 1


def test_encode_then_decode_is_the_identity(spark):
    orders = envelopes.decode_envelope(raw(spark, [wrapped("order"), wrapped("order", order_id="o2", category=None, created_at="2025-05-01T10:00:00")]))
    sent = envelopes.encode_envelope(orders, "order", "2025-05-01 10:00:01", "user_id")
    message = json.loads(sent.where("value LIKE '%o2%'").first()["value"])
    assert message["event_type"] == "order_created" and message["timestamp"] == "2025-05-01T10:00:01"
    assert message["order"]["category"] is None and message["order"]["created_at"] == "2025-05-01T10:00:00"
    assert {r["key"] for r in sent.collect()} == {"u1"}
    assert sorted(envelopes.decode_envelope(sent).collect()) == sorted(orders.collect())


def test_published_keys_stay_in_one_partition(spark, tmp_path):
    messages = spark.range(300).select(F.concat(F.lit("u"), (F.col("id") % 20).cast("string")).alias("key"), F.col("id").cast("string").alias("value"))
    sinks.publish_events(messages, "orders", fmt="parquet", path=str(tmp_path))
    back = events.read_event_batch(spark, str(tmp_path / "orders"), "parquet", schema="key string, value string, partition int")
    assert back.count() == 300
    assert back.groupBy("key").agg(F.countDistinct("partition").alias("n")).where("n > 1").isEmpty()
    assert back.select("partition").distinct().count() == 3


def test_pool_snapshots_replace_each_other(spark, tmp_path):
    folder = str(tmp_path / "pool")
    sinks.write_pool_snapshot(spark.range(5), folder, "2025-05-01 10:00:00")
    sinks.write_pool_snapshot(spark.range(3), folder, "2025-05-01 10:00:50")
    pool = sinks.read_pool(spark, folder).collect()
    assert sorted(r["id"] for r in pool) == [0, 1, 2]
    assert {(r["count"], r["updated_at"]) for r in pool} == {(3, "2025-05-01T10:00:50")}


def test_keyed_log_keeps_the_newest_row_and_compacts(spark, tmp_path, rows):
    path = str(tmp_path / "log")
    write = sinks.each_batch(sinks.append_folder(path))
    frame = lambda data: spark.createDataFrame(data, "k string, n int")
    write(frame([("a", 1), ("b", 1)]), 0)
    write(frame([("a", 2)]), 9)
    write(frame([("a", 3), ("c", 3)]), 10)
    write(frame([("a", 3), ("c", 3)]), 10)  # a repeated batch
    write(frame([]), 11)
    assert rows(sinks.read_keyed(spark, path, ["k"])) == [("a", 3), ("b", 1), ("c", 3)]
    assert sinks.batches(spark, path).count() == 5
    assert sinks.compact_keyed(spark, path, ["k"]) == 10
    assert rows(sinks.read_keyed(spark, path, ["k"])) == [("a", 3), ("b", 1), ("c", 3)]
    assert sinks._base(spark, path)[1].count() == 3
    write(frame([("b", 5), ("d", 5)]), 12)
    assert rows(sinks.read_keyed(spark, path, ["k"])) == [("a", 3), ("b", 5), ("c", 3), ("d", 5)]
    assert sinks.compact_keyed(spark, path, ["k"]) == 12
    assert rows(sinks.read_keyed(spark, path, ["k"])) == [("a", 3), ("b", 5), ("c", 3), ("d", 5)]


def test_overwrite_table(spark, tmp_path):
    write = sinks.overwrite_table(str(tmp_path / "t"))
    write(spark.range(9), 0)
    write(spark.range(4), 1)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4


def test_page_and_counts(spark, tmp_path, rows):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    table = tables.read_table(spark, str(tmp_path / "t"))
    assert rows(tables.page(table, ["id"], 3, 10)) == [(10,), (11,), (12,)]
    assert rows(tables.table_counts({"t": table, "none": table.where("id < 0")})) == [("none", 0), ("t", 100)]


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("read", [events.read_event_stream, events.read_event_batch])
def test_kafka_needs_its_connector(spark, read):
    with pytest.raises(Exception, match="kafka"):
        read(spark, **{"kafka.bootstrap.servers": "nowhere:9092"})
