import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ordermill.sources import events
from ordermill.streaming import jobs, late, statistics

T0 = datetime(2025, 5, 1, 10)
SCHEMA = "order_id string, category string, total_amount decimal(18,2), payment_method string, user_age_group string, created_at timestamp"


def orders(n, rng):
    minutes = lambda i: i // 4 - (rng.randint(15, 90) if rng.random() < 0.2 else 0)
    return [(f"o{i}", "ABC"[i % 3], i % 11 + 0.25, "P" + str(i % 2), "G" + str(i % 4), T0 + timedelta(minutes=minutes(i)) if i % 29 else None) for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA.replace("decimal(18,2)", "double")).withColumn("total_amount", F.col("total_amount").cast("decimal(18,2)"))


@pytest.mark.parametrize("statistic", ["category_stats", "age_payment_stats"])
def test_statistic_and_late_rows_are_the_whole_table_over_restarts(spark, tmp_path, rows, statistic):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    data = orders(360, random.Random(1))
    for n in range(6):  # a run for each two files, so two restarts
        frame(spark, data[n * 60 : (n + 1) * 60]).coalesce(1).write.mode("append").parquet(source)
        time.sleep(0.02)
        if n % 2:
            stream = events.read_event_stream(spark, source, "parquet", schema=SCHEMA, maxFilesPerTrigger=1)
            late.start_audited(stream, statistic, out, name=f"{statistic}_{n}").awaitTermination()
    whole = statistics.per_minute(statistic, spark.read.parquet(source).where("created_at IS NOT NULL"))
    assert rows(late.read_audited(spark, statistic, out, with_unfolded=True)) == rows(whole)
    newest, expected = None, []
    for n in range(6):
        times = [r[-1] for r in data[n * 60 : (n + 1) * 60] if r[-1]]
        mark = newest - timedelta(minutes=10) if newest else None
        expected.append((n, mark, sum(mark is not None and t.replace(second=0) + timedelta(minutes=1) <= mark for t in times)))
        newest = max([*times, *([newest] if newest else [])])
    counts = late.late_counts(spark, statistic, out)
    assert rows(counts.select("batch_id", "watermark", "late")) == expected and sum(e[2] for e in expected) > 30
    assert late.late_rows(spark, statistic, out).count() == sum(e[2] for e in expected)
    number = statistics.MINUTE_STATISTICS[statistic][1]
    assert late.read_audited(spark, statistic, out).agg(F.sum(number)).first()[0] == whole.agg(F.sum(number)).first()[0] - expected[-1][2]


def test_a_repeated_batch_changes_nothing(spark, tmp_path, rows):
    out, data = str(tmp_path / "out"), orders(120, random.Random(2))
    for n in range(3):
        late.add_batch(frame(spark, data[n * 40 : (n + 1) * 40]), n, "payment_stats", out)
    before = rows(late.read_audited(spark, "payment_stats", out)), rows(late.late_counts(spark, "payment_stats", out)), rows(late.late_rows(spark, "payment_stats", out))
    late.add_batch(frame(spark, data[80:120]), 2, "payment_stats", out)
    assert (rows(late.read_audited(spark, "payment_stats", out)), rows(late.late_counts(spark, "payment_stats", out)), rows(late.late_rows(spark, "payment_stats", out))) == before


def test_windows_come_from_panes(spark, rows):
    rng = random.Random(3)
    data = [(f"o{i}", "A", float(rng.randint(0, 9)), "P", "G", T0 + timedelta(seconds=rng.randint(0, 20000))) for i in range(300)]
    windows = statistics.abnormal_windows(frame(spark, data), limit=7)
    counts = {}
    for row in data:
        if row[2] >= 7:
            for back in range(10):
                start = row[-1].replace(second=0) - timedelta(minutes=back)
                counts[start] = counts.get(start, 0) + 1
    assert rows(windows) == sorted(((s, s + timedelta(minutes=10), n) for s, n in counts.items()), key=repr)
    plan = statistics.abnormal_panes(frame(spark, data), limit=7)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan
    spans, at = [], None
    for start in sorted(s for s, n in counts.items() if n >= 4):
        if at is None or start - at > timedelta(minutes=1):
            spans.append([start, start, 0, 0])
        spans[-1][1:] = [start + timedelta(minutes=10), max(spans[-1][2], counts[start]), spans[-1][3] + 1]
        at = start
    assert len(spans) > 3 and rows(statistics.alert_spans(windows, least=4)) == sorted(map(tuple, spans), key=repr)
