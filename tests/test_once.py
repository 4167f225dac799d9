import pytest
from pyspark.sql import functions as F

from ordermill.sources import once

KINDS = "id long, name string"


def batch(spark, low, high):
    return spark.range(low, high, 1, 3).select("id", F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))


def ids(spark, path):
    return sorted(r["id"] for r in once.read_once(spark, path, KINDS).collect())


def test_repeated_batches_leave_each_row_once(spark, tmp_path):
    path, write = str(tmp_path / "t"), once.append_once(str(tmp_path / "t"))
    assert ids(spark, path) == []
    write(batch(spark, 0, 10), 0)
    write(batch(spark, 10, 25), 1)
    write(batch(spark, 10, 25), 1)
    write(batch(spark, 0, 10), 0)
    write(batch(spark, 0, 0), 2)  # an empty batch
    assert ids(spark, path) == list(range(25))
    assert len(list((tmp_path / "t" / "files").glob("*.parquet"))) == 6  # files of repeated batches are gone
    assert len(list((tmp_path / "t" / "ledger").glob("*.json"))) == 3


def test_a_batch_that_fails_half_way_leaves_nothing(spark, tmp_path):
    path, write = str(tmp_path / "t"), once.append_once(str(tmp_path / "t"))
    write(batch(spark, 0, 10), 0)
    broken = batch(spark, 10, 40).withColumn("name", F.when(F.col("id") == 35, F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="lost"):
        write(broken, 1)
    assert ids(spark, path) == list(range(10))
    write(batch(spark, 10, 40), 1)
    assert ids(spark, path) == list(range(40))


def test_a_driver_lost_before_the_ledger_line(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    writer = once.OnceWriter(path, 0)
    rows = batch(spark, 0, 5).toArrow().combine_chunks().to_batches()
    writer.write(iter(rows))  # files are there, nobody commits
    assert ids(spark, path) == []
    once.append_once(path)(batch(spark, 0, 5), 0)
    assert ids(spark, path) == list(range(5))


def test_overwriting_is_refused(spark, tmp_path):
    spark.dataSource.register(once.OnceSource)
    with pytest.raises(Exception, match="appended"):
        batch(spark, 0, 3).write.format("once").mode("overwrite").option("batch_id", 0).save(str(tmp_path / "t"))
