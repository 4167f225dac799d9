import random

import pytest
from pyspark.sql import functions as F

from ordermill.operators import joins


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    keys = [7 if rng.random() < 0.34 else None if rng.random() < 0.1 else rng.randrange(60) for _ in range(6000)]
    fact = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, key int")
    table = spark.createDataFrame([(k, f"v{k}") for k in range(50)], "key int, value string")
    return fact, table


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize(
    "sizes",
    [{}, {"small_rows": 10}, {"small_rows": 10, "hot_rows": 1, "pieces": 20}, {"small_rows": 10, "hot_rows": 1, "pieces": 20, "spread_by": ["id"]}],
)
def test_all_ways_give_the_same_rows(skewed, rows, how, sizes):
    fact, table = skewed
    expected = rows(fact.join(table, "key", how).select("id", "key", "value"))
    assert rows(joins.join_keyed(fact, table, "key", how, **sizes).select("id", "key", "value")) == expected


def test_hot_keys_are_few_and_sliced_by_their_share(skewed):
    fact, _ = skewed
    hot = dict(joins.hot_keys(fact, ["key"], pieces=20, min_rows=1)["key"])
    share = fact.where("key = 7").count() / fact.count()
    assert set(hot) == {7, None}
    assert hot[7] == -(-share * 20 // 1)
    assert joins.hot_keys(fact, ["key", "id"], pieces=20) == {"key": [], "id": []}  # too few rows to matter


def test_sliced_join_spreads_the_hot_key(spark, skewed):
    fact, table = skewed
    hot = joins.hot_keys(fact, ["key"], pieces=20, min_rows=1)["key"]
    joined = joins._sliced_join(fact, table, "key", "inner", hot, 20, ["id"])
    assert joined.where("key = 7").count() == fact.where("key = 7").count()
    spread = fact.where("key = 7").select(F.pmod(F.xxhash64("id", "key"), F.lit(8)).alias("s")).groupBy("s").count()
    assert spread.count() == 8 and spread.agg(F.max("count")).first()[0] < fact.where("key = 7").count() / 4


def test_size_check(spark):
    assert joins.is_small(spark.range(10), 10)
    assert not joins.is_small(spark.range(11), 10)
    assert joins.is_small(spark.range(0), 0)


def test_no_job_runs_while_a_join_is_built(spark, skewed, rows):
    fact, table = skewed
    spark.sparkContext.setJobGroup("built", "joins")
    try:
        joined = [joins.join_keyed(fact, table, "key", how) for how in ("inner", "left")]
        joined.append(joins.join_each(fact, {"key": table}, spread_by=["id"]))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("built")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows(joined[0].select("id", "value")) == rows(fact.join(table, "key").select("id", "value"))


def test_a_hot_key_s_partition_is_split_at_run_time(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.adaptive.skewJoin.skewedPartitionFactor"]
    before = {n: spark.conf.get(n) for n in names}
    for name, value in zip(names, ["-1", "16k", "16k", "false", "1.5"]):
        spark.conf.set(name, value)
    try:
        fact = spark.range(0, 60_000, 1, 8).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 5000 END AS key")
        joined = joins.join_keyed(fact, spark.range(5000).selectExpr("id AS key", "id * 2 AS value"), "key")
        assert joined.count() == 60_000
        joined._jdf.collectToPython()
        assert "skewed" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
