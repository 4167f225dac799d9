import random

import pytest

from ordermill.operators import customers


def percent_rank_top(values, fraction):
    n = len(values)
    keep = []
    for v in values:
        rank = sum(w > v for w in values) / (n - 1) if n > 1 else 0.0
        if rank <= fraction:
            keep.append(v)
    return sorted(keep)


@pytest.mark.parametrize("fraction", [0.0, 0.2, 0.21, 0.5, 1.0])
@pytest.mark.parametrize("size,spread", [(1, 10), (2, 10), (10, 1000), (11, 3), (97, 1000), (200, 5), (40, 1)])
def test_top_fraction_equals_percent_rank(spark, fraction, size, spread):
    rng = random.Random(size * 31 + spread)
    values = [rng.randrange(spread) for _ in range(size)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    for accuracy in (100_000, 20):  # a coarse sketch must not change the result
        got = sorted(r["v"] for r in customers.at_least_top(df, "v", fraction, accuracy).collect())
        assert got == percent_rank_top(values, fraction), accuracy


def test_top_fraction_of_a_larger_table_with_a_coarse_sketch(spark):
    rng = random.Random(5)
    values = [7 if rng.random() < 0.33 else rng.randrange(5000) for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(4)
    n = len(values)
    larger = {v: sum(w > v for w in values) for v in set(values)}
    expected = sorted(v for v in values if larger[v] / (n - 1) <= 0.2)
    assert sorted(r["v"] for r in customers.at_least_top(df, "v", 0.2, 100).collect()) == expected


def test_top_fraction_of_nothing(spark):
    assert customers.at_least_top(spark.createDataFrame([], "v bigint"), "v", 0.2).count() == 0


ADVERSARIAL = {
    "geometric": [2.0**k for k in range(-900, 900, 7)] * 3,
    "one value": [7.0] * 500,
    "two values": [1.0] * 300 + [1.0 + 2**-40] * 30,
    "ties at the cutoff": [float(k // 40) for k in range(900)],
    "far apart": [float(k) for k in range(500)] + [1e300, -1e300],
    "without bound": [float("inf")] * 5 + [float("-inf")] * 5 + [float(k) for k in range(90)],
}


@pytest.mark.parametrize("name", ADVERSARIAL)
@pytest.mark.parametrize("last", [4096, 3])
def test_the_top_is_exact_on_adversarial_values(spark, monkeypatch, name, last):
    monkeypatch.setattr(customers, "LAST_VALUES", last)
    values = ADVERSARIAL[name]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    ordered = sorted(values, reverse=True)
    for fraction in (0.0, 0.2, 0.5, 1.0) if last == 4096 else (0.2,):
        larger = {v: ordered.index(v) for v in set(values)}
        want = sorted(v for v in values if larger[v] / (len(values) - 1) <= fraction)
        assert sorted(r["v"] for r in customers.at_least_top(df, "v", fraction, 64).collect()) == want, fraction


def test_not_a_number_is_the_greatest_and_decimals_stay_exact(spark):
    nan = spark.createDataFrame([(float("nan"),)] * 3 + [(float(k),) for k in range(17)], "v double")
    got = customers.at_least_top(nan, "v", 0.2, 8).collect()
    assert len(got) == 4 and sum(r["v"] == 16.0 for r in got) == 1
    big = spark.range(30_000).selectExpr("CAST(99999999999999999999000000 + id AS DECIMAL(28, 2)) AS v")
    assert customers.at_least_top(big, "v", 0.1, 16).count() == 3000
    assert customers.at_least_top(big, "v", -0.1).count() == 0


def test_a_task_of_the_selection_sees_rows_or_bins(spark):
    customers.at_least_top(spark.range(20_000).selectExpr("hash(id) AS v"), "v", 0.2, 32)
    plan = customers.at_least_top(spark.range(20_000).selectExpr("hash(id) AS v"), "v", 0.2, 32)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
