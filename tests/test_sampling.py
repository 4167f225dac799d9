import bisect
import hashlib
from collections import Counter
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from ordermill.operators import sampling


def u32(key, seed):
    return int(hashlib.md5(f"{key}|{seed}".encode()).hexdigest()[:8], 16)


@pytest.fixture(scope="module")
def items(spark):
    data = [(i, 3000 if i == 7 else 0 if i % 10 == 0 else i % 13 + 1) for i in range(300)]
    return data, spark.createDataFrame(data, "item int, w int")


def test_prefix_sums_tile_the_line(items):
    data, df = items
    spans = sorted((r["low"], r["high"], r["item"]) for r in sampling.prefix_sums(df.where("w > 0"), "item", "w", digits=1).collect())
    assert spans[0][0] == 0 and spans[-1][1] == sum(w for _, w in data)
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert {i: h - l for l, h, i in spans} == {i: w for i, w in data if w}


@pytest.mark.parametrize("cells", [1, 7, None])
def test_weighted_draws_equal_brute_force(spark, items, cells):
    data, df = items
    draws = spark.range(800).withColumnRenamed("id", "draw")
    got = {r["draw"]: r["item"] for r in sampling.weighted_draws(draws, "draw", df, "item", "w", seed=5, cells=cells, digits=1).collect()}
    order = sorted((hashlib.md5(f"{i}|order".encode()).hexdigest()[:1], i, w) for i, w in data if w)
    edges = list(accumulate(w for _, _, w in order))
    expected = {d: order[bisect.bisect_right(edges, u32(d, 5) / 2**32 * edges[-1])][1] for d in range(800)}
    assert got == expected
    assert Counter(got.values())[7] > 800 * 0.5  # more than half of all weight


def test_small_weights_are_drawn(spark):
    items = spark.createDataFrame([(1, 0.00004), (2, 0.00004)], "item int, w double")
    draws = spark.range(200).withColumnRenamed("id", "draw")
    got = Counter(r["item"] for r in sampling.weighted_draws(draws, "draw", items, "item", "w").collect())
    assert sum(got.values()) == 200 and set(got) == {1, 2}


def test_weighted_sample_has_no_repeats_and_prefers_weight(spark, items):
    _, df = items
    got = [r["item"] for r in sampling.weighted_sample(df, "item", "w", 50, seed=3).collect()]
    assert len(set(got)) == 50 and 7 in got and all(i % 10 for i in got)


def test_categorical_assign(spark):
    options = spark.createDataFrame(
        [(0, "a", "x", 50), (1, "a", "y", 50), (0, "b", "z", 1), (0, "d", "only", 3), (1, "d", "never", 0)], "pos int, grp string, opt string, w int"
    )
    choices = sampling.choice_table(options, "grp", "opt", "w", "pos")
    data = spark.range(600).select("id", F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("zz")), (F.col("id") % 3 + 1).cast("int")).alias("grp"))
    out = sampling.categorical_assign(data, "id", choices, "grp", "opt", seed=1, default="d").collect()
    assert len(out) == 600
    by_group = {g: Counter(r["opt"] for r in out if r["grp"] == g) for g in ("a", "b", "zz")}
    assert by_group["b"] == {"z": 200} and by_group["zz"] == {"only": 200}
    expected = Counter("x" if u32(i, 1) / 2**32 < 0.5 else "y" for i in range(0, 600, 3))
    assert by_group["a"] == expected
    without = sampling.categorical_assign(data, "id", choices, "grp", "opt", seed=1).where("grp = 'zz'")
    assert without.where("opt IS NULL").count() == 200


@pytest.mark.parametrize("leaf_items,block", [(1 << 16, 4096), (10, 4096), (3, 4)])
def test_whole_draws_equal_brute_force(spark, items, monkeypatch, leaf_items, block):
    monkeypatch.setattr(sampling, "BLOCK_LEAVES", block)
    data, df = items
    draws = spark.range(700).selectExpr("id AS draw", "id * 2 AS other")
    got = {r["draw"]: r["item"] for r in sampling.whole_draws(draws, "draw", df, "item", "w", 5, leaf_items).collect()}
    weights = [(i, w) for i, w in data if w]
    leaves = -(-len(weights) // leaf_items)
    order = sorted((u32(i, "order") % leaves, i, w) for i, w in weights)
    edges = list(accumulate(w for _, _, w in order))
    u64 = lambda key: int(hashlib.md5(f"{key}|5".encode()).hexdigest()[:16], 16)
    assert got == {d: order[bisect.bisect_right(edges, u64(d) * edges[-1] >> 64)][1] for d in range(700)}


def test_the_lightest_of_very_many_can_be_drawn(spark):
    """Points of 64 bits reach each of 2**33 weights, also ones of 1 beside a total near 10**18."""
    total = 10**18 - 7
    for point in (0, 1, 2**33 + 1, total // 3, total - 1):
        least = -(-point * 2**64 // total)  # the smallest number that is drawn to this point
        assert least < 2**64 and least * total >> 64 == point
    heavy = spark.createDataFrame([(i, 2**49 if i % 2 else 1) for i in range(64)], "item int, w long")
    spans, tree, whole, _ = sampling.weight_tree(heavy, "item", "w", 4)
    assert whole == 32 * 2**49 + 32
    edges = sorted((r["_low"] + r["_from"], r["_low"] + r["_to"]) for r in spans.join(tree, "_leaf").collect())
    assert edges[0][0] == 0 and edges[-1][1] == whole and all(a[1] == b[0] for a, b in zip(edges, edges[1:]))
    assert sampling.whole_draws(spark.range(500).withColumnRenamed("id", "d"), "d", heavy, "item", "w", 1, 4).count() == 500
    assert sampling.whole_draws(spark.range(5).withColumnRenamed("id", "d"), "d", heavy.where("w = 0"), "item", "w").count() == 0
    with pytest.raises(ValueError):
        sampling.weight_tree(spark.createDataFrame([(1, 10**18)], "item int, w long"), "item", "w")
