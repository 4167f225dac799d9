"""Plans must stay distributed: no nested loops, no Python rows, no unbounded single-task windows."""

import re

import pytest

from __spark_entry__ import queries
from conftest import DATA

# Windows over one partition whose input is bounded: k rows of a pool, one row per bucket, a narrow quantile bracket.
BOUNDED_WINDOWS = {"user_pool", "product_pool", "prefix_sums", "weighted_draws", "top_fraction_customers"}
TOP_K = {
    "brand_revenue_top", "gender_category_top", "category_copurchase", "top_products", "abnormal_orders", "abnormal_order_detail",
    "seed_sample", "random_members", "top_buyers", "weighted_sample", "table_page",
}


def plan(spark, name):
    return queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in queries() if not n.startswith("stream_")))
def test_plan_is_distributed(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text
    if name not in BOUNDED_WINDOWS:
        specs = re.findall(r"windowspecdefinition\((.*?)specifiedwindowframe", text)
        assert all(not re.match(r"\w+#\d+L? (ASC|DESC)", spec.strip()) for spec in specs), "window without partition"
    if name in TOP_K:
        assert "TakeOrderedAndProject" in text


@pytest.mark.parametrize(
    "name,pushed,columns",
    [
        ("total_revenue", "GreaterThanOrEqual(o_orderdate", {"o_totalprice", "o_orderdate"}),
        ("order_count", "GreaterThanOrEqual(o_orderdate", {"o_orderdate"}),
        ("payment_share", "GreaterThanOrEqual(o_orderdate", {"o_orderdate", "o_orderpriority"}),
        ("dow_hour_matrix", "GreaterThanOrEqual(ts", {"ts", "value"}),
        ("stockout_list", "", {"p_partkey", "p_name", "p_size"}),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, name, pushed, columns):
    text = plan(spark, name)
    assert pushed in text
    read = set(re.search(r"ReadSchema: struct<(.*?)>", text).group(1).split(","))
    assert {c.split(":")[0] for c in read} == columns


@pytest.mark.parametrize("name", ["payment_share", "grade_detail"])
def test_totals_reuse_the_shuffle(spark, name):
    df = queries()[name](spark, DATA)
    df._jdf.collectToPython()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_history_shuffles_orders_once_and_customers_once(spark):
    text = plan(spark, "grade_history")
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2
