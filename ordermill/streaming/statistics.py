"""Live statistics.  The same functions serve a stream and, as its check, a bounded table."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed
from ordermill.functions import checks, money


def with_watermark(orders: DataFrame, late_after: str | None = fixed.LATE_AFTER) -> DataFrame:
    """Rows older than the newest seen by ``late_after`` leave the windows; without it none does, and state grows with the windows."""
    return orders.withWatermark("created_at", late_after) if late_after else orders


# name -> (keys beside the minute, name of the number of orders, name of the revenue if wanted); the names are fixed
MINUTE_STATISTICS = {
    "category_stats": (["category"], "total_orders", "total_revenue"),
    "payment_stats": (["payment_method"], "count", "revenue"),
    "age_payment_stats": (["user_age_group", "payment_method"], "count", None),
}


def per_minute(statistic: str, orders: DataFrame) -> DataFrame:
    """One of ``MINUTE_STATISTICS``: orders, and revenue, for each minute and key."""
    keys, number, revenue = MINUTE_STATISTICS[statistic]
    measures = [F.count("order_id").alias(number)]
    if revenue:
        measures.append(money.total(F.col("total_amount")).alias(revenue))
    made = orders.groupBy(F.window("created_at", "1 minute").alias("minute"), *keys).agg(*measures)
    return made.withColumn("window_start", F.col("minute.start")).select("window_start", *[c for c in made.columns if c != "minute"])


category_stats = partial(per_minute, "category_stats")
payment_stats = partial(per_minute, "payment_stats")
age_payment_stats = partial(per_minute, "age_payment_stats")


def user_totals(orders: DataFrame) -> DataFrame:
    """All-time orders, spend and mean ticket per customer."""
    return orders.groupBy("user_id").agg(
        F.count("order_id").alias("total_count"),
        money.total(F.col("total_amount")).alias("total_spent"),
        money.mean(F.col("total_amount")).alias("avg_ticket"),
    )


def abnormal_panes(orders: DataFrame, limit: float = fixed.ABNORMAL_AMOUNT, step: str = "1 minute") -> DataFrame:
    """Abnormal orders in each pane, a slot as long as windows are apart; what a stream keeps, whatever the windows' width."""
    panes = orders.where(checks.abnormal_amount(F.col("total_amount"), limit)).groupBy(F.window("created_at", step)).agg(F.count(F.lit(1)).alias("abnormal_orders"))
    return panes.select(F.col("window.start").alias("pane_start"), "abnormal_orders")


def windows_of_panes(panes: DataFrame, width: str = "10 minutes", step: str = "1 minute") -> DataFrame:
    """Windows that slide by ``step``, each the sum of its panes; ``width`` is a multiple of ``step``."""
    width, step = F.expr(f"INTERVAL {width}"), F.expr(f"INTERVAL {step}")
    starts = F.explode(F.sequence(F.col("pane_start") - width + step, F.col("pane_start"), step))  # of a pane, not of an order
    made = panes.select(starts.alias("window_start"), "abnormal_orders").groupBy("window_start").agg(F.sum("abnormal_orders").alias("abnormal_orders"))
    return made.select("window_start", (F.col("window_start") + width).alias("window_end"), "abnormal_orders")


def abnormal_windows(orders: DataFrame, limit: float = fixed.ABNORMAL_AMOUNT, width: str = "10 minutes", step: str = "1 minute") -> DataFrame:
    """Abnormal orders in a window that slides by ``step``."""
    return windows_of_panes(abnormal_panes(orders, limit, step), width, step)


def alert_spans(windows: DataFrame, least: int = 1, step: str = "1 minute") -> DataFrame:
    """One row for each alert: opened with the first window of at least ``least`` orders, closed with the last in an unbroken row.

    An alert is a session of windows ``step`` apart, so it opens and closes once, on a stream of windows too.
    """
    busy = windows.where(F.col("abnormal_orders") >= least).groupBy(F.session_window("window_start", step).alias("alert"))
    found = busy.agg(F.max("window_end").alias("closed_at"), F.max("abnormal_orders").alias("most_orders"), F.count(F.lit(1)).alias("windows"))
    return found.select(F.col("alert.start").alias("opened_at"), "closed_at", "most_orders", "windows")


# name -> (aggregation, key columns of its result)
STATISTICS = {
    "category_stats": (category_stats, ["window_start", "category"]),
    "payment_stats": (payment_stats, ["window_start", "payment_method"]),
    "age_payment_stats": (age_payment_stats, ["window_start", "user_age_group", "payment_method"]),
    "user_totals": (user_totals, ["user_id"]),
    "abnormal_windows": (abnormal_windows, ["window_start"]),
}

# name -> (aggregation that a stream keeps, its key, how a reader makes the statistic of it)
KEPT = {name: (aggregate, key, None) for name, (aggregate, key) in STATISTICS.items()}
KEPT["abnormal_windows"] = (abnormal_panes, ["pane_start"], windows_of_panes)
