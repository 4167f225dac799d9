"""Customer analytics: spend per customer, grades, segments, best customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed
from ordermill.functions import grades as g
from ordermill.functions import money, times
from ordermill.functions.times import Moment
from ordermill.session import settle

BINS = 1024  # of a round of ``least_of_top``; the driver gets a row for each
LAST_VALUES = 4096  # rows of a bin whose different values are told apart in one more round


def spend_per_user(orders: DataFrame, since: Moment | None = None, success_only: bool = True) -> DataFrame:
    """user_id, total_amount, order_count; partial sums keep a very active customer cheap."""
    kept = orders if since is None else orders.where(times.on_or_after(F.col("created_at"), since))
    if success_only:
        kept = kept.where(F.col("status") == fixed.SUCCESS)
    return kept.groupBy("user_id").agg(
        money.total(F.col("total_amount")).alias("total_amount"), F.count("order_id").alias("order_count")
    )


def _per_grade(orders: DataFrame, since: Moment | None, rules: g.Rules) -> DataFrame:
    """One row per grade (as many rows as ``rules`` has)."""
    return (
        spend_per_user(orders, since)
        .groupBy(g.target_rank(F.col("total_amount"), F.col("order_count"), rules).alias("rank"))
        .agg(F.count("user_id").alias("customers"), F.sum("total_amount").alias("revenue"), F.count(F.lit(1)).alias("rows"))
    )


def grade_detail(orders: DataFrame, since: Moment | None = None, rules: g.Rules = fixed.GRADES) -> DataFrame:
    """Customers, share, revenue and mean revenue per grade, best grade first."""
    per_grade = _per_grade(orders, since, rules)
    everyone = per_grade.agg(F.sum("customers")).scalar()
    return per_grade.orderBy(F.desc("rank")).select(
        g.name_of(F.col("rank"), rules).alias("grade"),
        "customers",
        F.round(F.col("customers") * 100.0 / everyone, 1).cast("double").alias("share"),
        "revenue",
        F.round(F.col("revenue").cast("double") / F.col("rows"), 0).alias("revenue_per_customer"),
    )


def grade_distribution(orders: DataFrame, since: Moment | None = None, rules: g.Rules = fixed.GRADES) -> DataFrame:
    return _per_grade(orders, since, rules).orderBy("rank").select(
        g.name_of(F.col("rank"), rules).alias("grade"), F.col("rows").alias("customers")
    )


def grade_revenue(orders: DataFrame, since: Moment | None = None, rules: g.Rules = fixed.GRADES) -> DataFrame:
    return _per_grade(orders, since, rules).orderBy("rank").select(g.name_of(F.col("rank"), rules).alias("grade"), "revenue")


def stored_grade_counts(users: DataFrame) -> DataFrame:
    return users.groupBy("grade").agg(F.count(F.lit(1)).alias("customers")).orderBy(F.desc("customers"), "grade")


def _per_segment(orders: DataFrame, as_of: Moment, days: int) -> DataFrame:
    """All statuses count; customers without an order in the window do not appear."""
    recent = orders.where(times.within(F.col("created_at"), as_of, days=days))
    spend = recent.groupBy("user_id").agg(
        F.coalesce(money.total(F.col("total_amount")), F.lit(0)).alias("total_amount"),
        F.count(F.lit(1)).alias("order_count"),
    )
    return spend.groupBy(g.segment(F.col("total_amount"), F.col("order_count")).alias("segment")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum("total_amount").alias("revenue")
    )


def segment_distribution(orders: DataFrame, as_of: Moment, days: int = 30) -> DataFrame:
    return _per_segment(orders, as_of, days).select("segment", "customers").orderBy(F.desc("customers"), "segment")


def segment_revenue(orders: DataFrame, as_of: Moment, days: int = 30) -> DataFrame:
    return _per_segment(orders, as_of, days).select("segment", "revenue").orderBy(F.desc("revenue"), "segment")


def least_of_top(values: DataFrame, column: str, fraction: float, bins: int = BINS):
    """The smallest value of ``column`` whose PERCENT_RANK, largest first, is at most ``fraction``; None without a value.

    A round cuts the range of values that is still open into ``bins`` equal ones and counts them, with the least and
    greatest value of each; the bin in which the cutoff must lie is the next range.  Its ends are values, so every round takes
    some away, and a bin of one value, or of ``LAST_VALUES`` rows, ends it.  No value is estimated, nothing is sorted, and
    a task sees rows or counts of bins.
    """
    value = F.col(column)
    n, low, high = values.agg(F.count(value), F.min(value), F.max(value)).first()
    if not n or fraction < 0:
        return None
    above, rows, exact = 0, n, "decimal(20,0)" if isinstance(low, int) else None  # differences of whole numbers may exceed their type
    fits = lambda larger: larger / max(n - 1, 1) <= fraction
    while low != high and low == low:  # a value that differs from itself is not a number, in Spark the greatest
        inside = values.where(value.between(F.lit(low), F.lit(high)))
        if rows <= LAST_VALUES:
            counts = inside.groupBy(value.alias("low")).agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("high"), F.max(value).alias("bin")).collect()
        else:
            from_low = (lambda x: (x.cast(exact) - F.lit(low).cast(exact)).cast("double")) if exact else lambda x: (x - F.lit(low)).cast("double")
            share = from_low(value) / from_low(F.lit(high))
            number = F.least(F.floor(share * bins), F.lit(bins - 1))
            ends = [F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")]
            counts = inside.groupBy(number.alias("bin")).agg(*ends).collect()
            if len(counts) == 1:  # the range ends in no number or without bound: its end is a bin, the rest another
                counts = inside.groupBy((value == F.lit(high)).cast("int").alias("bin")).agg(*ends).collect()
        before = above
        for held in sorted(counts, key=lambda r: r["bin"], reverse=True):
            if not fits(before):
                break
            low, high, above, rows = held["low"], held["high"], before, held["n"]
            before += held["n"]
    return low


def at_least_top(values: DataFrame, column: str, fraction: float, bins: int = BINS) -> DataFrame:
    """Rows whose PERCENT_RANK by ``column``, largest first, is at most ``fraction``; exact, ties included.

    Reads ``values`` a few times, so it should be cheap to read (see ``settle``).  Rows without a value go.
    """
    cutoff = least_of_top(values, column, fraction, bins)
    return values.where(F.lit(False) if cutoff is None else F.col(column) >= F.lit(cutoff))


def top_fraction_customers(
    orders: DataFrame, users: DataFrame, since: Moment | None = None, fraction: float = 0.2
) -> DataFrame:
    """Best customers by revenue: the share ``fraction`` by percent rank, ties included."""
    buyers = spend_per_user(orders, since).join(users.select("user_id"), "user_id", "left_semi")
    best = at_least_top(settle(buyers), "total_amount", fraction)
    return (
        best.join(users.select("user_id", "name", "email"), "user_id")
        .select("user_id", "name", "email", F.col("total_amount").alias("revenue"), F.col("order_count").alias("orders"))
        .orderBy(F.desc("revenue"), "user_id")
    )
