"""Membership grades: one run, its statistics, and the history over a calendar of runs."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed
from ordermill.functions import grades as g
from ordermill.functions import money, times
from ordermill.functions.times import Moment, moment


def update_grades(
    users: DataFrame,
    orders: DataFrame,
    as_of: Moment,
    lookback_days: int = fixed.GRADE_LOOKBACK_DAYS,
    rules: g.Rules = fixed.GRADES,
    until: Moment | None = None,
) -> DataFrame:
    """New grade of every customer from the successful orders of the last ``lookback_days``.

    Promotion is immediate, demotion one step per run.  Customers without orders count as (0, 0).
    ``until`` adds an upper bound on the order time; there is none by default.
    """
    ts = F.col("created_at")
    spend = (
        orders.where(
            (F.col("status") == fixed.SUCCESS)
            & times.within(ts, as_of, days=lookback_days)
            & times.before(ts, until)
        )
        .groupBy("user_id")
        .agg(money.total(F.col("total_amount")).alias("total_amount"), F.count("order_id").alias("order_count"))
    )
    amount = F.coalesce(F.col("total_amount"), F.lit(0))
    count = F.coalesce(F.col("order_count"), F.lit(0))
    old = g.rank_of(F.col("grade"), rules)
    new = g.stepped(old, g.target_rank(amount, count, rules))
    return (
        users.select("user_id", "grade")
        .join(spend, "user_id", "left")
        .select(
            "user_id",
            F.col("grade").alias("old_grade"),
            g.name_of(new, rules).alias("new_grade"),
            F.when(new > old, "upgraded").when(new < old, "downgraded").otherwise("unchanged").alias("change"),
        )
    )


def grade_update_stats(updated: DataFrame, rules: g.Rules = fixed.GRADES) -> DataFrame:
    """Totals of one run, in one pass."""
    changes = [F.count_if(F.col("change") == c).alias(c) for c in ("upgraded", "downgraded", "unchanged")]
    per_grade = [F.count_if(F.col("new_grade") == name).alias(name.lower()) for name, _, _ in rules]
    return updated.agg(F.count(F.lit(1)).alias("total_users"), *changes, *per_grade)


def run_calendar(start: Moment, end: Moment, every_days: int = fixed.GRADE_RUN_INTERVAL_DAYS) -> list[date]:
    """Run days: every ``every_days`` after ``start``, then a closing run on ``end``.

    When the pace itself falls on ``end`` that day has two runs, each of which may demote.
    """
    first, last = moment(start).date(), moment(end).date()
    paced = range(every_days, (last - first).days + 1, every_days)
    return [first + timedelta(days=n) for n in paced] + [last]


def _reach(spark, runs: list[date], lookback_days: int) -> DataFrame:
    """Per calendar day, the first and last run whose window holds it.  Bounded by the calendar."""
    lookback = timedelta(days=lookback_days)
    days = [runs[0] - lookback + timedelta(days=n) for n in range((runs[-1] - runs[0]).days + lookback_days + 1)]
    spans = [(day, bisect_left(runs, day), bisect_right(runs, day + lookback) - 1) for day in days]
    rows = [span for span in spans if span[1] <= span[2]]
    return spark.createDataFrame(rows, "day date, first_run int, last_run int")


def grade_history(
    users: DataFrame,
    orders: DataFrame,
    runs: list[date],
    lookback_days: int = fixed.GRADE_LOOKBACK_DAYS,
    rules: g.Rules = fixed.GRADES,
) -> DataFrame:
    """Grade of every customer after every run (numbered from 1), orders of the run day included.

    A window total changes only when an order enters or leaves, so each order adds its amount at the
    first run that sees it and takes it back after the last; running sums give the totals of all runs
    without repeating an order per run.  The one-step demotion unrolls as well: with targets t and start
    grade g, the grade after run r is max(t_0 + 0, ..., t_r + r, g - 1) - r, a running maximum.
    Orders shrink to one row per customer and pair of runs before anything is sorted.
    """
    spark = users.sparkSession
    runs = sorted(runs)
    ts = F.col("created_at")
    first_day = runs[0] - timedelta(days=lookback_days)
    seen = (
        orders.where(
            (F.col("status") == fixed.SUCCESS)
            & times.on_or_after(ts, first_day)
            & times.before(ts, runs[-1] + timedelta(days=1))
        )
        .select("user_id", ts.cast("date").alias("day"), F.col("total_amount").alias("amount"))
        .join(F.broadcast(_reach(spark, runs, lookback_days)), "day")
        .groupBy("user_id", "first_run", "last_run")
        .agg(F.sum("amount").cast("decimal(28,2)").alias("amount"), F.count(F.lit(1)).alias("n"))
    )
    enter = F.struct(F.col("first_run").alias("run"), F.col("amount"), F.col("n"))
    leave = F.struct((F.col("last_run") + 1).alias("run"), (-F.col("amount")).alias("amount"), (-F.col("n")).alias("n"))
    steps = seen.select("user_id", F.inline(F.array(enter, leave))).where(F.col("run") < len(runs))
    grid = users.select(
        "user_id",
        F.explode(F.sequence(F.lit(0), F.lit(len(runs) - 1))).alias("run"),
        F.lit(0).cast("decimal(28,2)").alias("amount"),
        F.lit(0).cast("bigint").alias("n"),
        g.rank_of(F.col("grade"), rules).alias("start_rank"),
    )
    per_run = (
        steps.withColumn("start_rank", F.lit(None).cast("int"))
        .unionByName(grid)
        .repartition("user_id")  # the grouping and the windows below all reuse this one exchange
        .groupBy("user_id", "run")
        .agg(F.sum("amount").alias("amount"), F.sum("n").alias("n"), F.max("start_rank").alias("start_rank"))
        .where(F.col("start_rank").isNotNull())  # orders of unknown customers have no grade
    )
    so_far = Window.partitionBy("user_id").orderBy("run").rowsBetween(Window.unboundedPreceding, 0)
    totals = per_run.select(
        "user_id", "run", "start_rank", F.sum("amount").over(so_far).alias("amount"), F.sum("n").over(so_far).alias("n")
    )
    target = g.target_rank(F.col("amount"), F.col("n"), rules)
    ranked = totals.select(
        "user_id",
        "run",
        (F.greatest(F.max(target + F.col("run")).over(so_far), F.col("start_rank") - 1) - F.col("run")).alias("rank"),
    )
    days = F.array(*[F.lit(d.isoformat()).cast("date") for d in runs])
    return ranked.select(
        "user_id",
        (F.col("run") + 1).alias("run"),
        F.element_at(days, F.col("run") + 1).alias("run_date"),
        g.name_of(F.col("rank"), rules).alias("grade"),
    )
