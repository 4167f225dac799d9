"""Demand plan per day and hour, and its comparison with what happened."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed
from ordermill.functions import times
from ordermill.functions.times import Moment, moment


def plan_table(spark, plan=None) -> DataFrame:
    """(month, week, base_orders, scenario_id, weight), one row per month and week."""
    rows = [
        (month, week, orders, scenario, weight)
        for month, (orders, weeks) in (plan or fixed.MONTH_PLAN).items()
        for week, (scenario, weight) in enumerate(weeks, start=1)
    ]
    return spark.createDataFrame(rows, "month int, week int, base_orders int, scenario_id int, weight double")


def days_between(spark, start: Moment, end: Moment) -> DataFrame:
    """All days from start to end, both included."""
    first, last = [F.lit(moment(x).date().isoformat()).cast("date") for x in (start, end)]
    return spark.range(1).select(F.explode(F.sequence(first, last)).alias("day"))


def calendar_plan(days: DataFrame, plan: DataFrame | None = None) -> DataFrame:
    """Planned orders per day: month target / days x week weight x weekday factor, cut to an integer.

    A week without an entry uses scenario 0 with weight 1, a month without any is planned at 0 orders.  A month and
    week given twice, or a week that no day has (they are 1 to 4), is an error.
    """
    plan = plan_table(days.sparkSession) if plan is None else plan
    day = F.col("day")
    month_base = plan.groupBy("month").agg(
        F.max("base_orders").alias("base_orders"),
        F.sort_array(F.collect_list(F.struct("week", "scenario_id", "weight"))).alias("_weeks"),
    )
    given = F.transform("_weeks", lambda w: w["week"])
    wrong = (F.size(F.array_distinct(given)) < F.size(given)) | F.exists(given, lambda w: ~w.between(1, 4))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("plan weeks must be 1 to 4, once a month; month "), F.col("month").cast("string"))).cast("int"))
    month_base = month_base.withColumn("base_orders", checked.otherwise(F.col("base_orders")))
    own = F.get(F.filter("_weeks", lambda w: w["week"] == F.col("week")), F.lit(0))
    daily = F.col("base_orders") / F.dayofmonth(F.last_day(day)) * F.coalesce(own["weight"], F.lit(1.0)) * times.weekday_factor(day)
    return (
        days.withColumn("month", F.month(day))
        .withColumn("week", times.week_of_month(day))
        .join(month_base, "month", "left")
        .select("day", "week", F.coalesce(own["scenario_id"], F.lit(0)).alias("scenario_id"),
                F.coalesce(F.floor(daily).cast("int"), F.lit(0)).alias("planned_orders"))
    )


def hourly_allocation(daily: DataFrame, orders: str = "orders", exact: bool = False, volume=None) -> DataFrame:
    """Daily orders spread over the hours by their usual volume.

    Shares are cut to integers.  By default four evening hours may take one order each from the
    remainder and the rest of it is dropped; ``exact`` hands out all of it by largest remainder.
    Works row by row: 24 numbers per day, no join and no shuffle.
    """
    volume = volume or fixed.HOUR_VOLUME
    whole = sum(volume)
    shares = F.array(*[F.col(orders) * F.lit(v / whole) for v in volume])
    cut = F.transform(shares, lambda s: F.floor(s).cast("bigint"))
    spread = daily.withColumn("_shares", shares).withColumn("_cut", cut)
    given = F.aggregate("_cut", F.lit(0).cast("bigint"), lambda a, x: a + x)
    spread = spread.withColumn("_left", F.col(orders) - given)
    if exact:
        rest = F.transform(
            "_cut", lambda c, h: F.struct((c - F.get("_shares", h)).alias("lack"), h.cast("int").alias("hour"))
        )
        served = F.transform(F.sort_array(rest), lambda r: r["hour"])
    else:
        served = F.array(*[F.lit(h) for h in fixed.REMAINDER_HOURS])
    return (
        spread.withColumn("_served", served)
        .select(*[c for c in daily.columns], "_left", "_served", F.posexplode("_cut").alias("hour", "_orders"))
        .withColumn("_turn", F.array_position("_served", F.col("hour")))
        .withColumn(
            "hour_orders", F.col("_orders") + F.when((F.col("_turn") > 0) & (F.col("_turn") <= F.col("_left")), 1).otherwise(0)
        )
        .drop("_left", "_served", "_orders", "_turn")
    )


def plan_vs_actual(planned: DataFrame, orders: DataFrame) -> DataFrame:
    """Planned and actual orders per day; days of either side are kept."""
    actual = orders.groupBy(F.col("created_at").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("_actual"))
    plan, done = F.coalesce("planned_orders", F.lit(0)), F.coalesce("_actual", F.lit(0))
    return planned.join(actual, "day", "full").select(
        "day",
        F.coalesce("scenario_id", F.lit(0)).alias("scenario_id"),
        plan.alias("planned_orders"),
        done.alias("actual_orders"),
        (done - plan).alias("variance"),
    )


def scenario_effect(compared: DataFrame) -> DataFrame:
    """Planned against actual orders per scenario."""
    return compared.groupBy("scenario_id").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("planned_orders").alias("planned_orders"),
        F.sum("actual_orders").alias("actual_orders"),
        F.sum("variance").alias("variance"),
    )
