from calendar import monthrange
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed
from ordermill.functions import times
from ordermill.operators import planning


def week_of_month(day):
    return min(4, (day.day + day.replace(day=1).weekday() - 1) // 7 + 1)


def test_calendar_plan_of_a_year(spark):
    got = {r["day"]: r for r in planning.calendar_plan(planning.days_between(spark, "2025-01-01", "2025-12-31")).collect()}
    assert len(got) == 365
    for n in range(365):
        day = date(2025, 1, 1) + timedelta(days=n)
        base, weeks = fixed.MONTH_PLAN[day.month]
        scenario, weight = weeks[week_of_month(day) - 1]
        factor = 1.3 if day.weekday() >= 5 else 1.15 if day.weekday() == 4 else 0.95
        assert got[day]["week"] == week_of_month(day)
        assert got[day]["scenario_id"] == scenario
        assert got[day]["planned_orders"] == int(base / monthrange(2025, day.month)[1] * weight * factor)


def test_missing_week_uses_the_baseline(spark):
    plan = planning.plan_table(spark, {1: (3100, [(13, 0.5)])})
    got = {r["day"].day: r for r in planning.calendar_plan(planning.days_between(spark, "2025-01-01", "2025-01-08"), plan).collect()}
    assert got[1]["scenario_id"] == 13 and got[1]["planned_orders"] == int(100 * 0.5 * 0.95)
    assert got[8]["scenario_id"] == 0 and got[8]["planned_orders"] == 95


def test_a_month_without_a_plan_keeps_its_days(spark):
    plan = planning.plan_table(spark, {1: (3100, [(13, 0.5)])})
    got = planning.calendar_plan(planning.days_between(spark, "2025-01-30", "2025-02-02"), plan).orderBy("day").collect()
    assert [(r["scenario_id"], r["planned_orders"] > 0) for r in got] == [(0, True), (0, True), (0, False), (0, False)]


@pytest.mark.parametrize("week", [1, 5])
def test_a_plan_that_cannot_be_met_is_an_error(spark, week):
    plan = planning.plan_table(spark, {1: (3100, [(13, 0.5)])}).unionByName(spark.createDataFrame([(1, week, 3100, 2, 1.0)], "month int, week int, base_orders int, scenario_id int, weight double"))
    with pytest.raises(Exception, match="plan weeks"):
        planning.calendar_plan(planning.days_between(spark, "2025-01-01", "2025-01-08"), plan).collect()


@pytest.mark.parametrize("exact", [False, True])
def test_hourly_allocation(spark, exact):
    days = [0, 1, 5, 23, 100, 299, 1000, 12345]
    daily = spark.createDataFrame([(d, d) for d in days], "day int, orders int")
    out = planning.hourly_allocation(daily, exact=exact).collect()
    whole = sum(fixed.HOUR_VOLUME)
    for d in days:
        got = {r["hour"]: r["hour_orders"] for r in out if r["day"] == d}
        cut = {h: int(d * (v / whole)) for h, v in enumerate(fixed.HOUR_VOLUME)}
        left = d - sum(cut.values())
        if exact:
            assert sum(got.values()) == d and all(got[h] - cut[h] in (0, 1) for h in got)
        else:
            for hour in [20, 19, 18, 21][:max(left, 0)]:
                cut[hour] += 1
            assert got == cut


def test_plan_vs_actual_keeps_both_sides(spark, rows):
    planned = spark.createDataFrame([(date(2025, 1, 1), 13, 5), (date(2025, 1, 2), 4, 7)], "day date, scenario_id int, planned_orders int")
    orders = spark.createDataFrame([(datetime(2025, 1, 2, 3),), (datetime(2025, 1, 3, 4),), (datetime(2025, 1, 3, 5),)], "created_at timestamp_ntz")
    assert rows(planning.plan_vs_actual(planned, orders)) == [
        (date(2025, 1, 1), 13, 5, 0, -5), (date(2025, 1, 2), 4, 7, 1, -6), (date(2025, 1, 3), 0, 0, 2, 2)
    ]


def test_time_expressions(spark):
    ts = spark.createDataFrame([(datetime(2024, 3, 31, 23, 59, 59),), (datetime(2024, 9, 1, 0, 4, 0),)], "ts timestamp_ntz")
    got = ts.select(
        times.bucket_start(F.col("ts"), 5), times.bucket_start(F.col("ts"), 5, -9), times.sunday_first(F.col("ts")),
        times.weekday_label(F.col("ts")), times.hour_label(F.col("ts")), times.week_of_month(F.col("ts").cast("date")),
    ).collect()
    assert tuple(got[0]) == (datetime(2024, 3, 31, 23, 55), datetime(2024, 3, 31, 14, 55), 0, "일", "23시", 4)
    assert tuple(got[1]) == (datetime(2024, 9, 1, 0, 0), datetime(2024, 8, 31, 15, 0), 0, "일", "0시", 1)
