import random
from datetime import date, datetime, timedelta

from ordermill import fixed_values as fixed
from ordermill.functions import grades as g
from ordermill.operators import customers, grades
from ordermill.streaming import grade_runs
from pyspark.sql import functions as F

ORDERS = "order_id int, user_id string, created_at timestamp_ntz, total_amount decimal(18,2), status string"


def test_thresholds_need_both_conditions(spark):
    cases = [
        (5_000_000, 30, "VIP"), (5_000_000, 29, "GOLD"), (4_999_999, 30, "GOLD"), (2_000_000, 15, "GOLD"),
        (2_000_000, 14, "SILVER"), (500_000, 5, "SILVER"), (500_000, 4, "BRONZE"), (499_999, 99, "BRONZE"), (0, 0, "BRONZE"),
    ]
    df = spark.createDataFrame(cases, "amount long, n int, expected string")
    got = df.select(g.assign_grade(F.col("amount"), F.col("n")).alias("grade"), "expected").collect()
    assert all(r["grade"] == r["expected"] for r in got)


def test_promotion_at_once_demotion_by_one_step(spark):
    users = spark.createDataFrame(
        [("vip_idle", "VIP"), ("gold_idle", "GOLD"), ("bronze_idle", "BRONZE"), ("jump", "BRONZE"), ("odd", "PLATINUM"), ("none", None)],
        "user_id string, grade string",
    )
    day = datetime(2025, 6, 1)
    orders = spark.createDataFrame([(i, "jump", day, 200_000, "Success") for i in range(30)] + [(99, "vip_idle", day, 9_999_999, "Cancelled")], ORDERS.replace("decimal(18,2)", "int"))
    out = {r["user_id"]: (r["new_grade"], r["change"]) for r in grades.update_grades(users, orders, "2025-06-30").collect()}
    assert out == {
        "vip_idle": ("GOLD", "downgraded"), "gold_idle": ("SILVER", "downgraded"), "bronze_idle": ("BRONZE", "unchanged"),
        "jump": ("VIP", "upgraded"), "odd": ("BRONZE", "unchanged"), "none": ("BRONZE", "unchanged"),
    }
    stats = grades.grade_update_stats(grades.update_grades(users, orders, "2025-06-30")).first().asDict()
    assert stats == {"total_users": 6, "upgraded": 1, "downgraded": 2, "unchanged": 3, "vip": 1, "gold": 1, "silver": 1, "bronze": 3}


def test_lookback_edge_and_upper_bound(spark):
    users = spark.createDataFrame([("u", "BRONZE")], "user_id string, grade string")
    as_of = datetime(2025, 7, 1)
    edge = as_of - timedelta(days=180)
    make = lambda ts: spark.createDataFrame([(i, "u", ts, 100_000, "Success") for i in range(5)], ORDERS.replace("decimal(18,2)", "int"))
    grade = lambda orders, **kw: grades.update_grades(users, orders, as_of, **kw).first()["new_grade"]
    assert grade(make(edge)) == "SILVER"
    assert grade(make(edge - timedelta(seconds=1))) == "BRONZE"
    assert grade(make(as_of + timedelta(days=1))) == "SILVER"  # no upper bound by default
    assert grade(make(as_of + timedelta(days=1)), until=as_of) == "BRONZE"


def test_history_equals_run_by_run_updates(spark):
    rng = random.Random(3)
    rules = [("VIP", 500, 6), ("GOLD", 300, 4), ("SILVER", 100, 2), ("BRONZE", 0, 0)]
    users = [(f"u{i}", rng.choice(["BRONZE", "SILVER", "GOLD", "VIP", "?"])) for i in range(25)]
    start = date(2025, 1, 1)
    orders = [
        (i, f"u{rng.randrange(28)}", datetime(2025, 1, 1) + timedelta(hours=rng.randrange(24 * 120)), rng.randrange(1, 150), rng.choice(["Success", "Success", "Cancelled"]))
        for i in range(900)
    ]
    runs = grades.run_calendar(start, date(2025, 4, 23), 7)  # ends with two runs on one day
    assert runs[-1] == runs[-2]
    users_df = spark.createDataFrame(users, "user_id string, grade string")
    orders_df = spark.createDataFrame([(i, u, t, a, s) for i, u, t, a, s in orders], ORDERS.replace("decimal(18,2)", "int"))
    got = {(r["user_id"], r["run"]): r["grade"] for r in grades.grade_history(users_df, orders_df, runs, 30, rules).collect()}

    names = ["BRONZE", "SILVER", "GOLD", "VIP"]
    expected = {}
    for user, grade in users:
        rank = names.index(grade) if grade in names else 0
        for number, run in enumerate(runs, 1):
            mine = [a for _, u, t, a, s in orders if u == user and s == "Success" and run - timedelta(days=30) <= t.date() <= run]
            target = next(3 - i for i, (_, amount, n) in enumerate(rules) if sum(mine) >= amount and len(mine) >= n)
            new = target if target >= rank else rank - 1
            assert new >= rank - 1
            rank = new
            expected[user, number] = names[rank]
    assert got == expected


def test_run_calendar_ends_with_the_last_day():
    runs = grades.run_calendar("2025-01-01", "2025-12-31")
    assert runs[0] == date(2025, 1, 8) and runs[-2:] == [date(2025, 12, 31)] * 2 and len(runs) == 53
    leap = grades.run_calendar("2024-01-01", "2024-12-31")
    assert leap[-2:] == [date(2024, 12, 30), date(2024, 12, 31)]


def test_segments(spark):
    now = datetime(2025, 6, 30)
    orders = spark.createDataFrame(
        [(i, "vip", now, 200_000, "Cancelled") for i in range(30)] + [(40, "regular", now, 10_000, "Success"), (41, "small", now, 9_999, "Success"),
         (42, "gone", now - timedelta(days=31), 99_999, "Success")], ORDERS.replace("decimal(18,2)", "int"),
    )
    got = {r["segment"]: r["customers"] for r in customers.segment_distribution(orders, now).collect()}
    assert got == {fixed.SEGMENT_VIP: 1, fixed.SEGMENT_REGULAR: 1, fixed.SEGMENT_DORMANT: 1}


def test_runs_that_read_changes_alone_equal_the_full_history(spark, tmp_path):
    rng = random.Random(6)
    rules = [("VIP", 500, 6), ("GOLD", 300, 4), ("SILVER", 100, 2), ("BRONZE", 0, 0)]
    users = [(f"u{i}", rng.choice(["BRONZE", "SILVER", "GOLD", "VIP", "?"])) for i in range(40)]
    orders = [
        (i, f"u{rng.randrange(43)}" if i % 50 else None, datetime(2024, 12, 10) + timedelta(hours=rng.randrange(24 * 70)), rng.randrange(1, 150), rng.choice(["Success", "Success", "Cancelled"]))
        for i in range(700)
    ]
    runs = [*grades.run_calendar(date(2025, 1, 1), date(2025, 2, 5), 7), date(2025, 3, 20), date(2025, 3, 27)]  # two on one day, a long gap, no orders
    users_df = spark.createDataFrame(users, "user_id string, grade string")
    orders_df = spark.createDataFrame(orders, ORDERS.replace("decimal(18,2)", "int")).withColumn("total_amount", F.col("total_amount").cast("decimal(18,2)"))
    full = {(r["user_id"], r["run"]): r["grade"] for r in grades.grade_history(users_df, orders_df, runs, 30, rules).collect()}
    kept = grade_runs.GradeRuns(spark, str(tmp_path / "runs"), 30, rules)
    kept.start(users_df)
    for number, day in enumerate(runs):
        for _ in range(2 if number in (2, 5) else 1):  # repeated runs
            kept.run(orders_df, number, day, runs[number - 1] if number else None)
        assert {r["user_id"]: r["grade"] for r in kept.grades_after(number).collect()} == {u: full[u, number + 1] for u, _ in users}
    touched = kept.touched(orders_df, len(runs), date(2025, 4, 3), runs[-1]).count()  # all has left the window: who is demoted still
    assert touched == sum(full[u, len(runs)] != "BRONZE" for u, _ in users) < len(users)
