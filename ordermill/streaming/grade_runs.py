"""Membership grades run by run, each run reading what changed since the last.

A run's orders enter the customers' totals and are written down under the day they leave the window again; a later run takes
back what is due.  A customer whose grade is above what the totals give steps down once a run, so these pend.  A run
touches customers with an entry, an exit or a pending step and no others: it reads the orders of its days, the exits due,
the pending customers, and of the kept totals the buckets of those.  Every table is versioned by run, so a run that
is repeated finds the state it began with.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed
from ordermill.functions import grades as g
from ordermill.sources import sinks
from ordermill.sources.versions import BATCH, VersionedTable

BUCKETS = 256
MONEY = "decimal(28,2)"


def _bucket(user: str = "user_id"):
    return F.pmod(F.xxhash64(user), F.lit(BUCKETS)).cast("int")


class GradeRuns:
    """The runs kept in ``folder``; ``start`` once, then ``run`` with growing numbers from 0."""

    def __init__(self, spark: SparkSession, folder: str, lookback_days: int = fixed.GRADE_LOOKBACK_DAYS, rules: g.Rules = fixed.GRADES):
        self.spark, self.lookback, self.rules = spark, lookback_days, rules
        self.state = VersionedTable(spark, f"{folder}/state", ("bucket",))
        self.exits = VersionedTable(spark, f"{folder}/exits", ("leaves",))
        self.pending = VersionedTable(spark, f"{folder}/pending")
        self.changes = VersionedTable(spark, f"{folder}/changes")

    def start(self, users: DataFrame) -> None:
        """Customers (user_id, grade) as they are before the first run, with no orders counted; an unknown grade is the lowest."""
        rank = g.rank_of(F.col("grade"), self.rules)
        rows = users.select("user_id", F.lit(0).cast(MONEY).alias("amount"), F.lit(0).cast("long").alias("n"), rank.alias("rank"), _bucket().alias("bucket"))
        self.state.append(rows, -1)
        self.pending.append(rows.where("rank > 0").select("user_id"), -1)
        self.changes.append(rows.select("user_id", "rank"), -1)

    def _before(self, table: VersionedTable, run: int) -> DataFrame:
        return table.read().where(F.col(BATCH) < run)

    def touched(self, orders: DataFrame, run: int, day: date, previous: date | None) -> DataFrame:
        """user_id, amount and n to add, of every customer this run must look at."""
        after = day - timedelta(days=self.lookback + 1) if previous is None else previous
        when = F.col("created_at")
        new = orders.where((F.col("status") == fixed.SUCCESS) & (when >= F.lit((after + timedelta(days=1)).isoformat())) & (when < F.lit((day + timedelta(days=1)).isoformat())))
        leaves = F.date_add(when.cast("date"), self.lookback + 1).alias("leaves")
        entries = new.groupBy("user_id", leaves).agg(F.sum("total_amount").cast(MONEY).alias("amount"), F.count(F.lit(1)).alias("n"))
        self.exits.append(entries.where(F.col("user_id").isNotNull()), run)
        since = F.lit((previous or date.min).isoformat()).cast("date")
        due = self.exits.read().where((F.col("leaves") > since) & (F.col("leaves") <= F.lit(day.isoformat()).cast("date")) & (F.col(BATCH) <= run))
        mine = self.exits.read().where(F.col(BATCH) == run)
        waiting = max((p for p in self.pending.manifest().parts if p.last < run), key=lambda p: p.last)
        none = self.pending.read((waiting,)).select("user_id", F.lit(0).cast(MONEY).alias("amount"), F.lit(0).cast("long").alias("n"))
        back = due.select("user_id", (-F.col("amount")).alias("amount"), (-F.col("n")).alias("n"))
        every = mine.select("user_id", "amount", "n").unionByName(back).unionByName(none)
        return every.groupBy("user_id").agg(F.sum("amount").cast(MONEY).alias("more"), F.sum("n").alias("more_n"))

    def run(self, orders: DataFrame, run: int, day: date, previous: date | None = None) -> None:
        """The grades after ``day``, orders of that day included; ``previous`` is the day of the run before.

        Orders must be there by the run after their day; customers without state have no grade and are left out.
        """
        touched = self.touched(orders, run, day, previous).withColumn("bucket", _bucket()).persist()
        try:
            buckets = [r["bucket"] for r in touched.select("bucket").distinct().collect()]  # at most ``BUCKETS``
            held = sinks.newest_rows(self._before(self.state, run).where(F.col("bucket").isin(buckets)), ["user_id"])
            amount, n = F.col("amount") + F.col("more"), F.col("n") + F.col("more_n")
            target = g.target_rank(amount, n, self.rules)
            made = held.join(touched.drop("bucket"), "user_id").select(
                "user_id", amount.cast(MONEY).alias("amount"), n.alias("n"), g.stepped(F.col("rank"), target).alias("rank"),
                "bucket", F.col("rank").alias("_old"), target.alias("_target")).persist()
            try:
                self.state.append(made.drop("_old", "_target"), run)
                self.pending.append(made.where("rank > _target").select("user_id"), run)
                self.changes.append(made.where("rank <> _old").select("user_id", "rank"), run)
            finally:
                made.unpersist()
        finally:
            touched.unpersist()
        self.state.merge_levels(lambda log: sinks.newest_kept(log, ["user_id"]))
        for table in (self.exits, self.changes):
            table.merge_levels()
        latest = sorted(self.pending.manifest().parts, key=lambda p: p.last)[-2:]  # this run's, and the one a repeat begins with
        self.pending.commit(lambda old: replace(old, parts=tuple(latest)))
        for table in (self.state, self.exits, self.pending, self.changes):
            table.clean()

    def grades_after(self, run: int) -> DataFrame:
        """user_id and grade of every customer after that run."""
        newest = sinks.newest_rows(self._before(self.changes, run + 1), ["user_id"])
        return newest.select("user_id", g.name_of(F.col("rank"), self.rules).alias("grade"))
