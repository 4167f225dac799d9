"""Grade thresholds as expressions.  Ranks count from 0, the lowest grade."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed

Rules = list[tuple[str, float, int]]


def names(rules: Rules = fixed.GRADES) -> list[str]:
    """Lowest first."""
    return [name for name, _, _ in reversed(rules)]


def target_rank(amount: Column, orders: Column, rules: Rules = fixed.GRADES) -> Column:
    """Best grade of which both thresholds are met, else the lowest."""
    chain = None
    for rank, (_, min_amount, min_orders) in reversed(list(enumerate(reversed(rules)))):
        met = (amount >= min_amount) & (orders >= min_orders)
        chain = F.when(met, rank) if chain is None else chain.when(met, rank)
    return chain.otherwise(0)


def rank_of(grade: Column, rules: Rules = fixed.GRADES) -> Column:
    """Rank of a stored grade; an unknown or missing one counts as the lowest."""
    chain = None
    for rank, name in enumerate(names(rules)):
        chain = F.when(grade == name, rank) if chain is None else chain.when(grade == name, rank)
    return chain.otherwise(0)


def name_of(rank: Column, rules: Rules = fixed.GRADES) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names(rules)]), rank + 1)


def assign_grade(amount: Column, orders: Column, rules: Rules = fixed.GRADES) -> Column:
    return name_of(target_rank(amount, orders, rules), rules)


def stepped(old_rank: Column, target: Column) -> Column:
    """Up at once, down by one step."""
    return F.greatest(target, old_rank - 1)


def segment(amount: Column, orders: Column) -> Column:
    vip = (amount >= fixed.SEGMENT_VIP_AMOUNT) & (orders >= fixed.SEGMENT_VIP_ORDERS)
    return (
        F.when(vip, fixed.SEGMENT_VIP)
        .when(amount >= fixed.SEGMENT_REGULAR_AMOUNT, fixed.SEGMENT_REGULAR)
        .otherwise(fixed.SEGMENT_DORMANT)
    )
