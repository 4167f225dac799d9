"""Data-quality predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed


def out_of_stock(stock: Column) -> Column:
    return stock <= 0


def inconsistent_price(discount_rate: Column, price: Column, org_price: Column, max_rate: float = 100) -> Column:
    """NULL prices and rates never flag."""
    return (discount_rate < 0) | (discount_rate > max_rate) | (price > org_price)


def abnormal_amount(amount: Column, limit: float = fixed.ABNORMAL_AMOUNT) -> Column:
    return (amount < 0) | (amount >= limit)


def level(count: Column, steps: list[tuple[int, str]]) -> Column:
    """Label of the highest step that ``count`` reaches."""
    chain = None
    for start, label in sorted(steps, reverse=True):
        chain = F.when(count >= start, label) if chain is None else chain.when(count >= start, label)
    return chain
