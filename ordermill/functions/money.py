"""Money expressions.  Money is summed as DECIMAL so that totals do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def total(value: Column) -> Column:
    return F.sum(value)


def mean(value: Column) -> Column:
    """Average as DOUBLE: one exact sum, one division."""
    return F.sum(value).cast("double") / F.count(value)


def order_amount(price: Column, quantity: Column, shipping: Column, discount: Column) -> Column:
    """What the customer pays, never below zero."""
    due = price * quantity + shipping - discount
    return F.greatest(due, F.lit(0).cast("decimal(18,2)"))


def discount_rate(org_price: Column, price: Column) -> Column:
    return F.when(org_price > price, (org_price - price).cast("double") / org_price.cast("double")).otherwise(F.lit(0.0))


def floor_to_hundred(value: Column) -> Column:
    return (F.floor(value / 100) * 100).cast("bigint")
