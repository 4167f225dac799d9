"""Reproducible random numbers: a hash of the row's id and a seed, equal on every run and retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = 4294967296.0  # 2**32


def digest(key: Column, seed: int | str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))


def draw32(key: Column, seed: int | str) -> Column:
    """Integer, uniform in [0, 2**32); a NULL key draws 0, so the result never is NULL."""
    return F.coalesce(F.conv(F.substring(digest(key, seed), 1, 8), 16, 10).cast("bigint"), F.lit(0).cast("bigint"))


def draw64(key: Column, seed: int | str) -> Column:
    """Whole number (decimal), uniform in [0, 2**64); a NULL key draws 0."""
    return F.coalesce(F.conv(F.substring(digest(key, seed), 1, 16), 16, 10).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))


def below(key: Column, total: int, seed: int | str) -> Column:
    """Whole number, uniform in [0, total), for totals below 10**18: exact, and every number can be drawn up to 2**64 of them."""
    scaled, whole = draw64(key, seed) * F.lit(total).cast("decimal(18,0)"), F.lit(str(1 << 64)).cast("decimal(20,0)")
    return ((scaled - scaled % whole) / whole).cast("bigint")  # a whole quotient, so the division is exact


def uniform(key: Column, seed: int | str) -> Column:
    """Double, uniform in [0, 1)."""
    return draw32(key, seed) / F.lit(SPAN)


def percent(key: Column, seed: int | str) -> Column:
    """Integer, uniform in 0 to 99."""
    return draw32(key, seed) % 100


def race(key: Column, weight: Column, seed: int | str) -> Column:
    """Arrival time with rate ``weight``: the smallest n are a weighted sample without replacement."""
    return -F.log((draw32(key, seed) + F.lit(0.5)) / F.lit(SPAN)) / weight
