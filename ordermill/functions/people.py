"""Expressions on customer attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill import fixed_values as fixed


def known_age(age: Column) -> Column:
    """An age of 0 counts as missing."""
    return F.when(age != 0, age)


def age_decade(age: Column, default: str = fixed.UNKNOWN) -> Column:
    """20대, 30대, 60대, ...; missing ages give ``default``."""
    label = F.concat((F.floor(known_age(age) / 10) * 10).cast("string"), F.lit("대"))
    return F.coalesce(label, F.lit(default))


def _banded(value: Column, bands: list[tuple[int | None, str]], default: str) -> Column:
    chain = F.when(value.isNull(), default)
    for upper, label in bands:
        if upper is not None:
            chain = chain.when(value < upper, label)
    return chain.otherwise(bands[-1][1])


def age_band(age: Column, default: str = fixed.AGE_BAND_DEFAULT, zero_is_missing: bool = True) -> Column:
    """10대 to 40대 and 50대이상."""
    return _banded(known_age(age) if zero_is_missing else age, fixed.AGE_BANDS, default)


def payment_class(age: Column, default: str = fixed.PAYMENT_CLASS_DEFAULT) -> Column:
    return _banded(known_age(age), fixed.PAYMENT_CLASSES, default)


def first_region(address: Column, default: str = fixed.UNKNOWN) -> Column:
    """First word of the address."""
    word = F.element_at(F.split(F.trim(address), r"\s+"), 1)
    return F.coalesce(F.when(word != "", word), F.lit(default))


def lookup(table: dict[str, float], key: Column, default: float) -> Column:
    """Value of a small constant table; unlisted and NULL keys give ``default``."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))
