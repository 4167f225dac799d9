"""Columns that an operator carries but does not read, under names that none of its own can meet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aside(docs: DataFrame, *read: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``docs`` with every column but ``read`` under a number, and what gives a result the columns of ``docs`` again, then others."""
    names = {c: f"_carried{i}" for i, c in enumerate(docs.columns) if c not in read}

    def back(result: DataFrame, *others: Column) -> DataFrame:
        return result.select(*(F.col(names.get(c, c)).alias(c) for c in docs.columns), *others)

    return docs.withColumnsRenamed(names), back


def free_name(wanted: str, taken: list[str]) -> str:
    """``wanted``, with underscores added while a column has that name in any case."""
    while wanted.lower() in map(str.lower, taken):
        wanted += "_"
    return wanted
