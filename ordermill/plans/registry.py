"""Registered queries: a callable over the test tables and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.plans.bindings import Tables

REGISTRY: dict[str, tuple[Callable[[Tables], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = (build, sql)
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and zoned timestamps as local ones, for comparison with other engines."""
    kinds = dict(df.dtypes)
    return df.select(*[
        F.col(c).cast("double").alias(c) if kinds[c].startswith("decimal")
        else F.col(c).cast("timestamp_ntz").alias(c) if kinds[c] == "timestamp"
        else F.col(c)
        for c in df.columns
    ])


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return plain(REGISTRY[name][0](Tables(spark, folder)))
