"""Tables from any Spark source, pages of them, and row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, source: str, fmt: str = "parquet", schema: StructType | None = None, **options) -> DataFrame:
    """A table by path (files) or by name (``fmt="jdbc"`` with url, driver, user, ... as options).

    A JDBC table is read in parallel when partitionColumn, lowerBound, upperBound and numPartitions are given.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None and fmt != "jdbc":
        reader = reader.schema(schema)
    return reader.option("dbtable", source).load() if fmt == "jdbc" else reader.load(source)


def page(table: DataFrame, order_by: list[str], limit: int, offset: int = 0) -> DataFrame:
    """Rows offset+1 to offset+limit; ``order_by`` should end with a unique column."""
    return table.orderBy(*order_by).offset(offset).limit(limit)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
