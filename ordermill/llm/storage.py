"""Written intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from ordermill.session import shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created."""
    return f"{shared_folder(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def settle_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    Cuts the lineage, survives lost executors, and gives Spark the true size of the table, by which it chooses
    between a broadcast and a shuffled join.
    """
    return settle_at(df, new_folder(df.sparkSession, name))


def settle_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_tables(spark: SparkSession) -> None:
    """Delete every table that ``settle_table`` wrote to the shared folder; call it when results are stored."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in system.globStatus(jvm.org.apache.hadoop.fs.Path(root, "llm-*")) or []:
        system.delete(found.getPath(), True)


def read_arrow(folder: str, columns: list[str]) -> pa.Table:
    """The settled table in ``folder`` as an Arrow table, read inside a task; for tables of a checked size."""
    system, root = pafs.FileSystem.from_uri(folder if ":/" in folder else f"file://{folder}")
    return ds.dataset(root, format="parquet", filesystem=system, exclude_invalid_files=False, ignore_prefixes=["_", "."]).to_table(columns=columns)
