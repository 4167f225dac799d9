"""Event topics, read as a stream or as a bounded batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ordermill import fixed_values as fixed


def _kafka(options: dict, topic: str, starting: str) -> dict:
    return {"subscribe": topic, "startingOffsets": starting, **options}


def read_event_stream(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "kafka",
    schema: StructType | None = None,
    topic: str = fixed.TOPICS["order"],
    starting: str = "latest",
    **options,
) -> DataFrame:
    """Events as they arrive: a Kafka topic (options such as kafka.bootstrap.servers) or a growing folder."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        return reader.options(**_kafka(options, topic, starting)).load()
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(path)


def read_event_batch(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "kafka",
    schema: StructType | None = None,
    topic: str = fixed.TOPICS["order"],
    starting: str = "earliest",
    **options,
) -> DataFrame:
    """Everything the topic or folder holds now."""
    reader = spark.read.format(fmt)
    if fmt == "kafka":
        return reader.options(**_kafka(options, topic, starting)).load()
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(path)
