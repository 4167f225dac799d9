"""The JSON envelope of an event: {event_type, timestamp, <entity>: {...}}."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill import schemas
from ordermill.functions.times import Moment, moment


def envelope_schema(entity: str, payload: T.StructType) -> T.StructType:
    """One schema for all three layouts, so that each message is parsed once."""
    head = [
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField(entity, payload),
        T.StructField("data", payload),
    ]
    taken = {f.name for f in head}
    return T.StructType(head + [f for f in payload.fields if f.name not in taken])


def decode(raw: DataFrame, entity: str = "order", payload: T.StructType = schemas.ORDER_EVENT, value: str = "value") -> DataFrame:
    """Adds the decoded struct as a column named ``entity``; it is NULL when nothing could be read.

    The payload sits under its entity name, under "data", or at the top level.  Parsing inside one
    generated row keeps it to once per message: a later filter or field access cannot be pushed into
    the parser call and repeat it.
    """
    key = schemas.required_key(payload)

    def payload_of(message: Column) -> Column:
        flat = F.when(message[key].isNotNull(), F.struct(*[message[f.name].alias(f.name) for f in payload.fields]))
        return F.coalesce(message[entity], message["data"], flat)

    parsed = F.from_json(F.col(value).cast("string"), envelope_schema(entity, payload))
    return raw.select("*", F.explode(F.transform(F.array(parsed), payload_of)).alias(entity))


def decode_envelope(raw: DataFrame, entity: str = "order", payload: T.StructType = schemas.ORDER_EVENT, value: str = "value") -> DataFrame:
    """The payload columns of every readable message."""
    return decode(raw, entity, payload, value).where(F.col(entity).isNotNull()).select(f"{entity}.*")


def iso_text(ts: Column) -> Column:
    """ISO-8601; the fraction appears only when there is one."""
    micros = F.date_format(ts, "SSSSSS")
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(micros == "000000", seconds).otherwise(F.concat(seconds, F.lit("."), micros))


def encode_envelope(rows: DataFrame, entity: str, emitted_at: Moment, key: str, event: str = "created") -> DataFrame:
    """(key, value) messages, times as ISO text, missing fields as null."""
    def field(name: str, kind: str) -> Column:
        if kind.startswith("timestamp"):
            return iso_text(F.col(name)).alias(name)
        return F.col(name).cast("string").alias(name) if kind == "date" else F.col(name)

    payload = F.struct(*[field(name, kind) for name, kind in rows.dtypes])
    message = F.struct(
        F.lit(f"{entity}_{event}").alias("event_type"),
        F.lit(moment(emitted_at).isoformat()).alias("timestamp"),
        payload.alias(entity),
    )
    return rows.select(
        F.col(key).cast("string").alias("key"), F.to_json(message, {"ignoreNullFields": "false"}).alias("value")
    )
