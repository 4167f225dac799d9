"""A data source for appends that happen once: ``df.write.format("once")`` with a batch number.

Tasks write Parquet files under names of their own and send the names with their commit messages.  The driver then writes
the batch's line of the ledger, one file that appears at once.  A file counts only if a ledger line names it, so a batch
that failed half-way leaves nothing, and a batch that is written again finds its line and takes its files back.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ordermill.session import ship_package

NAME = "once"


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class OnceWriter(DataSourceArrowWriter):
    """``path`` is one that the driver and every executor reach through Arrow's file systems."""

    def __init__(self, path: str, batch_id: int):
        self.path, self.batch_id = path, batch_id

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = _place(self.path)
        name, sink = f"{self.batch_id:012d}-{uuid.uuid4().hex}.parquet", None
        try:
            for batch in iterator:
                if sink is None:
                    system.create_dir(f"{root}/files", recursive=True)
                    sink = pq.ParquetWriter(f"{root}/files/{name}", batch.schema, filesystem=system)
                sink.write_batch(batch)
        finally:
            if sink is not None:
                sink.close()
        return Written([name] if sink is not None else [])

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _place(self.path)
        files = [f for m in messages if m for f in m.files]
        line = f"{root}/ledger/{self.batch_id:012d}.json"
        if system.get_file_info(line).type != pafs.FileType.NotFound:  # written before
            self.abort(messages)
            return
        system.create_dir(f"{root}/ledger", recursive=True)
        aside = f"{root}/ledger/.{uuid.uuid4().hex}"
        with system.open_output_stream(aside) as out:
            out.write(json.dumps({"batch_id": self.batch_id, "files": files}).encode())
        system.move(aside, line)

    def abort(self, messages: list[Written | None]) -> None:
        system, root = _place(self.path)
        for name in (f for m in messages if m for f in m.files):
            system.delete_file(f"{root}/files/{name}")


class OnceSource(DataSource):
    """Options: ``path`` and ``batch_id``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> OnceWriter:
        if overwrite:
            raise ValueError("batches are appended; a batch that is there stays")
        return OnceWriter(self.options["path"], int(self.options["batch_id"]))


def append_once(path: str):
    """A batch writer: each batch once, whatever fails or is repeated.  Also an empty batch gets its line."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ship_package(spark)
        spark.dataSource.register(OnceSource)
        batch.write.format(NAME).mode("append").option("batch_id", batch_id).save(path)

    return write


def read_once(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all batches in the ledger."""
    system, root = _place(path)
    lines = system.get_file_info(pafs.FileSelector(f"{root}/ledger", allow_not_found=True))
    held = [json.loads(system.open_input_stream(i.path).read()) for i in lines if not i.base_name.startswith(".")]
    files = [f"{path}/files/{f}" for line in held for f in line["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
