"""Token ids in binary files of patched frame-of-reference blocks (operator 9).

A file holds the ids of consecutive documents.  Its layout, all numbers little-endian:

    magic "PFOR" + version    8 bytes
    blocks                    BLOCK ids each, the last one shorter
    documents                 doc_id int64 (0 where null), null flag uint8, number of ids int64; column after column
    block starts              int64 byte offset of each block
    tail                      int64: documents, ids, blocks, byte offset of the documents

A block is: minimum uint32, number of ids uint32, number of exceptions uint32, width uint32; the ids less the minimum,
packed to ``width`` bits, where those that need more have their low bits; then the exceptions' places (uint16) and
whole differences (uint32).  The width holds the given share of the block's differences, so a few large ids do not
widen all others.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.storage import new_folder, settle_table
from ordermill.llm.tokens import encoded
from ordermill.llm.worker import begin

MAGIC = b"PFOR\x01\x00\x00\x00"
BLOCK = 4096
WIDTH_SHARE = 0.9
IDS_PER_FILE = 1 << 23  # a file ends with the document that reaches it
END_ID = 1
BLOCKS_READ = 64
ROWS_READ = 10_000
FILES_TASKS = 4096  # files are read in so many tasks at most, or as many as run at a time
_BITS = np.arange(32, dtype=np.uint32)


def pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, low bit first."""
    if not width:
        return b""
    bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little")
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def unpack(data: np.ndarray, n: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros(n, np.uint32)
    bits = np.unpackbits(data, count=n * width, bitorder="little").reshape(n, width)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :width] = bits
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1)


def encode_block(ids: np.ndarray, share: float = WIDTH_SHARE) -> bytes:
    """One block of at most 65,536 ids."""
    low = int(ids.min())
    above = (ids - np.uint32(low)).astype(np.uint32)
    kth = min(len(above) - 1, int(share * len(above)))
    width = int(np.partition(above, kth)[kth]).bit_length()
    outlying = np.flatnonzero(above >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    head = np.array([low, len(ids), len(outlying), width], "<u4").tobytes()
    return head + pack(above, width) + outlying.astype("<u2").tobytes() + above[outlying].astype("<u4").tobytes()


def decode_block(data: np.ndarray) -> np.ndarray:
    """The ids of the block that begins at the first of these bytes."""
    low, n, outlying, width = data[:16].view("<u4")
    end = 16 + (int(n) * int(width) + 7) // 8
    above = unpack(data[16:end], int(n), int(width))
    if outlying:
        middle = end + 2 * int(outlying)
        above[data[end:middle].copy().view("<u2")] = data[middle : middle + 4 * int(outlying)].copy().view("<u4")
    return above + low


class FileWriter:
    """Writes one file block by block; holds one block and the document index."""

    def __init__(self, sink, share: float = WIDTH_SHARE):
        self.sink, self.share = sink, share
        self.at, self.ids, self.rest = len(MAGIC), 0, bytearray()
        self.starts: list[int] = []
        self.docs: list[int | None] = []
        self.counts: list[int] = []
        sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.ids += len(ids) // 4
        self.rest += ids
        if len(self.rest) >= 64 * BLOCK:
            self._blocks(len(self.rest) // (4 * BLOCK))

    def _blocks(self, n: int) -> None:
        held = np.frombuffer(self.rest, "<u4", n * BLOCK if n else -1)
        for low in range(0, len(held), BLOCK):
            block = encode_block(held[low : low + BLOCK], self.share)
            self.starts.append(self.at)
            self.sink.write(block)
            self.at += len(block)
        self.rest = self.rest[4 * len(held):]

    def close(self) -> None:
        if self.rest:
            self._blocks(0)
        index = [
            np.array([d or 0 for d in self.docs], "<i8"), np.array([d is None for d in self.docs], "u1"), np.array(self.counts, "<i8"),
            np.array(self.starts, "<i8"), np.array([len(self.docs), self.ids, len(self.starts), self.at], "<i8"),
        ]
        self.sink.write(b"".join(x.tobytes() for x in index))
        self.sink.close()


def read_index(source: pa.NativeFile) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents' ids, which of them are null, numbers of ids, and block starts with the end of the last."""
    size = source.size()
    if size < len(MAGIC) + 32 or source.read_at(len(MAGIC), 0) != MAGIC:
        raise ValueError("not a token file")
    docs, _, blocks, at = (int(x) for x in np.frombuffer(source.read_at(32, size - 32), "<i8"))
    edges = np.cumsum([0, 8 * docs, docs, 8 * docs, 8 * blocks])
    held = source.read_at(int(edges[-1]), at)
    parts = [held[low:high] for low, high in zip(edges, edges[1:], strict=False)]
    starts = np.append(np.frombuffer(parts[3], "<i8"), at)
    return np.frombuffer(parts[0], "<i8"), np.frombuffer(parts[1], bool), np.frombuffer(parts[2], "<i8"), starts


def decoded_blocks(source: pa.NativeFile, starts: np.ndarray) -> Iterator[np.ndarray]:
    """The ids of each block, read ``BLOCKS_READ`` at a time."""
    for low in range(0, len(starts) - 1, BLOCKS_READ):
        own = starts[low : low + BLOCKS_READ + 1]
        data = np.frombuffer(source.read_at(int(own[-1] - own[0]), int(own[0])), np.uint8)
        for at in own[:-1] - own[0]:
            yield decode_block(data[at:])


def read_documents(source: pa.NativeFile) -> Iterator[tuple[int | None, np.ndarray]]:
    """Each document's id and token ids, in order; holds the index, a run of packed blocks and one document."""
    docs, null, counts, starts = read_index(source)
    blocks = decoded_blocks(source, starts)
    held, used = np.empty(0, "<u4"), 0
    for doc, unknown, n in zip(docs.tolist(), null.tolist(), counts.tolist(), strict=True):
        parts, missing = [], n
        while missing:
            if used == len(held):
                held, used = next(blocks), 0
            parts.append(held[used : used + missing])
            used, missing = used + len(parts[-1]), missing - len(parts[-1])
        yield None if unknown else doc, np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.empty(0, "<u4")


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, share: float = WIDTH_SHARE,
                      ids_per_file: int = IDS_PER_FILE) -> DataFrame:
    """Encode ``docs`` (doc_id long, text string) and write them to ``folder`` in ascending doc_id order.

    One row per file comes back: its name, its first document's place in the order, documents, ids, and ``start``, the
    number of ids in all files before it.  ``folder`` is a path that every executor reaches through Arrow's file
    systems (a mounted folder, HDFS, S3, GCS).  A file gets a name of its own per attempt and counts only when listed
    here, so a task that runs again leaves no half-written file in use.  Null doc_ids come first, null and empty texts
    have the end id alone, rows of one doc_id follow each other by the text's hash, and no document is no file.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(folder if ":/" in folder else f"file://{os.path.abspath(folder)}")
        system.create_dir(root, recursive=True)
        end, part, writer, made = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId(), None, []

        def finish():
            writer.close()
            made.append((name, part, len(made), len(writer.docs), writer.ids))

        for batch, found in encoded(batches, "text", tokenizer):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                if writer is None:
                    name = f"tokens-{part:06d}-{len(made):04d}-{uuid.uuid4().hex}.pfor"
                    writer = FileWriter(system.open_output_stream(f"{root}/{name}"), share)
                writer.add(doc_id, ids + end)
                if writer.ids >= ids_per_file:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        columns = list(zip(*made, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])],
                                         ["file", "part", "piece", "documents", "ids"])

    rows = docs.select("doc_id", "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    files = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        write, "file string, part long, piece long, documents long, ids long")
    files = settle_table(files, "token-files")
    earlier = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    return settle_table(files.select("file", "documents", "ids", before("documents").alias("first"), before("ids").alias("start")), "token-starts")


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """One row per document of the listed files: doc_id, start, n_tokens, ids_crc32, and file.

    A task opens its files itself, as the writing tasks did, and reads them block by block; no file is held whole.
    """
    def rows_of(source: pa.NativeFile, name: str, start: int) -> Iterator[pa.RecordBatch]:
        documents = read_documents(source)
        while rows := [(doc, len(ids), zlib.crc32(np.ascontiguousarray(ids))) for doc, ids in islice(documents, ROWS_READ)]:
            doc_ids, counts, crcs = zip(*rows, strict=True)
            starts = start + np.cumsum(counts) - np.array(counts)
            start += sum(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64()),
                 pa.array([name] * len(rows), pa.string())], ["doc_id", "start", "n_tokens", "ids_crc32", "file"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin()
        system, root = pafs.FileSystem.from_uri(folder if ":/" in folder else f"file://{os.path.abspath(folder)}")
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with system.open_input_file(f"{root}/{name}") as source:
                    yield from rows_of(source, name, start)

    kinds = "doc_id long, start long, n_tokens long, ids_crc32 long, file string"
    tasks = min(max(1, files.count()), max(FILES_TASKS, files.sparkSession.sparkContext.defaultParallelism))
    return files.select("file", "start").repartition(tasks).mapInArrow(read, kinds)


def token_rows(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` as token files below the shared folder, and read them back."""
    folder = new_folder(docs.sparkSession, "pfor")
    return read_token_files(write_token_files(docs, tokenizer, folder), folder)
