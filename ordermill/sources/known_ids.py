"""Which ids a table grown batch by batch holds, without reading them all.

Every part of the table keeps its ids a second time, in the order of a 64-bit hash, and for each run of them the hash
range and a Bloom filter of about ``BITS`` bits an id.  A batch's ids meet the filters by the first byte of their
hash.  Only where one may be held are ids read, by ranges that Parquet's statistics answer, and compared.  So a batch
without copies reads filters, about three bytes for each id of the past, and next to no ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.session import ship_package
from ordermill.sources.versions import Part, VersionedTable

BITS = 24
PROBES = 14
RUN_IDS = 1 << 16  # ids of a filter at most
RANGES_ASKED = 64  # ranges named in one filter on the ids; more are joined to as few wider ones
ROW_GROUP_BYTES = 1 << 20
_U = np.uint64

FILTERS = "bucket int, low long, high long, bits binary"


def hashed(ids: DataFrame, key: str) -> DataFrame:
    """``_id`` as text, ``_hash``, and ``bucket``, the hash's first byte."""
    text = F.col(key).cast("string")
    return ids.select(text.alias("_id"), F.xxhash64(text).alias("_hash")).withColumn("bucket", F.shiftrightunsigned("_hash", 56).cast("int"))


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each hash in a filter, a row each (double hashing)."""
    one = hashes.view(np.uint64)
    two = (one * _U(0x9E3779B97F4A7C15)) ^ (one >> _U(32)) | _U(1)
    return ((one[:, None] + np.arange(PROBES, dtype=np.uint64)[None, :] * two[:, None]) >> _U(1)) % _U(bits)


def filter_of(hashes: np.ndarray) -> bytes:
    bits = np.zeros(max(64, BITS * len(hashes) // 8 * 8), bool)
    bits[_places(hashes, len(bits)).ravel()] = True
    return np.packbits(bits, bitorder="little").tobytes()


def may_hold(held: bytes, hashes: np.ndarray) -> np.ndarray:
    data = np.frombuffer(held, np.uint8)
    at = _places(hashes, 8 * len(data))
    return ((data[at >> _U(3)] >> (at & _U(7)).astype(np.uint8)) & 1).all(1)


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A filter for each run of at most ``RUN_IDS`` hashes of one bucket; rows come by hash."""
    rest = np.empty(0, np.int64)

    def made(runs: list[np.ndarray]) -> pa.RecordBatch:
        columns = [[int(r[0].view(np.uint64) >> _U(56)) for r in runs], [int(r[0]) for r in runs], [int(r[-1]) for r in runs], [filter_of(r) for r in runs]]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["bucket", "low", "high", "bits"])

    for batch in batches:
        rest = np.concatenate([rest, batch.column("_hash").to_numpy()])
        bucket = rest.view(np.uint64) >> _U(56)
        groups = np.split(rest, np.flatnonzero(np.diff(bucket)) + 1)
        runs = [run for group in groups[:-1] for run in np.array_split(group, -(-len(group) // RUN_IDS))]
        rest = groups[-1]
        while len(rest) >= RUN_IDS:
            runs.append(rest[:RUN_IDS])
            rest = rest[RUN_IDS:]
        if runs:
            yield made(runs)
    if len(rest):
        yield made([rest])


class KnownIds:
    """The ids of ``key`` in a versioned table whose parts were all written with ``beside=known.index``."""

    def __init__(self, table: VersionedTable, key: str):
        self.table, self.key, self.spark = table, key, table.spark
        ship_package(self.spark)

    def index(self, part: Part) -> None:
        """Write the part's ids by hash, and their filters."""
        ids = hashed(self.spark.read.parquet(self.table.folder(part, "rows")), self.key)
        ids = ids.repartitionByRange("_hash").sortWithinPartitions("bucket", "_hash")
        ids.select("_hash", "_id").write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(self.table.folder(part, "ids"))
        held = self.spark.read.schema("_hash long, _id string").parquet(self.table.folder(part, "ids")).select("_hash", F.shiftrightunsigned("_hash", 56).cast("int").alias("bucket"))
        ordered = held.repartition("bucket").sortWithinPartitions("bucket", "_hash").select("_hash")
        ordered.mapInArrow(_filters, FILTERS).coalesce(4).write.parquet(self.table.folder(part, "filters"))

    def _asked(self, ids: DataFrame, parts: tuple[Part, ...]) -> list[tuple[int, int, int]]:
        """(part, low, high) of the runs whose filter may hold one of ``ids``: few if there are few copies, else all runs at most."""
        filters = None
        for number, part in enumerate(parts):
            one = self.spark.read.schema(FILTERS).parquet(self.table.folder(part, "filters")).withColumn("part", F.lit(number))
            filters = one if filters is None else filters.union(one)
        none = F.lit(None)
        ours = ids.select("bucket", F.col("_hash").alias("low"), none.cast("long").alias("high"), none.cast("binary").alias("bits"), none.cast("int").alias("part"))
        rows = ours.union(filters).repartition("bucket").sortWithinPartitions("bucket", F.col("part").asc_nulls_first(), "low")

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bucket, parts_held, asked = None, [], np.empty(0, np.int64)
            found: list[tuple[int, int, int]] = []
            for batch in batches:
                edges = np.flatnonzero(np.diff(batch.column("bucket").to_numpy())) + 1
                for low, high in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                    some = batch.slice(low, high - low)
                    if not some.num_rows:
                        continue
                    if (now := some.column("bucket")[0].as_py()) != bucket:
                        bucket, parts_held, asked = now, [], None
                    own = np.asarray(some.column("part").is_null())
                    parts_held.append(some.column("low").to_numpy()[own])
                    for row in some.filter(pa.array(~own)).to_pylist():
                        if asked is None:
                            asked = np.sort(np.concatenate(parts_held))
                        here = asked[np.searchsorted(asked, row["low"]) : np.searchsorted(asked, row["high"], "right")]
                        if len(here) and may_hold(row["bits"], here).any():
                            found.append((row["part"], row["low"], row["high"]))
            columns = list(zip(*found, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["part", "low", "high"])

        return [tuple(r) for r in rows.mapInArrow(look, "part int, low long, high long").collect()]

    def among(self, ids: DataFrame, before: int | None = None) -> DataFrame | None:
        """``_id`` of those of ``ids`` (a frame with ``key``) that parts of earlier batches hold; None if certainly none."""
        parts = tuple(p for p in self.table.manifest().parts if before is None or p.first < before)
        if not parts:
            return None
        ours = hashed(ids, self.key).distinct()
        found: DataFrame | None = None
        by_part: dict[int, list[tuple[int, int]]] = {}
        for part, low, high in self._asked(ours, parts):
            by_part.setdefault(part, []).append((low, high))
        for part, ranges in by_part.items():
            held = self.spark.read.schema("_hash long, _id string").parquet(self.table.folder(parts[part], "ids")).where(_inside(F.col("_hash"), ranges))
            found = held if found is None else found.union(held)
        return None if found is None else found.select("_id")


def _inside(value: Column, ranges: list[tuple[int, int]]) -> Column:
    ranges = sorted(ranges)
    step = -(-len(ranges) // RANGES_ASKED)
    wide = [(ranges[k][0], max(r[1] for r in ranges[k : k + step])) for k in range(0, len(ranges), step)]
    made = F.lit(False)
    for low, high in wide:
        made = made | value.between(F.lit(low), F.lit(high))
    return made
