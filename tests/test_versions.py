import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from ordermill.sources import sinks
from ordermill.sources.known_ids import BITS, KnownIds
from ordermill.sources.versions import Manifest, Part, VersionedTable


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "table"))


def counts(log):
    return log.groupBy("k").agg(F.sum("n").alias("n"), F.max("batch_id").alias("batch_id"))


class MemoryStore:
    """Files in a dictionary, for tests of many manifests."""

    def __init__(self):
        self.held = {}

    def names(self, *folder):
        return sorted({k[len(folder)] for k in self.held if k[: len(folder)] == folder})

    def text(self, *names):
        return self.held[names]

    def put(self, text, *names):
        return self.held.setdefault(names, text) is text

    def remove(self, *names):
        self.held = {k: v for k, v in self.held.items() if k[: len(names)] != names}


def test_a_thousand_batches_leave_few_folders(table, monkeypatch):
    """The manifests alone: no files are written."""
    def write(self, rows, level, first, last):
        self.store.put("", "data", f"{level}-{first}-{last}", "rows")
        return Part(f"{level}-{first}-{last}", level, first, last)

    table.store = MemoryStore()
    monkeypatch.setattr(VersionedTable, "write", write)
    monkeypatch.setattr(VersionedTable, "read", lambda self, parts=None: None)
    most = 0
    for batch in range(1000):
        part = table.write(None, 0, batch, batch)
        table.commit(lambda old: Manifest(0, (*old.parts, part), old.retired))
        table.merge_levels()
        table.clean(grace=0)
        held = table.manifest()
        most = max(most, len(table.store.names("data")))
        spans = sorted((p.first, p.last) for p in held.parts)
        assert spans[0][0] == 0 and spans[-1][1] == batch and all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
    assert most < 40 and len(table.manifest().parts) == 1 and len(table.store.names("manifests")) < 40


def test_batches_merge_and_old_folders_go_after_the_grace_time(spark, table, rows):
    total = {}
    for batch in range(14):
        data = [(f"k{(batch * i) % 5}", i) for i in range(4)]
        for k, n in data:
            total[k] = total.get(k, 0) + n
        table.append(spark.createDataFrame(data, "k string, n long"), batch)
        table.append(spark.createDataFrame(data, "k string, n long"), batch)  # a repeated batch
        table.merge_levels(counts, fanout=3)
        table.append(spark.createDataFrame(data, "k string, n long"), batch)  # also after it was merged
        assert table.clean(grace=60) == 0
    assert rows(counts(table.read()).drop("batch_id")) == sorted(total.items(), key=repr)
    parts = table.manifest().parts
    assert len(parts) <= 8 and max(p.level for p in parts) >= 2
    before = len(table.store.names("data"))
    assert before > len(parts) and table.clean(grace=60, now=time.time() + 61) == before - len(parts)
    assert len(table.store.names("data")) == len(parts)
    assert rows(counts(table.read()).drop("batch_id")) == sorted(total.items(), key=repr)


def test_a_killed_write_leaves_the_last_version(spark, table, rows, monkeypatch):
    table.publish(spark.range(5), 1)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as held:
        held.setattr(VersionedTable, "commit", killed)  # files are there, the manifest is not
        with pytest.raises(KeyboardInterrupt):
            table.publish(spark.range(9), 2)
    assert rows(table.read()) == [(i,) for i in range(5)]
    table.store.system.create(table.store.path("manifests", ".000000000002.json-dead"), False).close()  # killed before the rename
    assert rows(table.read()) == [(i,) for i in range(5)]
    table.publish(spark.range(3), 2)
    assert rows(table.read()) == [(0,), (1,), (2,)]
    table.publish(spark.range(7), 1)  # late: an older stamp
    assert table.read().count() == 3


def test_a_reader_in_a_loop_never_sees_a_part_of_a_version(spark, tmp_path):
    path, seen, failed, ended = str(tmp_path / "pool"), set(), [], threading.Event()
    sinks.write_pool_snapshot(spark.range(0, 40, 1, 8), path, "2025-05-01 10:00:00")

    def read():
        while not ended.is_set():
            try:
                pool = sinks.read_pool(spark, path).collect()
                seen.add((len(pool), *{r["count"] for r in pool}))
            except Exception as error:  # noqa: BLE001
                failed.append(error)
                return

    reader = threading.Thread(target=read, daemon=True)
    reader.start()
    try:
        for n in range(1, 12):
            sinks.write_pool_snapshot(spark.range(0, 40 + n, 1, 8), path, f"2025-05-01 10:{n:02d}:00")
    finally:
        ended.set()
        reader.join(30)
    assert not failed and len(seen) > 2 and all(len(s) == 2 and s[0] == s[1] for s in seen)


def test_of_two_writers_none_loses_the_other_s_part(spark, tmp_path):
    tables = [VersionedTable(spark, str(tmp_path / "t")) for _ in range(2)]
    first = tables[0].write(spark.range(3), 0, 1, 1)
    second = tables[1].write(spark.range(4), 0, 2, 2)
    tries = []

    def change(old):
        if not tries:  # the other commits between this one's reading and its rename
            tables[1].commit(lambda held: Manifest(0, (*held.parts, second)))
        tries.append(old.number)
        return Manifest(0, (*old.parts, first))

    tables[0].commit(change)
    assert tries == [0, 1] and {p.first for p in tables[0].manifest().parts} == {1, 2} and tables[0].read().count() == 7


def test_replaced_tables(spark, tmp_path, rows):
    write = sinks.replace_table(str(tmp_path / "t"))
    write(spark.range(9), 0)
    write(spark.range(4), 1)
    write(spark.range(9), 0)  # repeated late
    assert rows(sinks.batches(spark, str(tmp_path / "t"))) == [(i,) for i in range(4)]
    with pytest.raises(FileNotFoundError):
        sinks.batches(spark, str(tmp_path / "none"))


def test_known_ids_are_just_those_of_earlier_batches(spark, table, rows):
    known, rng, stored = KnownIds(table, "id"), random.Random(1), set()
    frame = lambda ids: spark.createDataFrame([(i,) for i in ids], "id string").repartition(3)
    assert known.among(frame(["a"])) is None
    for batch in range(7):
        ids = [f"{batch}-{k}" for k in range(700)]
        table.append(frame(ids), batch, known.index)
        stored |= set(ids)
        table.merge_levels(fanout=3, beside=known.index)
        asked = rng.sample(sorted(stored), 40) + [f"new-{batch}-{k}" for k in range(400)]
        found = {r["_id"] for r in known.among(frame(asked + asked[:5])).collect()}
        assert found >= set(asked[:40]) and found <= stored
    assert known.among(frame(ids), before=0) is None
    later = known.among(frame(ids), before=6)  # its own part does not count
    assert later is None or not {r["_id"] for r in later.collect()} & set(ids)


def test_a_batch_without_copies_reads_filters_alone(spark, table):
    known = KnownIds(table, "id")
    read = []
    for batch in range(8):
        fresh = spark.range(batch * 20_000, (batch + 1) * 20_000).select(F.col("id").cast("string"))
        asked = known._asked(known_hashes(fresh), table.manifest().parts) if batch else []
        read.append(len(asked))
        table.append(fresh, batch, known.index)
        table.merge_levels(fanout=4, beside=known.index)
    assert sum(read) <= 20  # false answers, of some thousand runs: one id and part in 90,000
    filters = sum(spark.read.parquet(table.folder(p, "filters")).agg(F.sum(F.octet_length("bits"))).first()[0] for p in table.manifest().parts)
    assert filters <= BITS / 8 * 160_000 * 1.1


def known_hashes(ids):
    from ordermill.sources.known_ids import hashed

    return hashed(ids, "id")
