import itertools
import zlib

import numpy as np
import pytest

from llm_tables import no_docs, some_docs, with_clashes
from ordermill.llm import sharding as S


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_each_cell_once_in_unit_steps(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    index = S.hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("shards", [1, 7, 500])
def test_counts_differ_by_one_and_slots_are_gapless(spark, shards):
    docs = some_docs(spark)
    rows = S.shard_rows(docs, shards).collect()
    counts = [sorted(r.slot for r in rows if r["shard"] == k) for k in range(shards)]
    assert all(own == list(range(len(own))) for own in counts)
    assert max(map(len, counts)) - min(map(len, counts)) <= 1
    ours = sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=repr)
    theirs = [(r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect()]
    assert ours == sorted(theirs, key=repr)
    order = [r.curve for r in sorted(rows, key=lambda r: (r["shard"], r.slot))]
    assert order == sorted(order)


def test_steps_are_quantiles_of_all_rows(spark):
    rows = spark.range(50_000).selectExpr("id * 7 AS doc_id", "CASE WHEN id % 10 < 3 THEN 5L WHEN id % 10 < 9 THEN id * id % 1000 END AS size",
                                          "CAST(id % 90 AS STRING) AS source", "CAST(NULL AS STRING) AS lang")
    names, held = ["source", "lang", "size", "doc_id"], rows.collect()
    expected = []
    for name in names:
        values = sorted(r[name] for r in held if r[name] is not None)
        expected.append(sorted({values[len(values) * k // 64] for k in range(1, 64)}) if values else [])
    assert S.step_edges(rows, names) == expected
    assert S.step_edges(rows.limit(0), names) == [[]] * 4 and S.step_edges(rows.where("doc_id = 7"), names)[3] == [7]


def test_no_rows_and_missing_dimensions(spark):
    assert S.shard_rows(no_docs(spark), 40).count() == 0
    assert S.shard_rows(spark.createDataFrame([(5, "a"), (None, None)], "doc_id long, text string"), 40).count() == 2


def test_written_shards_keep_columns_of_clashing_names(spark, tmp_path):
    docs = with_clashes(some_docs(spark))
    S.write_shards(docs, 5, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.columns == [*docs.columns, "_shard_"] and back.drop("_shard_").exceptAll(docs).count() == 0 and back.count() == docs.count()


def test_written_shards_hold_the_documents(spark, tmp_path):
    docs = some_docs(spark)
    S.write_shards(docs, 5, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == docs.count() and back.drop("_shard").exceptAll(docs.select(back.drop("_shard").columns)).count() == 0
