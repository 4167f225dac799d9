import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ordermill.llm import hard_negatives as H

KINDS = "vec_id long, embedding array<float>, label int, anchor_id string, `row` int, score double, windows int"


def brute(rows, is_anchor, positives=5, negatives=5, low=80, high=100):
    """Sorted result rows; rows without an id come last among equal scores."""
    usable = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, (anchor, a, label) in enumerate(usable):
        if anchor is None or not is_anchor(anchor):
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i if i is not None else H.NO_ID, other == label) for j, (i, b, other) in enumerate(usable) if j != k)
        name = lambda i: None if i == H.NO_ID else i
        for place, (less, positive, _) in enumerate([s for s in scored if s[2]][:positives], 1):
            fits = [s for s in scored if not s[2] and low * -less <= high * -s[0] <= high * -less]
            out += [(anchor, name(positive), place, rank, name(i), -less, -s) for rank, (s, i, _) in enumerate(fits[:negatives], 1)]
    return sorted(out, key=repr)


def some_vectors(n=400, seed=1, width=6, kinds=4):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(kinds)]
    rows = []
    for i in range(n):
        label = rng.randrange(kinds)
        around = centres[label if rng.random() < 0.6 else rng.randrange(kinds)]
        rows.append((i, [float(pa.scalar(c + rng.gauss(0, 0.2), pa.float32()).as_py()) for c in around], label))
    same = rows[7][1]
    rows += [(1000 + i, same, i % 2) for i in range(60)]  # ties, over two labels
    rows += [(20, rows[20][1], rows[20][2]), (30, rows[31][1], 2), (None, same, 0), (None, same, 1)]  # repeated, without an id
    rows += [(2000, None, 1), (2010, same, None), (2020, [*same[:-1], None], 1), (2030, [float("nan"), *same[1:]], 0), (2040, [float("inf"), *same[1:]], 0)]
    rows += [(2050, [], 1), (2060, same[:3], 1), (2070, [*same, 0.5, 0.5], 0), (2080, [0.0] * width, 2)]  # of other lengths, empty, zeros
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 0.5, 3) for i, v, label in rows], KINDS).repartition(6)


@pytest.mark.parametrize("blocks", ["whole", "many", "tiny chunks"])
def test_negatives_are_those_of_brute_force(spark, rows, monkeypatch, blocks):
    if blocks != "whole":
        monkeypatch.setattr(H, "BLOCK_NUMBERS", 8 * 40)
        monkeypatch.setattr(H, "ANCHOR_NUMBERS", 8 * 9)
    if blocks == "tiny chunks":
        monkeypatch.setattr(H, "CHUNK_SCORES", 50)
        monkeypatch.setattr(H, "HELD_PAIRS", 40)
    vectors = some_vectors()
    found = H.hard_negatives(frame(spark, vectors), F.col("vec_id") % 10 == 0)
    want = brute(vectors, lambda i: i % 10 == 0)
    assert len(want) > 300 and rows(found) == want


def test_other_numbers_and_windows(spark, rows):
    vectors = some_vectors(150, 5)
    for chosen in ({"positives": 2, "negatives": 3, "low": 50, "high": 60}, {"positives": 40, "negatives": 1, "low": 1, "high": 3}):
        found = H.hard_negatives(frame(spark, vectors), F.col("vec_id") % 7 == 1, **chosen)
        want = brute(vectors, lambda i: i % 7 == 1, **chosen)
        assert want and rows(found) == want


@pytest.mark.parametrize("scale", [40.0, 3000.0, 700_000.0])
def test_large_components_stay_exact(spark, rows, scale):
    vectors = [(i, v and [x and x * scale for x in v], label) for i, v, label in some_vectors(120, 3)]
    vectors = [(i, v and [float(pa.scalar(x, pa.float32()).as_py()) if x is not None else None for x in v], label) for i, v, label in vectors]
    found = H.hard_negatives(frame(spark, vectors), F.col("vec_id") % 10 == 0)
    assert rows(found) == brute(vectors, lambda i: i % 10 == 0)


def test_vectors_beyond_64_bits_take_no_part(spark, rows):
    vectors = some_vectors(60, 2)
    found = H.hard_negatives(frame(spark, [*vectors, (10_000, [1e38] * 6, 1), (10_010, [-3e30] * 6, 0)]), F.col("vec_id") % 10 == 0)
    assert rows(found) == brute(vectors, lambda i: i % 10 == 0)


def test_a_label_expression_and_empty_tables(spark, rows):
    vectors = some_vectors(200, 8)
    moved = [(i, v, (label + 1) % 4 if i is not None and label is not None and i % 7 == 0 else label) for i, v, label in vectors]
    found = H.hard_negatives(frame(spark, vectors), F.col("vec_id") % 10 == 0, F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 4).otherwise(F.col("label")))
    assert rows(found) == brute(moved, lambda i: i % 10 == 0)
    assert H.hard_negatives(frame(spark, vectors).limit(0), F.lit(True)).count() == 0
    assert H.hard_negatives(frame(spark, vectors), F.lit(False)).count() == 0
    with pytest.raises(ValueError):
        H.hard_negatives(frame(spark, vectors), F.lit(True), low=0)


def test_the_iterator_closes_windows_and_carries_them_over_batches():
    pack = lambda s, negative: -2 * s + negative
    pairs = [(1, pack(100, 0), 7), (1, pack(100, 1), 3), (1, pack(90, 0), 8), (1, pack(85, 1), 4), (1, pack(79, 1), 5), (1, pack(71, 1), 6), (2, pack(90, 1), 1), (2, pack(50, 0), 2), (2, pack(50, 1), 9)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*pairs[k : k + 2], strict=True)], ["anchor", "packed", "vec"]) for k in range(0, len(pairs), 2)]
    made = [tuple(r.values()) for b in H.emit(iter(batches), 2, 80, 100) for r in b.to_pylist()]
    assert made == [(1, 7, 1, 1, 3, 100, 100), (1, 7, 1, 2, 4, 100, 85), (1, 8, 2, 1, 4, 90, 85), (1, 8, 2, 2, 5, 90, 79), (2, 2, 1, 1, 9, 50, 50)]
