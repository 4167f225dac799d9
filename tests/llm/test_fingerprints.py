import hashlib
import random

import pytest
from pyspark.sql import functions as F

from llm_tables import no_docs, some_docs
from ordermill.llm import fingerprints as P


def expected_edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    edited = []
    for i, (doc, text) in enumerate(order):
        half = len(text) // 2
        edited.append((doc, len(text), hashlib.sha256((text[: len(text) - half] + order[(i + 1) % len(order)][1][:half]).encode()).hexdigest()))
    return sorted(edited, key=repr)


@pytest.mark.parametrize("cuts", [1, 50])
def test_edited_texts_follow_the_order_of_ids(spark, monkeypatch, cuts):
    monkeypatch.setattr(P, "CUTS_PER_BUCKET", cuts)
    docs = some_docs(spark)
    found = P.fingerprints(docs).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=repr) == expected_edits([(r.doc_id, r.text or "") for r in docs.collect()])
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    by_text = {}
    for r in found:
        if r.doc_id is not None and sum(q.doc_id == r.doc_id for q in found) == 1:
            assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_edited == 1.0) >= (r.fingerprint == r.edited_fingerprint)


def test_few_rows(spark):
    assert P.fingerprints(no_docs(spark)).count() == 0
    one = P.fingerprints(spark.createDataFrame([(7, "abcdef")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
    two = P.fingerprints(spark.createDataFrame([(7, "abcd"), (9, "xy")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.edited_sha256 for r in two] == [hashlib.sha256(t).hexdigest() for t in (b"abxy", b"xa")]


def vectors(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("h", P.part_hashes(F.col("text")))
    return rows.withColumn("v", P.vector(F.col("h"))).withColumn("l", P.lanes(F.col("v")))


def test_sums_are_homomorphic_and_ignore_order(spark):
    a, b = "one line\nanother. And more!\nlast", "x\ny\nx\nAnd more!"
    rows = {r.i: r.v for r in vectors(spark, [a, b, a + "\n" + b, "last\nAnd more!\none line\nanother."]).collect()}
    both = spark.createDataFrame([(rows[0], rows[1], rows[2])], "a array<long>, b array<long>, c array<long>")
    summed = both.select(P.combine(F.col("a"), F.col("b")).alias("s"), P.combine(F.col("c"), F.col("b"), -1).alias("d")).first()
    assert summed.s == rows[2] and summed.d == rows[0] and rows[3] == rows[0]


def test_likeness_estimates_the_shared_parts(spark):
    rng = random.Random(3)
    lines = lambda n: [f"line {rng.random()}" for _ in range(n)]
    off = []
    for share in (0.0, 0.25, 0.5, 0.75, 1.0):
        common, rest = lines(int(40 * share)), 40 - int(40 * share)
        pair = vectors(spark, ["\n".join(common + lines(rest)), "\n".join(lines(rest) + common)])
        l = {r.i: r.l for r in pair.collect()}
        near = spark.createDataFrame([(l[0], l[1])], "a array<long>, b array<long>").select(P.likeness(F.col("a"), F.col("b"))).first()[0]
        off.append(abs(near - share))
    assert off[-1] == 0 and max(off) < 0.35


def test_no_python_in_the_plan(spark):
    plan = P.fingerprints(some_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
