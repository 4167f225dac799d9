import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_tables import no_docs, some_docs, with_clashes
from ordermill.llm import line_dedup as D


def brute(rows):
    """(doc_id, lines, removed) of each distinct row, by comparing every line with all before it."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    seen, out = [], []
    for doc, text, _ in order:
        lines, removed = [] if text is None else text.split("\n"), []
        for k, line in enumerate(lines):
            own = frozenset(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), line)))
            if own:
                if any(len(own & s) >= 0.8 * len(own | s) - 1e-9 for s in seen):
                    removed.append(k)
                seen.append(own)
        out.append((doc, len(lines), removed))
    return sorted(out, key=repr)


@pytest.fixture
def docs(spark):
    rng = random.Random(6)
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(3000)]
    pool = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 9, 20, 60]))] for _ in range(160)]
    rows = []
    for d in rng.sample(range(1000), 150):
        lines = []
        for _ in range(rng.randint(0, 9)):
            own = list(rng.choice(pool))
            if rng.random() < 0.5:
                own[rng.randrange(len(own))] = rng.choice(vocabulary).upper()
            rng.shuffle(own)
            lines.append(" ".join(own))
        rows.append((d, "\n".join(lines)))
    rows += [(2000, None), (2001, ""), (2002, "\n\n"), (2003, "A b c d e\na  B c\td e\n\n \nq"), (None, "a b c d e"), rows[3]]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("block", [1024, 6])
def test_removed_lines_are_those_of_brute_force(docs, monkeypatch, block):
    for name in ("WORD_BLOCK", "GROUP_BLOCK"):
        monkeypatch.setattr(D, name, block)
    found = sorted(((r.doc_id, r.lines, r.removed) for r in D.repeated_lines(docs).collect()), key=repr)
    rows = [(r.doc_id, r.text, r.h) for r in docs.withColumn("h", F.xxhash64("text")).collect()]
    assert found == brute(rows) and sum(len(r[2]) for r in found) > 100


def test_lines_are_cut_at_breaks():
    texts = ["a b\nc", None, "", "\n", "x\n\ny z", "\nq", "end\n"]
    _, counts, per_text = D.line_words(pa.record_batch([pa.array(texts)], ["text"]))
    split = [t.split("\n") for t in texts if t]
    assert sum(counts) == sum(len(line.split()) for t in split for line in t)
    at = 0
    for text, n in zip(texts, per_text, strict=True):
        own = [len(line.split()) for line in (text or "").split("\n")] if text else []
        assert list(counts[at : at + n]) == own[:n] and not any(own[n:])
        at += n
    assert at == len(counts)


def test_texts_lose_the_lines(spark, docs):
    found = {(r.doc_id, r.text_hash): r.removed for r in D.repeated_lines(docs).collect()}
    kept = D.without_repeated_lines(with_clashes(docs))
    assert kept.columns == with_clashes(docs).columns and kept.count() == docs.count() and {(r["_doc"], r["_text"], r["_removed"]) for r in kept.collect()} == {("own _doc", "own _text", "own _removed")}
    expected = [(r.doc_id, None if r.text is None else "\n".join(x for k, x in enumerate(r.text.split("\n")) if k not in found[r.doc_id, r.h]))
                for r in docs.withColumn("h", F.xxhash64("text")).collect()]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(expected, key=repr)


def test_odd_rows(spark):
    assert D.repeated_lines(some_docs(spark)).count() == some_docs(spark).select("doc_id", "text").distinct().count()
    assert D.repeated_lines(no_docs(spark)).count() == 0


def test_maps_never_drop_similar_sets():
    rng = np.random.default_rng(2)
    base = " ".join(f"t{i}" for i in range(100))
    other = " ".join(f"t{i}" if rng.random() < 0.9 else f"u{i}" for i in range(100))
    maps = D.LineSets(pa.record_batch([pa.array([base, other])], ["text"]), np.zeros(D.BUCKETS, np.uint8)).maps()
    apart = len(set(base.split()) ^ set(other.split()))
    assert np.bitwise_count(maps[0] ^ maps[1]).sum() <= apart
