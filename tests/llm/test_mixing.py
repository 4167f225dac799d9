import random
import re
from collections import defaultdict

import pytest

from llm_tables import no_docs, some_docs
from ordermill.llm import mixing as M


def expected_targets(sizes):
    """By the rule as worded: share out, stop at the limit, share the excess again."""
    weights = {s: M.WEIGHTS[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target, free, left = dict.fromkeys(sizes, 0.0), set(sizes), 1.5 * sum(sizes.values())
    while free and left > 1e-9:
        total = sum(weights[s] for s in free)
        for s in free:
            target[s] += left * weights[s] / total
        left = sum(max(0.0, target[s] - 2 * sizes[s]) for s in free)
        for s in list(free):
            if target[s] >= 2 * sizes[s]:
                target[s] = 2.0 * sizes[s]
                free.discard(s)
    return target


def many_docs(spark):
    rng = random.Random(4)
    text = lambda n: " ".join("w" for _ in range(n))
    rows = [(i, text(min(3000, int(rng.paretovariate(0.9) * 8))), rng.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(1500)]
    rows += [(10_000 + i, text(50), "hot") for i in range(800)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)


@pytest.mark.parametrize("make", [many_docs, some_docs])
def test_words_taken_meet_the_targets(spark, make):
    docs = make(spark)
    rows = M.mix(docs).collect()
    assert sorted((r.doc_id or 0, r.size) for r in rows) == sorted((r.doc_id or 0, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in docs.collect())
    sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
    assert all(r.source_size == sizes[r.source] for r in rows)
    for s, t in expected_targets(sizes).items():
        assert target[s] == pytest.approx(t, rel=1e-9)
        assert abs(taken[s] - t) <= largest[s] + 1e-4 * t


def test_reruns_agree(spark):
    one, two = (sorted((r.doc_id, r.copies) for r in M.mix(many_docs(spark).repartition(n)).collect()) for n in (3, 9))
    assert one == two


def test_no_rows_and_no_words(spark):
    assert M.mix(no_docs(spark)).count() == 0
    rows = M.mix(spark.createDataFrame([(1, None, "a"), (2, " ", "b")], "doc_id long, text string, source string")).collect()
    assert [r.taken for r in rows] == [0, 0]
