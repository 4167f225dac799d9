import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_tables import no_docs, some_docs
from ordermill.llm import near_duplicates as N
from ordermill.llm.components import connected_components


def words_of(text):
    return tuple(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))


def grams(words):
    return {words[i : i + 5] for i in range(len(words) - 4)} if len(words) >= 5 else {words} if words else set()


def brute(rows):
    """(doc_id, class, links) by comparing all texts; classes by union."""
    texts = [words_of(t) for _, t in rows]
    sets = {w: grams(w) for w in set(texts)}
    copies = Counter(texts)
    known = sorted(sets)
    near = defaultdict(set)
    for i, a in enumerate(known):
        for b in known[i + 1 :]:
            either = len(sets[a] | sets[b])
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * either:
                near[a].add(b)
                near[b].add(a)
    root = {}
    for w in known:
        if w not in root:
            todo = [w]
            while todo:
                x = todo.pop()
                if x not in root:
                    root[x] = w
                    todo += near[x]
    least = {}
    for (d, _), w in zip(rows, texts, strict=True):
        if w and d is not None:
            least[root[w]] = min(d, least.get(root[w], d))
    return sorted(((d, least.get(root[w]) if w else d, (sum(copies[x] for x in near[w]) + copies[w] - 1) if w else 0)
                   for (d, _), w in zip(rows, texts, strict=True)), key=repr)


def family(rng, n, length, changes):
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    made = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(length)] = f"c{rng.randrange(5000)}"
        made.append(" ".join(own))
    return made


@pytest.fixture
def rows():
    rng = random.Random(5)
    texts = family(rng, 60, 120, 3) + family(rng, 12, 400, 9) + family(rng, 30, 30, 1) + [t for _ in range(40) for t in family(rng, 2, rng.randint(5, 200), 4)]
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{t} {passage}" for t in family(rng, 1, 200, 0) * 3 + [" ".join(f"u{rng.random()}" for _ in range(150)) for _ in range(50)]]
    texts += [None, "", " ", "One two", "one\ttwo", "one", texts[0].upper(), *[texts[61]] * 9]
    ids = rng.sample(range(10_000), len(texts))
    return [*zip(ids, texts, strict=True), (ids[3], texts[3]), (None, texts[3]), (None, "alone without an id")]


@pytest.mark.parametrize("blocks", [(1024, 512), (7, 5)])
def test_links_and_classes_are_those_of_brute_force(spark, rows, monkeypatch, blocks):
    monkeypatch.setattr(N, "BUCKET_BLOCK", blocks[0])
    monkeypatch.setattr(N, "GROUP_BLOCK", blocks[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted(((r.doc_id, r.class_id, r.n_links) for r in N.near_duplicates(docs).collect()), key=repr)
    assert found == brute(rows)


def test_one_of_each_class_stays(spark, rows):
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, node string").repartition(3)
    kept = N.one_of_each_class(docs)
    assert kept.columns == docs.columns
    found = brute(rows)
    expected = Counter(d for d, _ in {(d, words_of(t)) for d, t in rows if words_of(t)} if any(f[0] == d and f[1] == d for f in found))
    expected.update(d for d, t in rows if not words_of(t))
    expected[None] = 1  # the copy without an id goes, the text of its own stays
    assert Counter(r.doc_id for r in kept.collect()) == expected


def test_one_row_stays_of_versions_under_one_id_and_of_classes_without_ids(spark):
    base = [f"w{i}" for i in range(80)]
    version = lambda prefix, k: " ".join([*(prefix + w for w in base), f"end{k}"])
    rows = [(1, version("a", k)) for k in range(4)] * 2 + [(9, version("a", 9))]
    rows += [(None, version("b", k)) for k in range(3)] * 2
    rows += [(5, version("c", 0)), (5, version("d", 0)), (None, version("c", 1))]  # one id in two classes
    kept = N.one_of_each_class(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id or 0, r.text[0]) for r in kept) == [(0, "b"), (1, "a"), (5, "c"), (5, "d")]


def test_odd_rows(spark):
    docs = some_docs(spark)
    assert N.near_duplicates(docs).count() == docs.count()
    assert N.near_duplicates(no_docs(spark)).count() == 0
    assert N.one_of_each_class(no_docs(spark)).count() == 0


def test_pruning_keeps_what_may_reach_the_threshold():
    least = N.least_matches(0.8)
    rng = np.random.default_rng(1)
    one = rng.integers(0, 65536, (4000, N.HASHES)).astype(np.uint16)
    same = rng.random((4000, N.HASHES)) < 0.8
    assert N.may_be_similar(one, np.where(same, one, one ^ 1).astype(np.uint16), least).mean() > 0.999
    same = rng.random((4000, N.HASHES)) < 0.3
    assert N.may_be_similar(one, np.where(same, one, one ^ 1).astype(np.uint16), least).mean() < 0.01


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 9)] + [(201, 200), (200, 201)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[100 + k] == 100 for k in range(9)) and found[201] == 200 and len(found) == 52


def test_documents_without_ids_meet_their_own_words_alone(spark):
    words = lambda i: " ".join(f"w{i // 2}x{k}" for k in range(40)) + (" tail" if i % 2 else "")
    docs = spark.createDataFrame([(None, words(i)) for i in range(2000)] + [(7, words(1)), (7, words(2))] + [(None, words(0))] * 500, "doc_id long, text string")
    sized = N.one_text_each(docs)
    assert sized.count() == 2002
    found = N.near_duplicates(docs)
    assert found.count() == 2502 and found.where("n_links = 0").isEmpty()
    assert {r["n_links"] for r in found.where("copies > 400").collect()} == {502}

