import random
import re

import pytest

from llm_tables import no_docs, some_docs
from ordermill.llm import decontaminate as D


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs, items):
    sets = [(i, grams(t)) for i, t in items]
    found = [(d, i, len(s), len(s & g)) for d, g in ((d, grams(t)) for d, t in docs) for i, s in sets if s and len(s & g) >= 0.8 * len(s)]
    return sorted(found, key=repr)


@pytest.fixture
def planted(spark):
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    items = [(i, " ".join(words(rng.choice([4, 5, 6, 12, 30, 33, 90, 300, 1500])))) for i in range(60)]
    items += [(100, items[9][1].upper()), (101, None), (102, ""), (103, "a a a a a a a a a a a a")]
    docs = []
    for d in range(160):
        body = words(rng.randint(0, 4000) if d % 9 else 60)
        for _ in range(rng.choice([0, 1, 1, 2])):
            passage = (rng.choice(items)[1] or "").split()
            for k in range(len(passage)):
                if rng.random() < 0.02:
                    passage[k] = "changed"
            at = rng.randint(0, len(body))
            body[at:at] = passage
        docs.append((d, "\n".join(body)))
    docs += [(200, "A a a A a a"), (201, None), (202, ""), (docs[5][0], docs[5][1])]
    return (docs, items, spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"))


@pytest.mark.parametrize("lot", [D.ITEMS_PER_PASS, 17])
def test_pairs_are_those_of_brute_force(planted, monkeypatch, lot):
    monkeypatch.setattr(D, "ITEMS_PER_PASS", lot)
    docs, items, docs_df, items_df = planted
    found = sorted(((r.doc_id, r.item_id, r.item_shingles, r.shared) for r in D.contaminated(docs_df, items_df).collect()), key=repr)
    assert found == brute(docs, items) and len(found) > 60


def test_cleaning_drops_just_the_documents_found(spark, planted):
    docs, items, docs_df, items_df = planted
    bad = {r[0] for r in brute(docs, items)}
    assert sorted(r.doc_id for r in D.clean_documents(docs_df, items_df).collect()) == sorted(d for d, _ in docs if d not in bad)
    odd = some_docs(spark)
    kept = D.clean_documents(odd, items_df)
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_empty_tables(spark, planted):
    _, _, docs_df, items_df = planted
    assert D.contaminated(no_docs(spark), items_df).count() == 0
    assert D.contaminated(docs_df, items_df.limit(0)).count() == 0
    assert D.clean_documents(docs_df, items_df.limit(0)).count() == docs_df.count()


def test_short_items_at_the_start_of_documents_are_all_found(spark):
    rng = random.Random(3)
    words = lambda n: " ".join(f"w{rng.randrange(100_000)}" for _ in range(n))
    items = [(i, words(5 + i % 4 if i % 3 == 0 else 5)) for i in range(6000)] + [(6000 + i, f"which of these is w{i}") for i in range(20)]
    docs = [(i, f"{text} {words(40)}") for i, text in items] + [(9000, "which of these is"), (9001, " ".join(["which of these is w3"] * 50))]
    docs_df, items_df = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = sorted((r.doc_id, r.item_id) for r in D.contaminated(docs_df, items_df).collect())
    assert found == sorted([(i, i) for i, _ in items] + [(9001, 6003)])
    assert [r.doc_id for r in D.clean_documents(docs_df, items_df).collect()] == [9000]


def test_a_lower_threshold_finds_short_items_in_part(spark):
    docs = [(1, "a b c d e x y z u v"), (2, "x y a b c d y x"), (3, "x a b c d e f g y z")]
    found = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, "a b c d e f g h")], "item_id long, text string"), 0.5)
    assert [(r.doc_id, r.item_shingles, r.shared) for r in found.collect()] == [(3, 4, 3)]


def test_every_class_keeps_the_stated_similarity():
    for n in range(1, 2000):
        items = D.Items([0], [" ".join(f"w{i}" for i in range(n + 4))])
        if items.classes:
            (k,) = items.classes
            shared = -(-4 * n // 5)
            assert shared / (3 * 2 ** (k - 1) + n - shared) >= 0.25
        else:
            assert n <= D.SHORT and len(items.telling) == 1  # at 0.8 every shingle must be there
