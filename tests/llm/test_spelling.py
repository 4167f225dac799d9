import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
import pyarrow as pa

from llm_tables import no_docs, some_docs
from ordermill.llm import queries, spelling as S


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


def brute(counts, ratio=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, form[w], root(w), counts[w], len(near[w]), counts[form[w]] if form[w] else None) for w in counts)


def variants(rng, word):
    at = rng.randrange(len(word))
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("abcé") + word[at:], word[:at] + rng.choice("abcdÿ") + word[at + 1 :]])


def test_groups_are_those_of_brute_force(spark, rows):
    rng = random.Random(4)
    counts = {}
    for _ in range(40):
        word = "".join(rng.choice("abcdefgéà") for _ in range(rng.randint(6, 11)))
        n = rng.choice([5, 60, 700, 90_000])
        for _ in range(6):
            counts.setdefault(word, n)
            word, n = variants(rng, word), max(5, n // rng.choice([1, 2, 6, 30]))
    counts |= {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "aaaaaaaaa": 625, "aaaaaaaaaa": 3125, "aaaaaaaaaaa": 15625, "aaaaaaaaaaaa": 78125}  # a long chain
    counts |= {"tieabc": 5, "tieabd": 30, "tieabe": 30, "ab": 7, "a": 50, "": 3}  # ties; short words are words too
    found = S.spelling_groups(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4))
    assert rows(found.select("word", "form", "root", "n", "n_near", "form_n")) == sorted(brute(counts), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.text("abcdeé", min_size=0, max_size=12), st.integers(0, 12), st.sampled_from("abzé"), st.sampled_from(["in", "out", "other"]))
def test_words_an_edit_apart_share_a_signature(word, at, letter, edit):
    at = min(at, len(word))
    other = word[:at] + letter + word[at:] if edit == "in" else word[:at] + word[at + 1 :] if edit == "out" else word[:at] + letter + word[at + 1 :]
    one, two = S.signature_values(pa.array([word, other]))
    assert (one == two).any()


def test_far_words_seldom_share_one():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(3000)})
    made = S.signature_values(pa.array(words))
    assert sum(c * c for c in Counter(made.ravel().tolist()).values()) < 2 * made.size


def test_counted_words(spark, rows):
    docs = [(i, "Straße STRASSE naïve.naïve x1abcdefg×y ÷÷÷÷÷÷ short İstanbul") for i in range(5)] + [(None, None), (9, ""), (9, "naïve7naïveté " * 3), (10, "straße")]
    found = S.count_words(S.letter_runs(spark.createDataFrame(docs, "doc_id long, text string")))
    assert rows(found) == sorted([("straße", 6), ("strasse", 5), ("abcdefg×y", 5), ("÷÷÷÷÷÷", 5), ("stanbul", 5)], key=repr)


def test_query_is_its_words_by_brute_force(spark, rows, tmp_path):
    import zlib

    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefg") for _ in range(7)) for _ in range(12)] + ["Überall", "garçons"]
    docs = [(rng.randint(-5, 99) if i else None, " ".join(rng.choice(vocabulary) for _ in range(600)) if i % 7 else None) for i in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 6
    want = brute({w: n for w, n in counts.items() if n >= 5})
    assert any(r[1] for r in want)
    found = queries.op13_spelling_groups(spark, str(tmp_path)).select("word", "form", "root", "n", "n_near", "form_n")
    assert rows(found) == sorted(want, key=repr)


def test_odd_and_empty_tables(spark):
    assert S.spelling_groups(S.count_words(S.letter_runs(no_docs(spark)))).count() == 0
    assert S.spelling_groups(S.count_words(S.letter_runs(some_docs(spark)))).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    with pytest.raises(ValueError):
        S.spelling_groups(spark.createDataFrame([], "word string, n long"), ratio=1)
