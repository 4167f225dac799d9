import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest import DATA
from llm_tables import no_docs, some_docs
from ordermill.llm import maxent as M
from ordermill.llm.queries import QUERIES


def tokens_of(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode()), None]


def brute(texts, train):
    counts = Counter(t for text in train for t in tokens_of(text))
    total, kinds = sum(counts.values()), len(counts)
    rows = []
    for text in texts:
        own = tokens_of(text)
        rows.append((len(own), sum(counts[t] > 0 for t in own), total, sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in own)))
    return rows


@pytest.mark.parametrize("most", [M.BROADCAST_WORDS, 0])
def test_base_scores_and_counts(spark, most):
    docs = some_docs(spark)
    rows = docs.collect()
    train = docs.where("doc_id % 3 <> 0")
    found = M.score(docs, M.fit(train), most).collect()
    expected = brute([r.text for r in rows], [r.text for r in rows if r.doc_id is not None and r.doc_id % 3])
    ours = sorted(((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found))
    theirs = sorted((r.doc_id or -1, *e) for r, e in zip(rows, expected, strict=True))
    assert [o[:4] for o in ours] == [t[:4] for t in theirs]
    assert np.allclose([o[4] for o in ours], [t[4] for t in theirs], rtol=1e-9)


def test_both_ways_to_look_words_up_agree(spark):
    docs = some_docs(spark)
    model = M.fit(docs)
    one, two = (sorted((r.doc_id or -1, r.n_tokens, round(r.score, 6)) for r in M.score(docs, model, most).collect()) for most in (10**6, 0))
    assert one == two


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = QUERIES["op5_maxent_scores"](spark, DATA).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in rows)
    own = [r for r in rows if r.held_out]
    assert sum(r.score for r in own) > 0.98 * sum(r.base_score for r in own) and sum(r.score > r.base_score for r in own) > 0.9 * len(own)


def test_classes_have_probability_one(spark):
    model = M.fit(some_docs(spark))
    found = np.random.default_rng(1).integers(0, M.FEATURES, (M.TEMPLATES, 50))
    assert np.exp(model.class_logs(found)).sum(1) == pytest.approx(np.ones(50), rel=1e-4)


def test_updates_bring_expected_counts_nearer(spark):
    docs = some_docs(spark)
    model = M.fit(docs)
    seen = M.feature_counts(docs, model, expected=False)
    trained = np.abs(M.feature_counts(docs, model, expected=True) - seen).sum()
    model.weights = np.zeros_like(model.weights)
    assert trained < np.abs(M.feature_counts(docs, model, expected=True) - seen).sum()


def test_no_rows(spark):
    docs = some_docs(spark)
    assert M.score(no_docs(spark), M.fit(docs)).count() == 0
    assert all(r.base_score == 0 and r.n_known == 0 for r in M.score(docs, M.fit(docs.limit(0))).collect())


def test_a_word_in_its_class_depends_on_the_words_before(spark):
    train = spark.createDataFrame([(i, "one redot" if i % 2 else "two bluot") for i in range(400)], "doc_id long, text string")
    texts = spark.createDataFrame([(1, "one redot"), (2, "one bluot"), (3, "two bluot"), (4, "two redot")], "doc_id long, text string")
    model = M.fit(train)
    for most in (M.BROADCAST_WORDS, 0):
        score = {r.doc_id: r.score for r in M.score(texts, model, most).collect()}
        assert score[1] > score[2] + 0.3 and score[3] > score[4] + 0.3


def test_score_is_the_softmax_over_all_words_of_the_class(spark):
    docs = some_docs(spark, 30)
    model, rows = M.fit(docs), docs.collect()
    words = {}
    for text in [r.text for r in rows]:
        hashes, tails, _ = M.tokens(_batch(text))
        for h, tail in zip(hashes.tolist(), tails, strict=True):
            words[h] = [tail, words.get(h, [0, 0])[1] + 1]

    def of(text):
        hashes, tails, counts = M.tokens(_batch(text))
        total = 0.0
        for at, (h, tail) in enumerate(zip(hashes.tolist(), tails, strict=True)):
            found, own = M.features(hashes, counts)[:, at], model.class_of[tail]
            weight = lambda w: sum(float(model.word_weights[t, own, v, found[t] % M.SLOTS]) for t in range(3) for v in (w >> 60, 16 + (w >> 56) % 16))  # noqa: B023, E731
            raised = {w: (n + 0.1) * math.exp(weight(w)) for w, (kind, n) in words.items() if model.class_of[kind] == own}
            scores = model.bias + sum(model.weights[t, :, found[t]] for t in range(3))
            total += math.log10(math.exp(scores[own]) / np.exp(scores).sum() * raised.get(h, 0.1) / (sum(raised.values()) + 0.1))
        return total

    unknown = spark.createDataFrame([(-5, "nobody ever wrote the quixotic")], "doc_id long, text string")
    found = {(r.doc_id, r.n_tokens): r.score for r in M.score(docs.select("doc_id", "text").union(unknown), model).collect()}
    for r in [*rows, *unknown.collect()]:
        if len(tokens_of(r.text)) < 100:
            assert found[r.doc_id, len(tokens_of(r.text))] == pytest.approx(of(r.text), rel=1e-5)


def _batch(text):
    return pa.RecordBatch.from_arrays([pa.array([text], pa.string())], ["text"])
