import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from conftest import DATA
from llm_tables import no_docs, some_docs
from ordermill.llm import language as L
from ordermill.llm.columns import utf8
from ordermill.llm.queries import QUERIES

SAMPLES = {"a": ["abracadabra abra", "cadabra, dabra"], "b": ["xyzzy plugh abra", "", "zyx\n\nxy"]}


def direct_bits(texts, text):
    """Code length by the definition, one byte and one context at a time."""
    seen = defaultdict(lambda: defaultdict(int))
    for t in texts:
        padded = b"\n" * L.ORDER + t.encode()
        for i in range(L.ORDER, len(padded)):
            for k in range(L.ORDER + 1):
                seen[padded[i - k : i]][padded[i]] += 1

    def chance(context, byte):
        if context is None:
            return 1 / 256
        shorter = context[1:] if context else None
        if context not in seen:
            return chance(shorter, byte)
        own = seen[context]
        total, kinds = sum(own.values()), len(own)
        if byte in own:
            return own[byte] / (total + kinds)
        left = 1 - sum(chance(shorter, b) for b in own)
        return kinds / (total + kinds) * chance(shorter, byte) / left

    padded = b"\n" * L.ORDER + text.encode()
    return -sum(math.log2(chance(padded[i - L.ORDER : i], padded[i])) for i in range(L.ORDER, len(padded)))


@pytest.mark.parametrize("text", ["abra", "xyz abracadabra!", "q", "é", "dabra zyx\n", "x" * 40])
def test_code_lengths_follow_the_definition(text):
    model = L.Model(SAMPLES)
    bits = model.code_lengths(*utf8(pa.array(["other", text, "", text])))
    for i, name in enumerate(model.languages):
        expected = direct_bits(SAMPLES[name], text)
        assert bits[1, i] == pytest.approx(expected, rel=1e-4) and bits[3, i] == pytest.approx(expected, rel=1e-4)
    assert (bits[2] == 0).all()


def test_next_bytes_have_probability_one():
    model = L.Model(SAMPLES)
    whole = model.code_lengths(*utf8(pa.array(["abr"])))[0]
    data = np.concatenate([np.frombuffer(b"abr" + bytes([b]), np.uint8) for b in range(256)])
    bits = model.code_lengths(data, np.arange(257) * 4)
    assert np.exp2(whole - bits).sum(0) == pytest.approx([1, 1], rel=1e-3)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64])
def test_pieces_do_not_change_code_lengths(monkeypatch, size):
    model, texts = L.Model(SAMPLES), pa.array(["", "abracadabra xyzzy", "q", "", "plugh " * 9, "é", ""])
    whole = model.code_lengths(*utf8(texts))
    monkeypatch.setattr(L, "PIECE_BYTES", size)
    assert model.code_lengths(*utf8(texts)) == pytest.approx(whole, rel=1e-9)


def test_table_finds_just_its_keys():
    rng = random.Random(1)
    keys = np.array(sorted({rng.randrange(1 << 40) for _ in range(5000)}))
    table = L.Table(keys[::2])
    assert (table.find(keys[::2]) == table.slot_of).all() and (table.find(keys[1::2]) == -1).all()


def test_held_out_accuracy(spark):
    rows = QUERIES["op1_ppm_language"](spark, DATA).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert len(rows) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    own = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in own) >= 0.97 * len(own)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    docs = some_docs(spark)
    model = L.fit(docs)
    found = L.predict(docs, model)
    assert found.drop("lang_pred", "bits_per_byte").columns == [*[c for c in docs.columns if c != "score"], "score"]
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert {r.lang_pred for r in L.predict(docs, L.fit(docs.limit(0))).collect()} == {"und"}
    assert L.predict(no_docs(spark), model).count() == 0 and L.fit(no_docs(spark)) is None


@pytest.mark.parametrize("short", [0, 400])
def test_languages_of_long_texts_only_are_learnt(spark, short):
    rng = random.Random(2)
    text = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))
    long = [(i, text("жзиклмнопр", 6000), "ru") for i in range(3)] + [(10, text("abcdefgh", 8000), "en")]
    docs = long + [(100 + i, text("qrstuvw", 30), "xx") for i in range(short)] + [(1000, "", "none")]
    model = L.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert model.languages == sorted({"ru", "en"} | ({"xx"} if short else set()))
    asked = spark.createDataFrame([(1, text("жзиклмнопр", 20)), (2, text("abcdefgh", 20))], "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, r.bits_per_byte < 8) for r in L.predict(asked, model).collect()}
    assert found == {1: ("ru", True), 2: ("en", True)}


def test_the_sample_of_a_language_is_bounded(spark, monkeypatch):
    taken = {}
    monkeypatch.setattr(L, "Model", lambda samples: taken.update(samples))
    monkeypatch.setattr(L, "BYTES_PER_LANGUAGE", 60_000)
    docs = [(i, "é" * 5000, "many") for i in range(2000)] + [(5000, "é" * 50_000, "one"), (5001, "x" * 50_000, "whole")]
    L.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    sizes = {name: [len(t.encode()) for t in texts] for name, texts in taken.items()}
    assert sizes == {"many": [200] * L.TEXTS_PER_LANGUAGE, "one": [60_000], "whole": [50_000]}


def test_long_texts_give_windows_from_all_of_them(spark):
    text = "".join(chr(0x4E00 + i) for i in range(10_000))
    rows = spark.createDataFrame([(text, 6000, 1), (text, 6000, 2), (text, 100_000, 3), ("é", 1, 4)], "text string, most int, h long")
    found = {r.h: r.w for r in rows.select("h", L.windows(F.col("text"), F.col("most"), F.col("h")).alias("w")).collect()}
    assert found[3] == text and found[4] == "é" and found[1] != found[2]
    for k in range(4):  # 2,000 of the characters, 500 of each quarter in a row
        part = found[1][500 * k : 500 * (k + 1)]
        at = text.index(part[0])
        assert text[at : at + 500] == part and 2500 * k <= at <= 2500 * k + 2000
    assert len(found[1]) == 2000
