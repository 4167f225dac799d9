import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_tables import no_docs, some_docs
from ordermill.llm import token_files as T
from ordermill.llm.queries import WORD_BPE
from ordermill.llm.tokens import WordIds, word_ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), min_size=1, max_size=600), st.floats(0, 1))
def test_block_round_trip(ids, share):
    ids = np.array(ids, np.uint32)
    assert (T.decode_block(np.frombuffer(T.encode_block(ids, share), np.uint8)) == ids).all()


def test_outliers_do_not_widen_a_block():
    ids = np.full(T.BLOCK, 7, np.uint32)
    ids[::100] = 4_000_000_000
    assert len(T.encode_block(ids)) < 16 + T.BLOCK


@pytest.mark.parametrize("ids_per_file", [50, T.IDS_PER_FILE])
def test_files_hold_what_the_library_encodes(spark, tmp_path, ids_per_file):
    docs = some_docs(spark)
    files = T.write_token_files(docs, WORD_BPE, str(tmp_path / "files"), ids_per_file=ids_per_file)
    found = [tuple(r) for r in T.read_token_files(files, str(tmp_path / "files")).drop("file").collect()]
    library = Tokenizer.from_file(WORD_BPE)
    expected = []
    for r in docs.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
        expected.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(((r[0], r[2], r[3]) for r in found), key=repr) == sorted(expected, key=repr)
    found.sort(key=lambda r: r[1])
    assert [r[1] for r in found] == [0, *np.cumsum([r[2] for r in found])[:-1]]
    ids = [-1 if r[0] is None else r[0] for r in found]
    assert ids == sorted(ids)


def test_no_documents_make_no_files(spark, tmp_path):
    files = T.write_token_files(no_docs(spark), WORD_BPE, str(tmp_path / "none"))
    assert files.count() == 0 and T.read_token_files(files, str(tmp_path / "none")).count() == 0


def test_words_longer_than_a_memory_entry(spark, tmp_path):
    docs = spark.createDataFrame([(1, "ab" * 5000 + " c"), (2, None)], "doc_id long, text string")
    rows = T.token_rows(docs, WORD_BPE).orderBy("doc_id").collect()
    assert rows[0].n_tokens == len(Tokenizer.from_file(WORD_BPE).encode("ab" * 5000 + " c").ids) + 1 and rows[1].n_tokens == 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbzéÉßİıª0'’.,$*_<|>\x01 \n\t́ Σς中-"), max_size=14) | st.sampled_from(
    ["<|endoftext|>", "<|ENDOFTEXT|>x", "it's.", "IT'LL!", "a.'s", "Straße...", "x" * 80 + "."]), max_size=4))
def test_words_alone_are_encoded_as_in_the_text(parts):
    words = word_ids(WORD_BPE)
    for text in (" ".join(parts), "".join(parts)):
        expected = np.array(words.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert words.of([text.encode()]) == [expected]


def test_words_are_encoded_once_while_the_memory_holds_them(monkeypatch):
    words, calls = WordIds(WORD_BPE), []
    words.of([b"Mayor."])
    assert set(words) == {b"Mayor.", b"mayor", b"."}
    monkeypatch.setattr(words, "_encode", lambda word: calls.append(1) or b"")
    text = " ".join(map(str, range(550_000))).encode()
    words.of([text, text])
    assert len(calls) == 550_000
