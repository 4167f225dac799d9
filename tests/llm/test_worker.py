import numpy as np

from ordermill.llm import columns, tokens, worker
from ordermill.llm.queries import WORD_BPE


def test_a_task_drops_what_other_stages_left():
    columns.powers(10)
    words = tokens.word_ids(WORD_BPE)
    worker.begin("words")
    assert not columns._kept and tokens.word_ids(WORD_BPE) is words
    again = columns.powers(10)
    worker.begin("powers")
    assert columns._kept and tokens.word_ids(WORD_BPE) is not words
    assert all(np.array_equal(a, b) for a, b in zip(again, columns.powers(10), strict=True))
