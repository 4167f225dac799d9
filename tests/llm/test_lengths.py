from collections import Counter

from tokenizers import Tokenizer

from llm_tables import no_docs, some_docs
from ordermill.llm import lengths as L
from ordermill.llm.queries import WORD_BPE


def test_histogram_sums_and_quantiles(spark):
    docs = some_docs(spark)
    library = Tokenizer.from_file(WORD_BPE)
    known = {}
    for r in docs.collect():
        known.setdefault(r.source, []).append(len(library.encode(r.text or "").ids))
    histogram = L.length_histogram(docs, WORD_BPE, ["source"]).cache()
    rows = histogram.collect()
    assert {(r.source, r.length): r.docs for r in rows} == {(s, n): k for s, all_ in known.items() for n, k in Counter(all_).items()}
    for r in rows:
        own = known[r.source]
        assert r.docs_at_least == sum(n >= r.length for n in own)
        assert r.tokens_at_least == sum(n for n in own if n >= r.length)
        assert r.truncated_tokens == sum(min(n, r.length) for n in own)
        assert (r.group_docs, r.group_tokens) == (len(own), sum(own))
    for limit in (0, 7, 10**6):
        cut = {r.source: (r.tokens, r.docs_cut) for r in L.truncated_total(histogram, ["source"], limit).collect()}
        assert cut == {s: (sum(min(n, limit) for n in own), sum(n > limit for n in own)) for s, own in known.items()}
    for r in L.length_quantiles(histogram, ["source"], [0.1, 0.5, 1.0]).collect():
        own = sorted(known[r.source])
        need = -(-r.share * len(own) // 1)
        assert r.length == min(n for n in own if sum(m <= n for m in own) >= need)


def test_without_groups_and_without_rows(spark):
    whole = L.length_histogram(some_docs(spark), WORD_BPE, []).collect()
    assert sum(r.docs for r in whole) == whole[0].group_docs == 63
    assert L.length_histogram(no_docs(spark), WORD_BPE, ["lang"]).count() == 0
