import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
import test_decontaminate
import test_mixing
import test_near_duplicates
from conftest import DATA
from llm_tables import KINDS, no_docs, some_docs, with_clashes
from ordermill.llm import mixing
from ordermill.llm.queries import WORD_BPE


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("score", F.lit(1))
    junk = docs.limit(2).withColumn("text", F.lit("12345 67890 ?!"))
    docs = docs.union(junk.withColumn("doc_id", F.col("doc_id") + 10**6)).union(docs.limit(1))
    kept = P.known_language(spark, docs, DATA).cache()
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in docs.collect() if r.doc_id < 10**6)

    one = P.without_near_duplicates(spark, kept, DATA).cache()
    rows = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
    least = {d for d, c, _ in test_near_duplicates.brute(rows) if d == c}
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect()) == sorted(least)

    clean = P.without_benchmark(spark, one, DATA).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    bad = {r[0] for r in test_decontaminate.brute([(r.doc_id, r.text) for r in one.collect()], items)}
    assert bad and clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == sorted(least - bad)

    mix = P.mixed(spark, clean, DATA).cache()
    taken, size, source = Counter(r.doc_id for r in mix.collect()), {}, {}
    for r in clean.collect():
        size[r.doc_id], source[r.doc_id] = len(r.text.split()), r.source
    assert mix.columns == docs.columns and set(taken) <= set(size) and max(taken.values()) <= mixing.LIMIT
    sizes, words, largest = Counter(), Counter(), Counter()
    for d, s in source.items():
        sizes[s] += size[d]
        words[s] += size[d] * taken[d]
        largest[s] = max(largest[s], size[d])
    for s, t in test_mixing.expected_targets(sizes).items():
        assert abs(words[s] - t) <= largest[s] + 1e-4 * t

    found = sorted(P.token_output(spark, mix, DATA).collect(), key=lambda r: r.start)
    library = Tokenizer.from_file(WORD_BPE)
    ids = [[*library.encode(r.text, add_special_tokens=False).ids, 1] for r in sorted(mix.collect(), key=lambda r: r.doc_id)]
    assert [r.start for r in found] == [0, *np.cumsum([len(x) for x in ids])[:-1]]
    assert [r.ids_crc32 for r in found] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]


def test_short_texts_of_no_learned_language_go(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    foreign = ["Да", "мир", "Привет", "Привет, как дела?", "日本語", "これは日本語の文章です", "שלום"]
    native = ["x", "ok", "Yes.", "The end", "naïve café", "año", "straße", "what is that?"]
    short = [(10**6 + i, t, None) for i, t in enumerate(foreign)] + [(2 * 10**6 + i, t, None) for i, t in enumerate(native)]
    kept = P.known_language(spark, docs.union(spark.createDataFrame(short, docs.schema)), DATA)
    assert sorted(r.text for r in kept.where("doc_id >= 1000000").collect()) == sorted(native)


def test_run_is_its_stages(spark):
    assert [name for name, _ in P.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "token_files"]
    rows = P.run(spark, DATA).collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "start", "n_tokens", "ids_crc32", "file"}


def test_odd_rows_pass_every_stage(spark):
    for docs in (with_clashes(some_docs(spark)), no_docs(spark, KINDS)):
        n = docs.count()
        for _, stage in P.STAGES[:-1]:
            after = stage(spark, docs, DATA).cache()
            assert after.columns == docs.columns and (n > 0 or after.count() == 0)
            if n:
                assert 0 < after.count() and {r["_node"] for r in after.collect()} == {"own _node"}
                assert after.select("_mix_key", "_doc", "_letter").distinct().collect() == [("own _mix_key", "own _doc", "own _letter")]
            docs = after
        assert P.token_output(spark, docs, DATA).count() == docs.count()
