"""Small tables that the tests of this folder share."""

import random

from pyspark.sql import functions as F

KINDS = "doc_id long, text string, lang string, source string, n_chars long, score double, `_part` int, before string"


def some_docs(spark, n=60, seed=1, kinds=KINDS):
    """Documents with nulls, empty and long texts, copies, repeated rows, unsorted ids and columns of clashing names."""
    rng = random.Random(seed)
    vocabulary = ["the", "The", "straße", "año", "und", "ende.", "I'm", "x1", "日本語", "a<|endoftext|>b", "é", "é", "naïve", "\x1c"]
    vocabulary += ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 8))) for _ in range(80)]
    text = lambda k: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\n", "  ", "\t", " "]) for _ in range(k))
    texts = [None, "", " \n", "one", "one two three", text(3000)] + [text(rng.randint(1, 60)) for _ in range(n - 10)]
    texts += [texts[8]] * 4
    ids = rng.sample(range(10 * n), n)
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), None, 0.5, 3, "x") for i, t in zip(ids, texts, strict=True)]
    rows += [rows[9], (None, "without an id", "en", "a", None, None, None, None), (ids[12], "same id, other text", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, kinds).repartition(5)


def with_clashes(docs):
    """``docs`` and columns of the names that operators give to columns of their own."""
    own = ["_letter", "_node", "_doc", "_kept", "_number", "_mix_key", "_mix_copies", "_mix_row", "_text", "_removed", "_size", "_crc", "_id", "_shard", "_slot", "_copy"]
    return docs.withColumns({c: F.lit(f"own {c}") for c in own})


def no_docs(spark, kinds=KINDS):
    return spark.createDataFrame([], kinds)
