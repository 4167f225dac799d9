"""From raw documents to token files: the operators of ``ordermill.llm`` in a row.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and read again as the next
stage's ``docs``.  All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm import decontaminate, language, mixing, near_duplicates, token_files
from ordermill.llm.names import aside
from ordermill.llm.queries import WORD_BPE, table
from ordermill.llm.shipping import ship_package
from ordermill.llm.storage import settle_table

WORST_BITS = 8.0  # a byte; a text that costs more in every language than plain bytes do is in none of them
MARGIN_BITS = 20.0  # a text may cost so many more; a word or two in a learned language seldom costs 4 more


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages; texts that are null, without a letter or in none of them go.

    Learns from a bounded sample of ``docs`` with a language.  Without any, nothing can be told and all with a letter stay.
    """
    ship_package(spark)
    model = language.fit(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    rows, back = aside(docs, "text")
    known = (F.col("bits_per_byte") - WORST_BITS) * F.octet_length("text") <= MARGIN_BITS
    found = language.predict(rows, model).where((F.col("lang_pred") != language.UNKNOWN) & known)
    return back(found)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the least id."""
    ship_package(spark)
    return near_duplicates.one_of_each_class(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice.

    Rows that repeat id, source and text meet their numbers of copies one by one.
    """
    ship_package(spark)
    rows, back = aside(docs, "doc_id", "source", "text")
    copies = mixing.mix(rows).groupBy(F.xxhash64("doc_id", "source", "_text").alias("_mix_key")).agg(F.sort_array(F.collect_list(F.col("copies").cast("int"))).alias("_mix_copies"))
    named = rows.withColumn("_mix_key", F.xxhash64("doc_id", "source", F.xxhash64("text")))
    named = named.withColumn("_mix_row", F.row_number().over(Window.partitionBy("_mix_key").orderBy("_mix_key")))
    taken = named.join(copies, "_mix_key").withColumn("_mix_times", F.element_at("_mix_copies", F.col("_mix_row")))
    return back(taken.where("_mix_times > 0").withColumn("_mix_time", F.explode(F.sequence(F.lit(1), F.col("_mix_times")))))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' places in the token files: doc_id, start, n_tokens, ids_crc32 and file."""
    ship_package(spark)
    return token_files.token_rows(docs, WORD_BPE)


STAGES = [
    ("language", known_language),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_files", token_output),
]

ORACLE_SQL = None  # trained models and a tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
