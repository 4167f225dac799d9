"""The registered queries of this subpackage; each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import decontaminate, fingerprints, hard_negatives, language, lengths, line_dedup, maxent, mixing, near_duplicates, sharding, spelling, token_files, url_rules
from ordermill.llm.shipping import ship_package

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ppm_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(3)) == 1
    model = language.fit(docs.where(~held_out))
    named = language.predict(docs.select("doc_id", "text"), model)
    return named.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op2_multiset_hash(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents")).drop("node")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.repeated_lines(table(spark, folder, "documents"))
    return found.withColumn("removed_lines", F.size("removed"))


def op5_maxent_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(10)) == 0
    scored = maxent.score(docs, maxent.fit(docs.where(~held_out)))
    return scored.withColumn("held_out", held_out)


def op6_entropy_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken", "rate", "copies")


def op7_length_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return lengths.length_histogram(table(spark, folder, "documents"), WORD_BPE, ["source", "lang"])


def op8_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_rows(table(spark, folder, "documents"), 40)
    return placed.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


def op9_pfor_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_rows(table(spark, folder, "documents"), WORD_BPE).drop("file")


def op10_minhash_containment(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, label).drop("place")


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op12_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, folder, "pages"), rules)


def op13_spelling_groups(spark: SparkSession, folder: str) -> DataFrame:
    runs = spelling.letter_runs(table(spark, folder, "documents"))
    h = F.crc32(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "run"))
    at = F.pmod(h, F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    words = F.when(F.pmod(h, F.lit(199)) == 0, cut).otherwise(F.col("run"))
    return spelling.spelling_groups(spelling.count_words(runs, words))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_ppm_language, op2_multiset_hash, op3_jaccard_join, op4_line_dedup, op5_maxent_scores, op6_entropy_mix,
        op7_length_histogram, op8_hilbert_shards, op9_pfor_files, op10_minhash_containment, op11_hard_negatives, op12_url_rules, op13_spelling_groups,
    )
}
_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
_SHINGLES = """SELECT DISTINCT {id}, array_to_string(w[i:i+4], ' ') AS shingle
  FROM (SELECT {id}, w, unnest(range(1, len(w) - 3)) AS i FROM (SELECT {id}, {words} AS w FROM {table}))"""



def _crc_step(value: int) -> int:
    """One byte of the polynomial of crc32, as SQL cannot."""
    for _ in range(8):
        value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
    return value


_CRC_BYTES = "flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END))"
_CRC = f"xor(list_reduce({_CRC_BYTES}, lambda c, b: xor(c >> 8, list_extract({[_crc_step(i) for i in range(256)]}::BIGINT[], (xor(c, b) & 255) + 1)), 4294967295::BIGINT), 4294967295::BIGINT)"
_OTHER_LETTERS = "list_filter(string_split(word, ''), lambda c, k: k <> i)"

ORACLES: dict[str, str] = {
    "op10_minhash_containment": f"""
WITH d AS ({_SHINGLES.format(id="doc_id", table="documents", words=_WORDS)}),
b AS ({_SHINGLES.format(id="item_id", table="benchmark", words=_WORDS)}),
n AS (SELECT item_id, count(*) AS item_shingles FROM b GROUP BY item_id),
s AS (SELECT doc_id, item_id, count(*) AS shared FROM d JOIN b USING (shingle) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, item_shingles, shared, shared / item_shingles::DOUBLE AS containment
FROM s JOIN n USING (item_id) WHERE shared >= 0.8 * item_shingles""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5""",
    "op12_url_rules": f"""
WITH r(host, path, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages),
h AS (
  SELECT row_number() OVER () AS n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT h.page_id, h.host, h.path, arg_max(r.host || r.path, len(r.host || r.path)) AS rule,
       coalesce(arg_max(r.verdict, len(r.host || r.path)), 'allow') AS verdict
FROM h LEFT JOIN r ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path)
GROUP BY h.n, h.page_id, h.host, h.path""",
    "op13_spelling_groups": f"""
WITH RECURSIVE t AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
l AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times FROM t WHERE len(run) >= 6 GROUP BY ALL),
h AS (SELECT run, times, {_CRC.format(text="coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM l),
w AS (
  SELECT CASE WHEN h % 199 = 0 THEN run[:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, times FROM h),
v AS (SELECT word, sum(times)::BIGINT AS n FROM w WHERE len(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
i AS (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM v),
d AS (SELECT word, n, i, len(word) AS letters, array_to_string({_OTHER_LETTERS}, '') AS less FROM i),
p AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM d AS a JOIN d AS b USING (less, i, letters) WHERE a.word <> b.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.less = v.word
  UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.less = v.word),
b AS (SELECT word, count(*) AS n_near, max(near_n) AS most, arg_min(near, (-near_n, near)) AS best FROM p GROUP BY word),
f AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.most >= 5 * v.n THEN b.best END AS form, CASE WHEN b.most >= 5 * v.n THEN b.most END AS form_n
  FROM v LEFT JOIN b ON v.word = b.word),
r(word, root) AS (
  SELECT word, word FROM f WHERE form IS NULL
  UNION ALL SELECT f.word, r.root FROM f JOIN r ON f.form = r.word)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM f JOIN r ON f.word = r.word""",
}
