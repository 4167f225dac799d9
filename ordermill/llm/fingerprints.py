"""Homomorphic multiset fingerprints of documents (operator 2), with DataFrame functions alone.

A text is the multiset of its paragraphs: its lines, cut also after the ends of sentences so that a text of one line has
parts too.  Every part is hashed to a vector of 68 numbers, and the fingerprint is the sum of these vectors:

* 64 lanes modulo 2**16, to each of which a part adds +1 or -1 by a bit of its hash;
* 4 lanes modulo 2**32, to which it adds uniform numbers of a second hash.

Sums do not depend on the order, and parts are added or taken away without the rest of the text (``combine``).  Texts
with the same parts have the same fingerprint.  The mean square over the first 64 lanes estimates a multiset's squared
size, that of the difference of two fingerprints the squared size of what they do not share; together they give the
likeness, about twice the shared parts over all parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAIRS = 32  # longs that hold two lanes of signs each
UNIFORM = 4
LANE = 1 << 16
WIDE = 1 << 32
PAIR_MASK = 0x0000000100000001
CUTS_PER_BUCKET = 50  # sampled ids to each bucket of the order


def parts(text: Column) -> Column:
    """The paragraphs of a text, without blank ones."""
    return F.filter(F.split(text, r"\n+|(?<=[.!?])\s+"), lambda p: F.length(F.trim(p)) > 0)


def part_hashes(text: Column) -> Column:
    """Two hashes of each part; keep them in a column of their own, ``vector`` reads them many times."""
    return F.transform(parts(text), lambda p: F.struct(F.xxhash64(p).alias("signs"), F.xxhash64(F.lit(1), p).alias("other")))


def vector(hashes: Column) -> Column:
    """The sum over the parts as an array of longs: two lanes in each of 32 (as counts of +1), the number of parts, 4 uniform lanes."""
    zero = F.lit(0).cast("long")

    def ones(k: int) -> Column:
        return F.aggregate(hashes.getField("signs"), zero, lambda a, h: a + F.shiftrightunsigned(h, k).bitwiseAND(F.lit(PAIR_MASK)))

    def uniform(k: int) -> Column:
        return F.aggregate(hashes.getField("other"), zero, lambda a, h: (a + F.xxhash64(h, F.lit(k)).bitwiseAND(F.lit(WIDE - 1))).bitwiseAND(F.lit(WIDE - 1)))

    return F.array(*[ones(k) for k in range(PAIRS)], F.size(hashes).cast("long"), *[uniform(k) for k in range(UNIFORM)])


def combine(one: Column, other: Column, sign: int = 1) -> Column:
    """The vector of two multisets together (``sign=1``), or of the first without the second (``-1``)."""
    summed = F.zip_with(one, other, lambda a, b: a + sign * b)
    return F.transform(summed, lambda v, i: F.when(i > PAIRS, v.bitwiseAND(F.lit(WIDE - 1))).otherwise(v))


def lanes(v: Column) -> Column:
    """The 64 signed lanes: twice the counts of +1 less the number of parts, modulo 2**16 around 0."""
    n = F.element_at(v, PAIRS + 1)
    halves = F.flatten(F.transform(F.slice(v, 1, PAIRS), lambda x: F.array(x.bitwiseAND(F.lit(WIDE - 1)), F.shiftrightunsigned(x, 32))))
    return F.transform(halves, lambda c: F.pmod(2 * c - n + LANE // 2, F.lit(LANE)) - LANE // 2)


def fingerprint(v: Column, signed: Column) -> Column:
    """A vector and its ``lanes`` as text: 64 lanes of 4 hexadecimal digits, 4 lanes of 8."""
    narrow = F.transform(signed, lambda x: F.lpad(F.lower(F.hex(F.pmod(x, F.lit(LANE)))), 4, "0"))
    wide = F.transform(F.slice(v, PAIRS + 2, UNIFORM), lambda x: F.lpad(F.lower(F.hex(x)), 8, "0"))
    return F.concat(F.array_join(narrow, ""), F.array_join(wide, ""))


def likeness(a: Column, b: Column) -> Column:
    """Of two multisets by their ``lanes``, 0 to 1: 1 for equal ones, near 0 for disjoint ones, near twice the shared parts over all parts between."""
    square = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x * x)
    apart = square(F.zip_with(a, b, lambda x, y: F.pmod(x - y + LANE // 2, F.lit(LANE)) - LANE // 2))
    both = square(a) + square(b)
    return F.when(a == b, F.lit(1.0)).when(both <= 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - apart / both)))


def id_cuts(docs: DataFrame, buckets: int) -> list[int]:
    """At most ``buckets - 1`` ids that occur, rising, about as many documents between each two, and the largest id last.

    From ids chosen by a hash, about ``CUTS_PER_BUCKET`` per bucket, as a range partitioner samples its bounds: they
    shape partitions alone.
    """
    ids = docs.select("doc_id").where("doc_id IS NOT NULL")
    total, largest = ids.agg(F.count(F.lit(1)), F.max("doc_id")).first()
    if not total:
        return []
    share = min(1.0, buckets * CUTS_PER_BUCKET / total)
    chosen = sorted({r[0] for r in ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < (1 << 40) * share).limit(4 * buckets * CUTS_PER_BUCKET).collect()})
    return sorted({*(chosen[len(chosen) * k // buckets] for k in range(1, buckets) if chosen), largest})


def bucket_of(doc_id: Column, cuts: list[int]) -> Column:
    """How many cuts lie below the id, by binary search; a null id is below all."""
    if not cuts:
        return F.lit(0)
    known = F.array(*[F.lit(c).cast("long") for c in cuts])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda low, step: F.when((low + step <= len(cuts)) & (F.try_element_at(known, low + step) < doc_id), low + step).otherwise(low))
    return F.when(doc_id.isNull(), 0).otherwise(found)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and that to the next document.

    The edited text has its last ``n_chars DIV 2`` code points replaced by the first as many (or all) of the next
    document, by descending doc_id; the last document's next is the first.  Null texts count as empty; an empty text's
    fingerprint is that of no parts; null ids come last (without any id, the last document's next is itself); rows of one id follow each other by their texts; an empty
    table gives no rows.  Texts are shuffled once, to buckets of the id order; the first document of a bucket is also
    sent to the bucket before, as its last row's next.
    """
    spark = docs.sparkSession
    cuts = id_cuts(docs, max(2, 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("_hashes", part_hashes(F.col("text"))).withColumn("_v", vector(F.col("_hashes"))).drop("_hashes")
    rows = rows.withColumn("_bucket", bucket_of(F.col("doc_id"), cuts))
    # Bucket b holds the ids above cut b-1 up to cut b.  A cut is thus the first of its bucket in falling order, and what
    # follows the last row of the bucket above; the largest id follows the lowest bucket's last row.
    own = F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("guest"))
    homes = F.array(own)
    if cuts:
        at_cut = F.try_element_at(F.array(*[F.lit(c).cast("long") for c in cuts]), F.col("_bucket") + 1) == F.col("doc_id")
        above = F.when(F.col("doc_id") == cuts[-1], 0).otherwise(F.col("_bucket") + 1)
        homes = F.when(F.coalesce(at_cut, F.lit(False)), F.array(own, F.struct(above.alias("b"), F.lit(True).alias("guest")))).otherwise(homes)
    sent = rows.withColumn("_home", F.explode(homes)).select("doc_id", "text", "_v", "_home.b", "_home.guest")
    order = Window.partitionBy("b").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    kept = sent.withColumns({"_next": F.lead("text").over(order), "_next_v": F.lead("_v").over(order)}).where("NOT guest")
    kept = kept.withColumns({"_next": F.coalesce("_next", "text"), "_next_v": F.coalesce("_next_v", "_v"), "n_chars": F.length("text").cast("long")})
    half = F.expr("CAST(n_chars DIV 2 AS INT)")
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("_next", F.lit(1), half))
    kept = kept.select("doc_id", "n_chars", "_v", "_next_v", edited.alias("_edited")).withColumn("_hashes", part_hashes(F.col("_edited")))
    kept = kept.withColumn("_edited_v", vector(F.col("_hashes"))).drop("_hashes")
    kept = kept.withColumns({"_a": lanes(F.col("_v")), "_b": lanes(F.col("_edited_v")), "_c": lanes(F.col("_next_v"))})
    return kept.select(
        "doc_id", "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"), fingerprint(F.col("_v"), F.col("_a")).alias("fingerprint"),
        fingerprint(F.col("_edited_v"), F.col("_b")).alias("edited_fingerprint"), likeness(F.col("_a"), F.col("_b")).alias("near_edited"),
        likeness(F.col("_a"), F.col("_c")).alias("near_next"),
    )
