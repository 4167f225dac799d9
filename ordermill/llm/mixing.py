"""Mixing sources to target weights by entropy balancing (operator 6).

Each document gets a rate, the number of times the mix should take it, between 0 and ``LIMIT``.  Rates are those of
the largest entropy (of a choice with ``LIMIT`` as full rate, 1 as the even start) that meet each source's token
constraint.  The dual is convex with one multiplier per source, and the rates are exponentially tilted:
``rate / (LIMIT - rate) = exp(multiplier * size / mean size)``.  Newton's method finds the multipliers over counts of
equal sizes, and systematic rounding along the sizes turns rates into whole copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.positions import running_sums
from ordermill.llm.storage import settle_table

LIMIT = 2
WEIGHTS = (5, 2, 1)
SHARE = 1.5
UNITS = 1 << 20  # rates are whole multiples of 1/UNITS, so that sums are exact and reruns agree
STEPS = 60
CLOSE = 1e-5  # of the target

WORD = r"[^\x20\x09-\x0D]+"


def with_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words; null and empty texts: 0) and a hash of the text."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("_text"))


def targets(histogram: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """source, source_size, mean_size and target (words) of each source.

    Weights repeat over the sources by code point, null last.  The targets share ``share`` of all sizes by weight, at
    most ``limit`` times the source's own; what is beyond goes to the others by weight.  That is one level for
    all: target = min(limit * size, weight * level).  One row per source is all that meets in one task.
    """
    sums = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"), F.sum("docs").alias("_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = sums.withColumn("weight", weight).withColumn("_most", F.col("source_size") * float(limit))
    full = Window.orderBy(F.col("_most") / F.col("weight"), F.col("source").asc_nulls_last())
    below = full.rowsBetween(Window.unboundedPreceding, -1)
    every = full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({
        "_left": F.sum("source_size").over(every) * share - F.coalesce(F.sum("_most").over(below), F.lit(0.0)),
        "_weights": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(below), F.lit(0.0)),
    }).withColumn("_level", F.col("_left") / F.col("_weights"))
    rows = rows.withColumn("_full", F.col("_most") <= F.col("weight") * F.col("_level"))
    first = F.first(F.when(~F.col("_full"), F.col("_level")), ignorenulls=True).over(every)  # of the first source below its limit
    target = F.when(F.col("_full"), F.col("_most")).otherwise(F.col("weight") * first)
    return rows.select("source", "source_size", "weight", target.alias("target"), (F.col("source_size") / F.col("_docs")).alias("mean_size"))


def rate_units(multiplier: Column, size: Column, mean: Column, limit: int = LIMIT) -> Column:
    """The rate in UNITS: limit / (1 + exp(-multiplier * size / mean))."""
    tilt = F.least(F.greatest(multiplier * size / F.greatest(mean, F.lit(1e-9)), F.lit(-60.0)), F.lit(60.0))
    return F.round(F.lit(float(limit * UNITS)) / (1 + F.exp(-tilt))).cast("long")


def multipliers(histogram: DataFrame, wanted: DataFrame, limit: int = LIMIT) -> DataFrame:
    """source, target, source_size, mean_size and multiplier, by Newton's method for all sources at once.

    Every step is a join of the (source, size) counts with one row per source and a sum per source; the interval that
    holds the root shrinks with each, and a Newton step that leaves it is replaced by its middle.  A source whose target is
    its limit takes the largest multiplier.  Sums of whole units are exact, so every run finds the same numbers.
    """
    state = settle_table(wanted.withColumns({"multiplier": F.lit(0.0), "_low": F.lit(-1e7), "_high": F.lit(1e7), "_off": F.lit(1.0)}), "mix-state")
    for _ in range(STEPS):
        # one row per source on the right; rates depend on (source, size) alone
        right = state.withColumnRenamed("source", "_source")
        units = rate_units(F.col("multiplier"), F.col("size"), F.col("mean_size"), limit)
        each = histogram.join(right, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_units", units)
        words = (F.col("docs") * F.col("size")).cast("decimal(38,0)")
        rate = F.col("_units") / F.lit(float(UNITS))
        slope = F.round(F.col("docs") * F.col("size") * F.col("size") / F.greatest(F.col("mean_size"), F.lit(1e-9)) * rate * (1 - rate / limit) * 1024).cast("decimal(38,0)")
        sums = each.groupBy("source").agg(F.sum(words * F.col("_units")).alias("_words"), F.sum(slope).alias("_slope"))
        old = state.withColumnRenamed("source", "_source")
        moved = sums.join(old, F.col("source").eqNullSafe(F.col("_source")))
        off = F.col("_words").cast("double") / UNITS - F.col("target")
        low = F.when(off < 0, F.col("multiplier")).otherwise(F.col("_low"))
        high = F.when(off < 0, F.col("_high")).otherwise(F.col("multiplier"))
        step = F.col("multiplier") - off / F.greatest(F.col("_slope").cast("double") / 1024, F.lit(1e-12))
        moved = moved.withColumns({"_l": low, "_h": high, "_step": step, "_gap": F.abs(off) / F.greatest(F.col("target"), F.lit(1.0))})
        is_full = F.col("target") >= limit * F.col("source_size") * (1 - 1e-12)
        inside = (F.col("_step") > F.col("_l")) & (F.col("_step") < F.col("_h"))
        following = F.when(is_full, F.lit(1e7)).when(F.col("_gap") <= CLOSE, F.col("multiplier")).when(inside, F.col("_step")).otherwise((F.col("_l") + F.col("_h")) / 2)
        still = F.when(is_full, F.lit(0.0)).when(F.abs(following - F.col("multiplier")) <= 1e-13 * F.abs(F.col("multiplier")), F.lit(0.0)).otherwise(F.col("_gap"))
        state = settle_table(moved.select(
            "source", *wanted.drop("source").columns, following.alias("multiplier"), F.col("_l").alias("_low"), F.col("_h").alias("_high"), still.alias("_off")), "mix-state")
        if state.where(F.col("_off") > CLOSE).isEmpty():
            break
    return state.drop("_low", "_high", "_off")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken and the text's hash ``_text``, one row per document.

    Copies are the steps that the running sum of rates makes over whole numbers, along source, size and a hash, so that
    neighbours of nearly one size make up for each other and a source's words miss its target by about one document.
    Empty texts have size 0 and take nothing from a target.  Null sources are one source; repeated rows are documents of
    their own; an empty table gives no rows.
    """
    sized = settle_table(with_sizes(docs), "mix-sizes")
    histogram = settle_table(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")), "mix-counts")
    found = multipliers(histogram, settle_table(targets(histogram, weights, share, limit), "mix-targets"), limit).withColumnRenamed("source", "_source")
    rated = sized.join(found, F.col("source").eqNullSafe(F.col("_source"))).withColumn("units", rate_units(F.col("multiplier"), F.col("size"), F.col("mean_size"), limit))
    narrow = rated.select("doc_id", "source", "size", "_text", "source_size", "target", "units")
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.xxhash64("doc_id", "_text"), F.col("doc_id")]
    ordered = running_sums(narrow, order, "units", "source")
    copies = F.expr(f"(before + units + {UNITS // 2}) DIV {UNITS} - (before + {UNITS // 2}) DIV {UNITS}")
    return ordered.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).withColumn(
        "rate", F.col("units") / UNITS).drop("before", "units")
