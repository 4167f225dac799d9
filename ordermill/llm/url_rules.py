"""URL filters by hashed host-suffix and path-prefix expressions (operator 12).

A rule is a host and the beginning of a path.  It fits a URL of that host, or of a subdomain, whose path begins so; then
one of the URL's expressions, a suffix of whole labels of its host followed by a prefix of its path, is the rule's text.
Only expressions of a shape that some rule has (labels of the host, characters of the path) are made.  They meet the
rules on the first ``SHORT`` hexadecimal digits of their SHA-256; the whole digest then confirms, and of the rules
that fit the longest decides.

All is DataFrame functions: a URL's expressions are made, joined and reduced to the one that decides where the
URL is read, so just one row for each URL is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORT = 8  # hexadecimal digits of the joined prefix, 32 bits
BROADCAST_BYTES = 32 << 20  # rules of at most so many bytes, measured, go to every task; more are joined by a shuffle
SLICES = 16  # of a shuffled join: URLs of one expression go to so many places, to each of which its rules are copied
RULE_BYTES = 200  # of a rule beside its text: digest, verdict, row and hash table
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty for null and without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def labels(host: Column) -> Column:
    return F.char_length(host) - F.char_length(F.replace(host, F.lit("."))) + 1


def prepared(rules: DataFrame) -> DataFrame:
    """One row for each different rule that can fit: rule, digest, short, precedence (struct) and verdict, beside its shape."""
    host = F.translate(F.coalesce(F.col("host"), F.lit("")), _UPPER, _LOWER)
    named = rules.select(host.alias("host"), F.coalesce(F.col("path"), F.lit("")).alias("path"), "verdict")
    named = named.where("verdict IN ('allow', 'block') AND (path = '' OR startswith(path, '/'))").where(~F.col("host").rlike("[/?#]") & ~F.col("path").rlike("[?#]"))
    named = named.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block if there are both
    text = F.concat("host", "path")
    return named.select(
        text.alias("rule"), F.sha2(text, 256).alias("digest"), F.left(F.sha2(text, 256), F.lit(SHORT)).alias("short"), "verdict",
        labels(F.col("host")).alias("labels"), F.char_length("path").alias("letters"), F.char_length("host").alias("host_letters"))


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The texts of a URL that rules of these shapes (labels of the host, characters of the path) can have."""
    held = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(m).alias("m")) for n, m in shapes])
    fitting = F.filter(held, lambda s: (s["n"] <= labels(host)) & (s["m"] <= F.char_length(path)))
    return F.transform(fitting, lambda s: F.concat(F.call_function("substring_index", host, F.lit("."), -s["n"]), F.substring(path, F.lit(1), s["m"])))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url).

    ``rules`` has host, path and verdict (allow or block).  A rule fits its host and all subdomains, label by label, if the
    path begins with the rule's, character by character; a port or user name counts as part of the host.  The rule of
    most characters decides; of equally long ones that of the longer host; of equal ones a block.  Without one the verdict
    is ``default`` and rule is null.  Null urls and urls without ``://`` have empty host and path; a rule of null or
    empty host fits them alone.  Rules with another verdict, or with ``?`` or ``#`` (or a path that does not begin with
    ``/``), fit nothing.  Repeated rows of ``pages`` are judged one by one; an empty table gives no rows, and without rules
    every verdict is ``default``.

    The shapes of rules come to the driver: as many pairs of label count and path length as rules have, at most 127
    labels by the length of host names.
    """
    known = prepared(rules)
    sized = known.agg(F.coalesce(F.sum(F.octet_length("rule") + RULE_BYTES), F.lit(0)).alias("bytes"), F.collect_set(F.struct("labels", "letters")).alias("shapes")).first()
    host, path = host_and_path(F.col("url"))
    found = pages.select("page_id", host.alias("host"), path.alias("path"))
    if not sized["shapes"]:
        return found.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    made = expressions(F.col("host"), F.col("path"), sorted((s["labels"], s["letters"]) for s in sized["shapes"]))
    asked = found.withColumn("_row", F.monotonically_increasing_id()).select("*", F.explode_outer(made).alias("_text"))
    asked = asked.withColumn("_digest", F.sha2("_text", 256)).withColumn("_short", F.left("_digest", F.lit(SHORT)))
    known = known.select("short", "digest", F.struct((F.col("host_letters") + F.col("letters")).alias("length"), "host_letters", "rule", "verdict").alias("best"))
    if sized["bytes"] <= BROADCAST_BYTES:
        met = asked.join(F.broadcast(known), F.col("_short") == F.col("short"), "left")
    else:
        known = known.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
        asked = asked.withColumn("_slice", F.pmod(F.xxhash64("_row"), F.lit(SLICES)).cast("int"))
        met = asked.join(known, (F.col("_short") == F.col("short")) & (F.col("_slice") == F.col("slice")), "left")
    fits = (F.col("_digest") == F.col("digest")) & ((F.col("best.host_letters") > 0) | (F.col("host") == ""))  # "a." is no subdomain of ""
    confirmed = F.when(fits, F.col("best"))
    judged = met.groupBy("_row", "page_id", "host", "path").agg(F.array_max(F.collect_list(confirmed)).alias("best"))
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
