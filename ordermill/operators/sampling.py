"""Weighted selection, reproducible: every draw is a hash of an id and a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions import seeded
from ordermill.operators.joins import join_keyed
from ordermill.session import settle

LEAF_ITEMS = 1 << 16
BLOCK_LEAVES = 1 << 12


def weighted_sample(items: DataFrame, key: str, weight: str, n: int, seed: int | str = 42) -> DataFrame:
    """n rows without replacement, chosen in proportion to ``weight``."""
    return (
        items.where(F.col(weight) > 0)
        .withColumn("_arrival", seeded.race(F.col(key), F.col(weight).cast("double"), seed))
        .orderBy("_arrival", key)
        .limit(n)
        .drop("_arrival")
    )


def prefix_sums(items: DataFrame, key: str, weight: str, digits: int = 3, seed: int | str = "order") -> DataFrame:
    """Running total of ``weight`` as [low, high) per row, without sorting all rows in one task.

    Rows fall into 16**digits buckets by a hash of their unique key, so no bucket can be hot; sums run
    inside the buckets, and the bucket totals, 16**digits rows, are the only thing summed in one place.
    """
    bucketed = items.withColumn("_bucket", F.substring(seeded.digest(F.col(key), seed), 1, digits))
    inside = Window.partitionBy("_bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.sum(weight).alias("_sum"))
        .select("_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        bucketed.withColumn("_upto", F.sum(weight).over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn("high", F.col("_upto") + F.col("_offset"))
        .withColumn("low", F.col("high") - F.col(weight))
        .drop("_bucket", "_upto", "_offset")
    )


def weighted_draws(
    draws: DataFrame,
    draw_key: str,
    items: DataFrame,
    item_key: str,
    weight: str,
    seed: int | str = 42,
    cells: int | None = None,
    digits: int = 3,
) -> DataFrame:
    """For every row of ``draws`` one item, with replacement, in proportion to ``weight``.

    A draw is a point on the line of running totals.  The line is cut into equal cells, as many
    as items unless told, and the join is on the cell: points are uniform, so cells are equally full, an item
    with a large weight is copied to the many cells it spans, so it is spread as well, and a cell meets two
    items on average.  Weights count to 18 digits after the point; they are computed once and settled.
    """
    positive = settle(items.where(F.col(weight) > 0).select(item_key, F.col(weight).cast("decimal(38,18)").alias("_w")))
    spans = prefix_sums(positive, item_key, "_w", digits)
    whole, count = positive.agg(F.sum("_w").cast("double"), F.count(F.lit(1))).first()
    total, cells = F.lit(whole), cells or max(1, count)
    edges = spans.select(item_key, F.col("low").cast("double").alias("_low"), F.col("high").cast("double").alias("_high"))

    def cell(point: Column) -> Column:
        return F.least(F.floor(point / total * cells), F.lit(cells - 1)).cast("long")

    per_cell = edges.withColumn("_cell", F.explode(F.sequence(cell(F.col("_low")), cell(F.col("_high")))))
    points = draws.withColumn("_point", seeded.uniform(F.col(draw_key), seed) * total)
    return (
        points.withColumn("_cell", cell(F.col("_point")))
        .join(per_cell, "_cell")
        .where((F.col("_point") >= F.col("_low")) & (F.col("_point") < F.col("_high")))
        .drop("_cell", "_point", "_low", "_high")
    )


def weight_tree(items: DataFrame, key: str, weight: str, leaf_items: int = LEAF_ITEMS) -> tuple[DataFrame, DataFrame, int, int]:
    """Items and leaves on a line of whole weights: (items, leaves, total, number of leaves).

    Items fall into leaves of about ``leaf_items`` by a hash of their unique key, as many leaves as that takes.  Sums run
    inside a leaf; leaves' totals inside a block of ``BLOCK_LEAVES``; and only the blocks' totals in one place.
    Items have ``_leaf``, ``_from`` and ``_to`` in their leaf; leaves ``_low`` and ``_high`` on the line and ``_step``, their mean weight.
    """
    positive = settle(items.where(F.col(weight) > 0).select(key, F.col(weight).cast("long").alias("_w")).where("_w > 0"))
    n, total = positive.agg(F.count(F.lit(1)), F.sum(F.col("_w").cast("decimal(38,0)"))).first()
    total = int(total or 0)
    if total >= 10**18:
        raise ValueError("whole weights must add up to less than 10**18; scale them down")
    leaves = max(1, -(-n // leaf_items))
    placed = positive.withColumn("_leaf", F.pmod(seeded.draw32(F.col(key), "order"), F.lit(leaves)))
    inside = Window.partitionBy("_leaf").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    spans = placed.withColumn("_to", F.sum("_w").over(inside)).select(key, "_leaf", (F.col("_to") - F.col("_w")).alias("_from"), "_to")
    sums = settle(placed.groupBy("_leaf").agg(F.sum("_w").alias("_sum"), F.count(F.lit(1)).alias("_n")).withColumn("_block", F.expr(f"_leaf div {BLOCK_LEAVES}")))
    every = sums.groupBy("_block").agg(F.sum("_sum").alias("_all")).agg(F.collect_list(F.struct("_block", "_all")).alias("every"))
    base = lambda x: F.aggregate(F.filter("every", lambda y: y["_block"] < x["_block"]), F.lit(0).cast("long"), lambda total, y: total + y["_all"])
    blocks = every.select(F.explode(F.transform("every", lambda x: F.struct(x["_block"].alias("_block"), base(x).alias("_base")))).alias("b")).select("b.*")
    in_block = Window.partitionBy("_block").orderBy("_leaf").rowsBetween(Window.unboundedPreceding, 0)
    high = F.col("_base") + F.sum("_sum").over(in_block)
    tree = sums.join(blocks, "_block").select("_leaf", (high - F.col("_sum")).alias("_low"), high.alias("_high"), F.expr("(_sum + _n - 1) div _n").alias("_step"))
    return spans, tree, total, leaves


def whole_draws(draws: DataFrame, draw_key: str, items: DataFrame, item_key: str, weight: str, seed: int | str = 42, leaf_items: int = LEAF_ITEMS) -> DataFrame:
    """For every row of ``draws`` one item, with replacement, in proportion to whole weights (fractions are cut off).

    A draw is a whole number below the total, from 64 bits, and goes down the tree by equi-joins: to its leaf by the leaves'
    totals, then to its item by the leaf's.  On either level the line is cut into as many equal cells as there
    are leaves or items; a heavy one is copied to each cell it spans, so it is spread, and draws meet about two
    candidates.  All sums are whole, so items tile the line exactly and every one can be drawn.
    """
    spans, tree, total, leaves = weight_tree(items, item_key, weight, leaf_items)
    if not total:
        return draws.where(F.lit(False)).withColumn(item_key, F.lit(None).cast(items.schema[item_key].dataType))
    width = -(-total // leaves)
    wide = tree.withColumn("_cell", F.expr(f"explode(sequence(_low div {width}, (_high - 1) div {width}))"))
    points = draws.withColumn("_point", seeded.below(F.col(draw_key), total, seed)).withColumn("_cell", F.expr(f"_point div {width}"))
    on_leaf = points.join(wide, "_cell").where((F.col("_point") >= F.col("_low")) & (F.col("_point") < F.col("_high")))
    on_leaf = on_leaf.select(*draws.columns, "_leaf", F.expr("_point - _low").alias("_rest"), F.expr("(_point - _low) div _step").alias("_cell"))
    cells = spans.join(tree.select("_leaf", "_step"), "_leaf").withColumn("_cell", F.expr("explode(sequence(_from div _step, (_to - 1) div _step))")).drop("_step")
    found = on_leaf.join(cells, ["_leaf", "_cell"]).where((F.col("_rest") >= F.col("_from")) & (F.col("_rest") < F.col("_to")))
    return found.select(*draws.columns, item_key)


def choice_table(options: DataFrame, group: str, option: str, weight: str, position: str) -> DataFrame:
    """Option weights of each group as [low, high) shares of 1, in the order of ``position``."""
    so_far = Window.partitionBy(group).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(group)
    w = F.col(weight).cast("double")
    return options.select(
        group,
        option,
        ((F.sum(w).over(so_far) - w) / F.sum(w).over(whole)).alias("low"),
        (F.sum(w).over(so_far) / F.sum(w).over(whole)).alias("high"),
    )


def categorical_assign(
    rows: DataFrame, key: str, choices: DataFrame, group: str, option: str, seed: int | str = 42, default: str | None = None
) -> DataFrame:
    """One option per row, drawn by the weights of the row's group.

    ``choices`` comes from ``choice_table``; rows of a group without choices use the group ``default``.
    """
    entry = F.struct("low", "high", option)
    per_group = choices.groupBy(group).agg(F.sort_array(F.collect_list(entry)).alias("_options"))
    fallback = per_group.where(F.col(group) == F.lit(default)).select("_options").scalar()
    options = F.col("_options")
    u = F.col("_u")
    hit = F.filter(options, lambda o: (u >= o["low"]) & (u < o["high"]))
    chosen = F.coalesce(F.get(hit, F.lit(0)), F.try_element_at(options, F.lit(-1)))  # rounding of the last edge
    return (
        join_keyed(rows, per_group, group, "left", spread_by=[key])
        .withColumns({"_options": F.coalesce("_options", fallback), "_u": seeded.uniform(F.col(key), seed)})
        .withColumn(option, chosen[option])
        .drop("_options", "_u")
    )
