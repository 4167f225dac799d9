"""Connected components of a graph given by its edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.storage import settle_table

ROUNDS = 100
CHUNK_EDGES = 1 << 18  # edges that a task joins at a time


class Forest:
    """Union by smaller index over the rows of a batch."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            above = self.up[self.up]
            if (above == self.up).all():
                return above
            self.up = above

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            roots = self.roots()
            ra, rb = roots[a], roots[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))


def shortened(edges: DataFrame) -> DataFrame:
    """Edges of the same components, as stars of chunks of edges, so that few rounds are left."""
    def star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        src, dst = (table.column(c).to_numpy() for c in ("src", "dst"))
        nodes, place = np.unique(np.concatenate([src, dst]), return_inverse=True)
        forest = Forest(len(nodes))
        forest.join(place[: len(src)], place[len(src) :])
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[forest.roots()])], ["src", "dst"])

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= CHUNK_EDGES:
                yield star(held)
                held, rows = [], 0
        if rows:
            yield star(held)

    return edges.select("src", "dst").repartition("src").mapInArrow(stars, "src long, dst long")


def connected_components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) for the nodes of ``edges`` (src, dst long).

    Chunks of edges are first joined within tasks.  Then each round gives a node the least label around it and then that label's own label, so paths shrink by halves;
    rounds are written tables, and the last is the one that changes nothing.
    """
    edges = shortened(edges)
    both = settle_table(edges.select(F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))).alias("edge")).select("edge.*").distinct(), "edges")
    labels = settle_table(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.min("src")).alias("label")), "labels")
    for _ in range(ROUNDS):
        around = both.join(labels.select(F.col("node").alias("dst"), "label"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("label").alias("near"))
        nearer = labels.join(around, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = nearer.join(jump, "label").select("node", "old", F.least("label", "next").alias("label"))
        labels = settle_table(moved, "labels")
        if labels.where("old <> label").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
        labels = labels.select("node", "label")
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
