"""Connected components of a graph whose edges are rows: union-find inside tasks, stars between them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.operators.sizing import attach, measure
from gridcast.params import LIMITS, Limits
from gridcast.store import land


class UnionFind:
    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while self.up.get(root, root) != root:
            root = self.up[root]
        while self.up.get(x, x) != root:
            self.up[x], x = root, self.up[x]
        return root

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            # The smaller number leads.
            self.up[max(a, b)] = min(a, b)


# Edges that a task joins before it passes on what it has.
BATCH_EDGES = 1_000_000


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, held = UnionFind(), 0

    def stars() -> pa.RecordBatch:
        nodes = np.array(list(found.up), np.int64)
        roots = np.array([found.find(x) for x in nodes.tolist()], np.int64)
        own = nodes != roots
        return pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(roots[own])], ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found.union(a, b)
        held += batch.num_rows
        if held >= BATCH_EDGES:
            yield stars()
            found, held = UnionFind(), 0
    yield stars()


def components(
    edges: DataFrame, limits: Limits = LIMITS, n_edges: int | None = None, task_edges: int = BATCH_EDGES
) -> DataFrame:
    """(node, root) of every node with an edge but the roots; the root is the least number of its component.

    ``edges`` has the columns a and b; ``n_edges`` is their number where it is known. Each round
    contracts the edges of a task by union-find and then links neighbours to the least of them;
    the number of rounds grows with the logarithm of the longest path that is left. Once at most
    ``task_edges`` are left, one task finishes.
    """
    def finish(e: DataFrame) -> DataFrame:
        last = land(e.select("a", "b").coalesce(1).mapInArrow(_contract, "a long, b long"), "stars")
        return last.select(F.col("a").alias("node"), F.col("b").alias("root"))

    if n_edges is not None and n_edges <= task_edges:
        return finish(edges)

    def least_links(e: DataFrame, both: bool) -> DataFrame:
        """Link the (larger) neighbours of each node, and itself, to its least neighbour."""
        way = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if both:
            way = way.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = way.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"), F.count(F.lit(1)).alias("_n"))
        met = attach(way, low, ["u"], "inner", limits, rows="_n")
        if both:
            out = met.filter("v > u").select(F.col("v").alias("a"), F.col("low").alias("b"))
        else:
            out = met.select(F.col("v").alias("a"), F.col("low").alias("b")).unionByName(
                met.select(F.col("u").alias("a"), F.col("low").alias("b"))
            )
        return out.filter("a <> b").distinct()

    def summary(kept) -> tuple:
        row = kept.df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        return tuple(row)

    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    now = measure(pairs.mapInArrow(_contract, "a long, b long").distinct(), "edges")
    before = summary(now)
    while now.rows:
        if now.rows <= task_edges:
            return finish(now.df)
        large = land(least_links(now.df, both=True), "large-star")
        now = measure(least_links(large, both=False), "small-star")
        after = summary(now)
        if after == before:
            break
        before = after
    return now.df.select(F.col("a").alias("node"), F.col("b").alias("root"))
