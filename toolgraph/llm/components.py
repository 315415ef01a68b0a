"""Connected components of an edge table: by alternating large-star and small-star steps (each a group-by and a join), or in one task if the edges are few."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Up to so many edges (16 bytes each), one task joins them.
FEW_EDGES = 200_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: a node's greater neighbours move to its least one. Small star: its lesser neighbours and itself do."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.join(least, "u")
    if large:
        return moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _joined(batches):
    """(node, component) of all edges (u, v) that the task reads, by union-find with the lesser node as root."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["node", "component"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node that has an edge to another; component is the least node reachable. Empty edges: no rows."""
    edges = materialise(edges.select("u", "v").where("u <> v").distinct(), "edges")
    if edges.count() <= FEW_EDGES:
        return materialise(edges.coalesce(1).mapInArrow(_joined, "node long, component long"), "components")
    before = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while before[0]:
        edges = materialise(_star(_star(edges, True), False), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    # a star forest now: every node points at its component's least node
    return materialise(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct(), "components")


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """The labels (node, component) after more edges (u, v): only the components that edges join are worked on. Nodes without a label are their own component."""
    a = labels.select(F.col("node").alias("u"), F.col("component").alias("cu"))
    b = labels.select(F.col("node").alias("v"), F.col("component").alias("cv"))
    joined = edges.join(a, "u", "left").join(b, "v", "left").select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
    moved = components(joined).select(F.col("node").alias("old"), F.col("component").alias("new"))
    known = labels.unionAll(moved.join(labels, F.col("old") == F.col("node"), "left_anti").select(F.col("old").alias("node"), F.col("old").alias("component")))
    return materialise(known.join(moved, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component")), "labels")
