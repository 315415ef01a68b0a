"""Connected components of a graph given as edges, in a number of rounds that grows with the logarithm of the longest path."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import remove, stored

#: Edges that a task joins at once.
HELD = 200_000


def _hung(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What HELD edges (u, v) join, as edges from each node to the least one; the lesser node is the root."""
    root: dict[int, int] = {}
    n = 0

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    def found() -> pa.RecordBatch:
        pairs = [(x, r) for x in root if (r := find(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["u", "v"])

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
        n += len(batch)
        if n >= HELD:
            yield found()
            root.clear()
            n = 0
    yield found()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Hangs the neighbours of each node below the least of them: those greater than the node, or those less than it and the node itself."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    seen = both if larger else both.where("v < u")
    least = seen.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    hung = seen.join(least, "u")
    if larger:
        return hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, component) of the nodes (long) of edges (u, v); a component's name is its least node.

    First tasks join the edges of nodes that lie close together, by ranges of their numbers; rounds then only take the nodes that several tasks saw, and the least ones. Numbers that say nothing of who is linked leave the rounds all edges.
    Null ends and loops are no edges; an empty table gives an empty one.
    """
    ends = edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    hung = stored(ends.repartitionByRange("u").sortWithinPartitions("u").mapInArrow(_hung, "u long, v long"), f"{folder}/hung")
    first = stored(hung.groupBy("u").agg(F.min("v").alias("root"), F.max("v").alias("other")), f"{folder}/first")
    roots = stored(hung.select("v").distinct(), f"{folder}/roots")
    seen = first.select(F.col("u").alias("x"), "root")
    several = hung.join(first.where("root <> other").select("u", "root"), "u").where("v <> root").select(F.col("v").alias("u"), F.col("root").alias("v"))
    moved = stored(_rounds(several.unionByName(roots.join(seen, F.col("v") == F.col("x")).select(F.col("x").alias("u"), F.col("root").alias("v"))), folder), f"{folder}/moved")
    every = first.select(F.col("u").alias("own"), "root").unionByName(roots.join(seen, F.col("v") == F.col("x"), "left_anti").select(F.col("v").alias("own"), F.col("v").alias("root")))
    return every.join(moved, F.col("root") == F.col("node"), "left").select(F.col("own").alias("node"), F.coalesce("component", "root").alias("component"))


def _rounds(edges: DataFrame, folder: str) -> DataFrame:
    """components by rounds alone, whatever the nodes are. What a round leaves is written below ``folder``, the rounds before it go.

    Rounds alternate hanging greater and lesser neighbours below the least one, which keeps components whole and ends in stars. No neighbours are gathered: a node that very many edges meet
    is summed on both sides of a shuffle and joined back.
    """
    spark = edges.sparkSession
    edges = edges.where("u is not null and v is not null and u <> v").distinct()
    turn, before = 0, None
    while True:
        turn += 1
        edges = stored(_star(_star(edges, True).distinct(), False).distinct(), f"{folder}/stars-{turn}")
        if turn > 1:
            remove(spark, f"{folder}/stars-{turn - 1}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
