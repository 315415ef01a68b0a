"""Centroid clustering: plain Lloyd over vectors that are quantised to integers, so every sum is exact and no result depends on how rows are dealt.

A vector counts if it has exactly ``dims`` components, none null or non-finite; a component x becomes floor(256 * x). The first centroids are the ``k`` vectors with the least SHA-256 of
``seed:vec_id``. In a round each task gets the centroids (k * dims integers, broadcast: a bound set by the parameters), takes the integer squared differences centroid by centroid in NumPy, gives a
vector to the nearest (argmin: of equals the lowest index) and adds up its vectors; it hands on one row of integer sums for each centroid, which groupBy merges. The driver gets k rows of sums a
round. Nothing is shuffled but these rows, whatever share of the vectors one centroid has; the vectors themselves are read again in each round.

Edge cases: null vectors, other lengths, null and non-finite components: left out. A null vec_id hashes as the empty text. Vectors of one id are told apart by their components in the first order;
repeated rows count and come out each; equal first centroids are kept, those after the first stay empty. Fewer than k vectors: each is a centroid. An empty table gives an empty one.
Components beyond the size at which distances fit a long (about 700,000 at 64 components) are an error, never a wrong distance. Other columns, of any name, are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, materialise

DIMS, K, ROUNDS, SEED, UNIT = 64, 40, 5, "2", 256
ROWS = 1 << 13  # vectors compared at once


def finite(embeddings: DataFrame, dims: int) -> DataFrame:
    """vec_id and embedding of the rows with exactly ``dims`` components, none null or non-finite."""
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.where("embedding is not null").where(F.size("embedding") == dims).where(F.forall("embedding", sound))


def quantised(column, dims: int) -> np.ndarray:
    """The components of a column of vectors as integers."""
    x = np.floor(np.stack(column.to_numpy()).astype(np.float64) * UNIT) if len(column) else np.zeros((0, dims))
    if x.size and np.abs(x).max() >= 2.0**30 / np.sqrt(dims):
        raise ValueError("a vector has components so large that squared distances don't fit a long")
    return x.astype(np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid's index, the lowest of equals, and the squared distance of each row of x."""
    cluster, distance = np.zeros(len(x), np.int32), np.zeros(len(x), np.int64)
    for at in range(0, len(x), ROWS):
        part = x[at : at + ROWS]
        d = np.empty((len(part), len(centroids)), np.int64)
        for j, c in enumerate(centroids):
            off = part - c
            np.einsum("ij,ij->i", off, off, out=d[:, j])
        cluster[at : at + ROWS] = best = d.argmin(axis=1)
        distance[at : at + ROWS] = d[np.arange(len(part)), best]
    return cluster, distance


@lean
def sum_frames(frames, centroids):
    """One row of integer sums for each centroid that has vectors in this task."""
    c = centroids.value
    n, total = np.zeros(len(c), np.int64), np.zeros(c.shape, np.int64)
    for frame in frames:
        x = quantised(frame["embedding"], c.shape[1])
        cluster, _ = nearest(x, c)
        order = np.argsort(cluster, kind="stable")
        at = np.flatnonzero(np.diff(cluster[order], prepend=-1))
        if len(at):
            total[cluster[order][at]] += np.add.reduceat(x[order], at)
            n += np.bincount(cluster, minlength=len(c))
    some = np.flatnonzero(n)
    yield pd.DataFrame({"cluster": some.astype(np.int32), "n": n[some], "total": list(total[some])})


@lean
def assign_frames(frames, centroids):
    for frame in frames:
        cluster, distance = nearest(quantised(frame["embedding"], centroids.value.shape[1]), centroids.value)
        yield pd.DataFrame({"vec_id": frame["vec_id"], "cluster": cluster, "distance": distance})


def first_centroids(vectors: DataFrame, k: int, dims: int, seed: str) -> np.ndarray:
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(named, "embedding").limit(k).select("embedding").toPandas()
    return quantised(rows["embedding"], dims)


def lloyd(vectors: DataFrame, k: int = K, dims: int = DIMS, rounds: int = ROUNDS, seed: str = SEED) -> np.ndarray:
    """The centroids after the given rounds, fewer than k if there are fewer vectors; vectors: as from finite()."""
    context = vectors.sparkSession.sparkContext
    centroids = first_centroids(vectors, k, dims, seed)
    for _ in range(rounds if len(centroids) else 0):
        sent = context.broadcast(centroids)
        parts = vectors.mapInPandas(lambda it, sent=sent: sum_frames(it, sent), "cluster int, n long, total array<long>")
        exact = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(dims)]
        sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).collect()  # k rows
        centroids = centroids.copy()
        for row in sums:
            centroids[row["cluster"]] = [int(row[f"t{i}"]) // row["n"] for i in range(dims)]
        sent.destroy()
    return centroids


def clustered(embeddings: DataFrame, k: int = K, dims: int = DIMS, rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of each vector that counts."""
    spark, vectors = embeddings.sparkSession, finite(embeddings, dims)
    centroids = lloyd(vectors, k, dims, rounds, seed)
    sent = spark.sparkContext.broadcast(centroids.reshape(-1, dims))
    assigned = materialise(vectors.mapInPandas(lambda it: assign_frames(it, sent), "vec_id long, cluster int, distance long"), "assigned")
    inertia = {r["cluster"]: r["inertia"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}  # k rows
    named = [(j, inertia.get(j, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for j, c in enumerate(centroids)]
    summed = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(summed), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
