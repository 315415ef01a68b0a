"""Embedding whitening: the first principal components by block Lanczos that never forms the covariance, and vectors projected on them at unit variance.

A component c of a vector becomes the integer x = floor(256 * c). The fit list is each distinct x vector once, written to the shared folder; its size n and the sums S are exact integers. One pass over it
takes a block of directions Q (dims * block numbers, broadcast) to V Q = 1/n sum of d (d' Q) with d = (n * x - S) / n, centred before multiplying; tasks hand on dims * block sums each, which groupBy merges by place. A block Krylov basis grows by these passes, each
new block reorthogonalised twice against all of it. Directions that the basis already spans (a breakdown) are started anew from seeded random ones; a basis of ``basis`` columns is restarted from its best Ritz vectors. It ends when
the residuals |V u - e u| of the wanted pairs, measured with the products in hand, are down to ``tolerance`` of the largest eigenvalue, haven't halved in the last ``RESTARTS`` restarts, or the basis spans everything. The trace comes from the exact deviations, so
explained shares need no other eigenvalue.

The driver holds dims * basis numbers, a bound set by the parameters. Dropping repeats shuffles each distinct vector once a task at most, so a vector that many rows share stays small; nothing else shuffles but sums.

Edge cases: null vectors, other lengths than ``dims``, null and non-finite entries: left out. Repeated rows count once in the fit and come out each. Components without variance (fewer distinct vectors than components, or
vectors in a smaller space) don't exist: rows come for the others only, none at all if all vectors are equal or the table is empty. Equal eigenvalues: any basis of their space. Entries are longs: beyond 2^53 / 256 a double has no
smaller digits, and beyond 2^62 it is an error. Deviations are exact at any n (decimal). Other columns, of any name, are ignored.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .centroids import UNIT, finite
from .common import lean, materialise

DIMS, COMPONENTS, BLOCK, BASIS, TOLERANCE, SEED, RESTARTS = 64, 4, 8, 128, 1e-14, 13, 3
HALF = 10**18  # the trace is summed in two parts
RANK = 1e-12  # an eigenvalue below this part of the largest is none


def entries(column: pa.Array, dims: int) -> np.ndarray:
    """A column of vectors, or of integers taken before, as an integer matrix."""
    flat = column.flatten()
    if pa.types.is_floating(flat.type):
        x = np.floor(flat.to_numpy(zero_copy_only=False).astype(np.float64) * UNIT)
        if x.size and np.abs(x).max() >= 2.0**62:
            raise ValueError("a vector has entries that don't fit a long")
        flat = x.astype(np.int64)
    else:
        flat = flat.to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dims)


def _wide(x: np.ndarray, factor: int, shift: int) -> bool:
    """Whether factor * x + shift, squared and summed over the row, might leave 63 bits."""
    most = int(np.abs(x).max()) if x.size else 0
    return (factor * most + shift) ** 2 * max(1, x.shape[1]) >= 2**63


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly."""
    if _wide(x, n, max(map(abs, sums), default=0)):
        return x.astype(object) * n - np.array(sums, object)
    return x * n - np.array(sums, np.int64)


def _decimals(x: np.ndarray) -> pa.Array:
    kind = pa.decimal128(38, 0)
    return pa.array([Decimal(int(v)) for v in x], kind) if x.dtype == object else pa.array(x, pa.int64()).cast(kind)


@lean
def sum_rows(batches, dims):
    """One row: the number of vectors and the sums of their entries."""
    n, total = 0, np.zeros(dims, object)
    for batch in batches:
        x = entries(batch.column("x"), dims)
        n += len(x)
        total = total + (x.astype(object) if x.size and int(np.abs(x).max()) * len(x) >= 2**62 else x).sum(axis=0)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([[Decimal(int(v)) for v in total]], pa.list_(pa.decimal128(38, 0)))], ["n", "total"])


SUMS = "place int, value double, high decimal(38,0), low decimal(38,0)"


def _sums(values: np.ndarray, trace: int = 0) -> pa.RecordBatch:
    """A task's sums as rows (place, value), and at place -1 its part of the trace."""
    kind = pa.decimal128(38, 0)
    high, low = ([None] * len(values) + [Decimal(v)] for v in divmod(trace, HALF))
    return pa.RecordBatch.from_arrays([pa.array([*range(len(values)), -1], pa.int32()), pa.array([*values.tolist(), None], pa.float64()), pa.array(high, kind), pa.array(low, kind)], ["place", "value", "high", "low"])


def summed(parts: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """The sums of all tasks, merged by Spark: size + 1 rows come back."""
    out, trace = np.zeros(size), 0
    for r in parts.groupBy("place").agg(F.sum("value").alias("value"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect():
        if r["place"] < 0:
            trace = int(r["high"]) * HALF + int(r["low"])
        else:
            out[r["place"]] = r["value"]
    return out, trace


@lean
def product_rows(batches, sent):
    """The sums of d (d' Q), and of the squared deviations."""
    q, n, sums = sent.value
    out, trace, some = np.zeros(q.shape), 0, False
    for batch in batches:
        d = deviations(entries(batch.column("x"), len(q)), n, sums)
        trace += int((d * d).sum(axis=1).astype(object).sum())
        d = d.astype(np.float64) / n
        out += d.T @ (d @ q)
        some = True
    if some:
        yield _sums(out.ravel(), trace)


@lean
def whitened_rows(batches, sent):
    """vec_id, component, deviation and whitened of each row."""
    axes, n, sums = sent.value
    k = axes.shape[1]
    for batch in batches:
        d = deviations(entries(batch.column("embedding"), len(axes)), n, sums)
        white = (d.astype(np.float64) / n) @ axes
        names, m = ["vec_id", "component", "deviation", "whitened"], len(d)
        which = pa.array(np.repeat(np.arange(m), k))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(which), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), _decimals((d * d).sum(axis=1)).take(which), pa.array(white.ravel())], names)


@lean
def square_rows(batches, sent):
    """The sums of the whitened fit list and of its products."""
    axes, n, sums = sent.value
    total, squares = 0, 0
    for batch in batches:
        white = (deviations(entries(batch.column("x"), len(axes)), n, sums).astype(np.float64) / n) @ axes
        total, squares = total + white.sum(axis=0), squares + white.T @ white
    if np.ndim(total):
        yield _sums(np.concatenate([total, squares.ravel()]))


def _orthogonal(w: np.ndarray, basis: np.ndarray, columns: int, scale: float, rng) -> np.ndarray:
    """An orthonormal block beside the basis: of w what is new, and random directions in place of what isn't, up to ``columns``."""
    kept = basis
    for j in range(columns):
        v = w[:, j] if j < w.shape[1] else np.zeros(len(basis))
        for attempt in range(8):
            before = max(np.linalg.norm(v), scale if attempt == 0 else 0.0)
            for _ in range(2):
                v = v - kept @ (kept.T @ v)
            if np.linalg.norm(v) > 1e-10 * before:
                v = v / np.linalg.norm(v)
                v = v - kept @ (kept.T @ v)
                kept = np.column_stack([kept, v / np.linalg.norm(v)])
                break
            v = rng.standard_normal(len(basis))  # breakdown: a new direction
    return kept[:, basis.shape[1] :]


def block_lanczos(multiply, dims: int, wanted: int, block: int = BLOCK, basis: int = BASIS, tolerance: float = TOLERANCE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric positive matrix, their unit vectors and residuals; multiply(Q) gives the matrix times Q."""
    rng = np.random.default_rng(seed)
    wanted, block = min(wanted, dims), min(block, dims)
    basis = max(basis, wanted + 2 * block)
    q = _orthogonal(rng.standard_normal((dims, block)), np.zeros((dims, 0)), block, 0.0, rng)
    span, image, best, stuck = q, multiply(q), np.inf, 0
    while True:
        small = span.T @ image
        e, y = np.linalg.eigh((small + small.T) / 2)
        e, y = e[::-1], y[:, ::-1]
        u = span @ y[:, :wanted]
        residual = np.linalg.norm(image @ y[:, :wanted] - u * e[:wanted], axis=0)
        top = max(e[0], 0.0)
        if span.shape[1] >= wanted and (residual <= tolerance * top).all() or span.shape[1] >= dims or stuck >= RESTARTS:
            return e[:wanted], u, residual
        fresh = _orthogonal(image[:, -block:], span, min(block, dims - span.shape[1]), top, rng)
        if span.shape[1] + block > basis:  # restart from the best Ritz vectors
            stuck = stuck + 1 if residual.max() > best / 2 else 0
            best = min(best, residual.max())
            span, image = span @ y[:, : wanted + block], image @ y[:, : wanted + block]
        span, image = np.column_stack([span, fresh]), np.column_stack([image, multiply(fresh)])


def whitened(embeddings: DataFrame, components: int = COMPONENTS, dims: int = DIMS, **options) -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained and identity_error: a row for each sound vector and component."""
    spark = embeddings.sparkSession
    context, rows = spark.sparkContext, finite(embeddings, dims)
    taken = F.transform("embedding", lambda c: F.floor(c.cast("double") * F.lit(float(UNIT))).cast("long"))
    fit = materialise(rows.select(taken.alias("x")).distinct(), "fit")
    head = fit.mapInArrow(lambda it: sum_rows(it, dims), "n long, total array<decimal(38,0)>").agg(F.sum("n"), *[F.sum(F.col("total")[i]) for i in range(dims)]).first()
    n, sums = head[0] or 0, [int(v or 0) for v in head[1:]]
    trace: list[int] = []

    def multiply(q: np.ndarray) -> np.ndarray:
        sent = context.broadcast((q, n, sums))
        out, all_ = summed(fit.mapInArrow(lambda it: product_rows(it, sent), SUMS), q.size)
        trace[:] = [all_]
        sent.destroy()
        return out.reshape(q.shape) / n

    e, u = np.zeros(0), np.zeros((dims, 0))
    if n:
        e, u, _ = block_lanczos(multiply, dims, components, **options)
        real = (e > RANK * e[0]) & (e > 0) if trace[0] else np.zeros(len(e), bool)
        e, u = e[real], u[:, real]
    sent = context.broadcast((u / np.sqrt(e), n, sums))
    k, error = len(e), 0.0
    if k:
        got = summed(fit.mapInArrow(lambda it: square_rows(it, sent), SUMS), k + k * k)[0] / n
        error = float(np.abs(got[k:].reshape(k, k) - np.outer(got[:k], got[:k]) - np.eye(k)).max())
    shares = [float(v) / (trace[0] / n**3) for v in e]
    share = F.element_at(F.array(*map(F.lit, shares)), F.col("component")) if k else F.lit(None).cast("double")
    out = rows.mapInArrow(lambda it: whitened_rows(it, sent), "vec_id long, component int, deviation decimal(38,0), whitened double")
    return out.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(error).alias("identity_error"))
