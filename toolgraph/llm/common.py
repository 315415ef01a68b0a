"""Helpers shared by the training-data operators: shared storage, row keys, chunked Arrow access."""

from __future__ import annotations

import atexit
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Unset, a session on one machine (as in tests) gets a temporary one; on a cluster that is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir isn't set: a cluster needs a folder that the driver and all executors share")
        path = getattr(spark.sparkContext, "_toolgraph_dir", None) or tempfile.mkdtemp(prefix="toolgraph-")
        spark.sparkContext._toolgraph_dir = path
    return path.rstrip("/")


#: The folders that the innermost open scratch() is to delete.
_OPEN: ContextVar[list[str] | None] = ContextVar("open", default=None)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Writes df as Parquet to the shared folder and reads it back: cuts lineage, survives lost executors. Also says where it is."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """stored, in a folder that goes with the scratch() around, if any."""
    out, path = stored(df, name)
    if (folders := _OPEN.get()) is not None:
        folders.append(path)
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whichever store its path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """remove, when the driver's Python ends, if the JVM is still there."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def gone() -> None:
        try:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
        except Exception:  # the JVM has gone: the folder stays
            pass

    atexit.register(gone)


@contextmanager
def scratch(spark: SparkSession):
    """What materialise writes inside goes at the end, so a result has to be stored by then."""
    token = _OPEN.set([])
    try:
        yield
    finally:
        folders = _OPEN.get()
        _OPEN.reset(token)
        for path in folders:
            remove(spark, path)


def finished(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What build() gives, stored until the driver's Python ends; the folders that it worked in are gone."""
    with scratch(spark):
        out, path = stored(build(), name)
    remove_at_exit(spark, path)
    return out


def free(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of df has (columns compare without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def rows_where(docs: DataFrame, judge, keep) -> DataFrame:
    """The rows of docs for which keep(judged) holds; judge(batches of doc_id, held_out, text) gives one batch a batch, row by row. Other columns of any name pass through."""

    def rows(batches):
        for batch in batches:
            marked = pa.RecordBatch.from_arrays([pa.nulls(len(batch), pa.int64()), pa.nulls(len(batch), pa.bool_()), batch.column("text")], ["doc_id", "held_out", "text"])
            mask = np.concatenate([np.asarray(keep(out), bool) for out in judge([marked])])
            yield batch.filter(pa.array(mask))

    return docs.mapInArrow(rows, docs.schema)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _trim() -> None:
    """Gives freed memory back to the system: Python workers are kept for later tasks, also while the JVM needs the room."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def lean(rows):
    """A generator function of a task that holds no freed memory when it ends."""

    @wraps(rows)
    def run(*args, **kwargs):
        try:
            yield from rows(*args, **kwargs)
        finally:
            _trim()

    return run


def byte_chunks(column: pa.Array, limit: int = 1 << 20):
    """Slices a string or binary column into runs of rows of about ``limit`` bytes (one row at least).

    Yields (first row, last row + 1, bytes as uint8 array, offsets that start at 0); null texts are empty.
    """
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def padded(data: np.ndarray, offsets: np.ndarray, pad: int, fill: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other, ``pad`` bytes of ``fill`` before each and after the last; and where each text starts."""
    n = len(offsets) - 1
    out = np.full(len(data) + pad * (n + 1), fill, np.uint8)
    starts = offsets[:-1] + pad * np.arange(1, n + 1)
    for a, b, s in zip(offsets[:-1].tolist(), offsets[1:].tolist(), starts.tolist(), strict=True):
        out[s : s + b - a] = data[a:b]
    return out, starts


LOWER_LUT = np.arange(256, dtype=np.uint8)
LOWER_LUT[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_RNG = np.random.default_rng(20240229)
_BYTE_HASH = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(21, (n - 1).bit_length())
    if size > 1 << 22 or size not in _POWERS:
        with np.errstate(over="ignore"):
            both = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, r, np.uint64)]), dtype=np.uint64) for r in (_R, _R_INV))
        if size > 1 << 22:
            return both
        _POWERS[size] = both
    return _POWERS[size]


def mix64(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def span_hashes(buf: np.ndarray):
    """A function that gives the 64-bit hashes of the stretches buf[begin:end]."""
    powers, inverse = _powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_HASH[buf] * powers[: len(buf)], out=sums[1:])
    return lambda begin, end: mix64((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text, A-Z lowered: their 64-bit hashes, and where each text's words start (n + 1)."""
    buf, starts = padded(data, offsets, 1, 32)
    low = LOWER_LUT[buf]
    inside = ~SPACE[low]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begin, end = edge[0::2], edge[1::2]
    h = span_hashes(low)(begin, end)
    first = np.searchsorted(begin, np.append(starts, len(buf)))
    return h, first


class Counts:
    """Sums counts by 64-bit key in bounded memory: raw keys are sorted and folded in once ``limit`` of them wait."""

    def __init__(self, limit: int = 1 << 21):
        self.limit, self.waiting, self.raw = limit, 0, []
        self.keys, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self.raw.append(keys)
            self.waiting += len(keys)
            if self.waiting >= self.limit:
                self._fold()

    def _fold(self) -> None:
        if not self.raw:
            return
        keys = np.sort(np.concatenate(self.raw))
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        n = np.diff(np.append(at, len(keys)))
        keys = np.concatenate([self.keys, keys[at]])
        n = np.concatenate([self.n, n])
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.keys, self.n = keys[at], np.add.reduceat(n, at)
        self.raw, self.waiting = [], 0

    def drain(self) -> tuple[np.ndarray, np.ndarray]:
        self._fold()
        out = self.keys, self.n
        self.keys, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return out


def fold_sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(values, at) if len(at) else values
