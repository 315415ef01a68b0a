"""Quality classifier by compression: two zstandard dictionaries, one from good and one from bad text.

A text is cut into blocks of 2,048 bytes (all of it); each block is compressed with either dictionary. The normalised difference of the
summed sizes, (bad - good) / (bad + good), goes through a logistic curve whose two parameters are fitted on labelled texts that the dictionaries haven't seen.

Learnt from a bounded sample: of each label up to ``SAMPLE`` texts, those with the least hash of their id, in turn one for the dictionary and one to calibrate. A label's texts are dealt in ``GROUPS``, and each group's
dictionary is trained by a task on all blocks of its texts: they wait up to ``WAITING`` bytes, then a dictionary trained on them stands for them among those that follow. The label's dictionary is trained on the blocks of its groups'. So all
text of the sample counts, a task holds ``WAITING`` bytes, and the driver gets ``2 * GROUPS * DICTIONARY`` bytes (8 MB), however long texts are, and a long text weighs no more than its group; the differences to calibrate by are taken on the executors too, over whole texts.

Edge cases: null and empty texts have difference 0; a document with both labels counts as its mean label (0.5 or more: good); of one id's texts
the one with the least hash is learnt from; with a label missing the score is the share of label 1 among the sample (0.5 without any); repeated rows are scored each; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, lean, materialise, rows_where

SAMPLE, GROUPS, WAITING, BLOCK, DICTIONARY, LEVEL = 1500, 64, 1 << 25, 2048, 65536, 1
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, difference double"


def blocks(text: bytes) -> list[bytes]:
    return [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]


def dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little to train on: the text itself serves
        return b"".join(samples)[-DICTIONARY:]


class Trainer:
    """A dictionary of blocks that come one after the other, in bounded memory."""

    def __init__(self, waiting: int = WAITING):
        self.waiting, self.samples, self.bytes = waiting, [], 0

    def add(self, text: bytes) -> None:
        for block in blocks(text):
            self.samples.append(block)
            self.bytes += len(block)
            if self.bytes >= self.waiting:
                self.samples = blocks(dictionary(self.samples))
                self.bytes = sum(map(len, self.samples))

    def result(self) -> bytes:
        return dictionary(self.samples)


@lean
def dictionary_rows(batches):
    """(good, part, dictionary) of rows (good, part, text) sorted by label and group."""
    now, trainer = None, Trainer()
    done = lambda: pa.RecordBatch.from_arrays([pa.array([now[0]], pa.bool_()), pa.array([now[1]], pa.int64()), pa.array([trainer.result()], pa.binary())], ["good", "part", "dictionary"])
    for batch in batches:
        for good, part, text in zip(batch.column("good").to_pylist(), batch.column("part").to_pylist(), batch.column("text").cast(pa.large_binary()), strict=True):
            if (good, part) != now:
                if now:
                    yield done()
                now, trainer = (good, part), Trainer()
            trainer.add(text.as_py())
    if now:
        yield done()


class Sizes:
    """Compressed sizes under the two dictionaries."""

    def __init__(self, bad: bytes, good: bytes):
        self.both = []
        for d in (bad, good):
            data = zstandard.ZstdCompressionDict(d)
            data.precompute_compress(level=LEVEL)
            self.both.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False))

    def difference(self, text: bytes) -> float:
        parts = blocks(text)
        if not parts:
            return 0.0
        bad, good = (sum(len(c.compress(b)) for b in parts) for c in self.both)
        return (bad - good) / (bad + good)


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression by Newton's method, on the scaled difference with a weak prior."""
    scale = float(np.std(x)) or 1.0
    design = np.stack([np.ones_like(x), x / scale], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + 0.01 * w
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + 0.01 * np.eye(2), gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1] / scale)


def learn(docs: DataFrame, labels: DataFrame, held_out) -> dict:
    """The model: dictionaries and calibration, or a constant."""
    spark = docs.sparkSession
    marked = labels.where("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).alias("good"))
    rows = docs.where(~held_out).where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids = rows.select("doc_id").distinct().join(marked, "doc_id").withColumn("order", F.xxhash64("doc_id", F.lit(9)))
    sample = [ids.where(side).orderBy("order", "doc_id").limit(SAMPLE).collect() for side in ("not good", "good")]
    if min(map(len, sample)) < 2:
        known = sum(map(len, sample))
        return {"constant": len(sample[1]) / known if known else 0.5}
    # at most 2 * SAMPLE rows
    turns = spark.createDataFrame([(r["doc_id"], r["good"], i) for side in sample for i, r in enumerate(side)], "doc_id long, good boolean, turn long")
    texts = materialise(rows.join(F.broadcast(turns), "doc_id").groupBy("doc_id", "good", "turn").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")), "quality-sample")
    dealt = texts.where("turn % 2 = 0").withColumn("part", F.floor(F.col("turn") / 2) % GROUPS).repartition("good", "part").sortWithinPartitions("good", "part", "turn").select("good", "part", "text")
    got = dealt.mapInArrow(dictionary_rows, "good boolean, part long, dictionary binary").orderBy("good", "part").toArrow()  # 2 * GROUPS rows
    good, parts = got.column("good").to_pylist(), got.column("dictionary").to_pylist()
    model = {name: dictionary([b for g, p in zip(good, parts, strict=True) if g == side for b in blocks(p)]) for name, side in (("bad", False), ("good", True))}
    sizes = spark.sparkContext.broadcast(model)
    seen = texts.where("turn % 2 = 1").mapInArrow(lambda it: difference_rows(it, sizes), "turn long, good boolean, difference double").orderBy("turn", "good").toArrow()
    model["a"], model["b"] = calibrate(seen.column("difference").to_numpy(), seen.column("good").to_numpy(zero_copy_only=False).astype(float))
    return model


@lean
def difference_rows(batches, model):
    sizes = Sizes(model.value["bad"], model.value["good"])
    for batch in batches:
        x = [sizes.difference(t.as_py()) for t in batch.column("text").cast(pa.large_binary())]
        yield pa.RecordBatch.from_arrays([batch.column("turn"), batch.column("good"), pa.array(x, pa.float64())], ["turn", "good", "difference"])


@lean
def score_rows(batches, model):
    m = model.value
    sizes = Sizes(m["bad"], m["good"]) if "a" in m else None
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        x = np.array([sizes.difference(t or b"") if sizes else 0.0 for t in texts])
        score = 1 / (1 + np.exp(-np.clip(m["a"] + m["b"] * x, -500, 500))) if sizes else np.full(len(x), m["constant"])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(x)], ["doc_id", "held_out", "score", "predicted", "difference"])


def _learnt(docs: DataFrame, labels: DataFrame, held_out):
    return docs.sparkSession.sparkContext.broadcast(learn(docs.select("doc_id", "text"), labels.select("doc_id", "quality"), held_out))


def quality_scores(docs: DataFrame, labels: DataFrame, held_out) -> DataFrame:
    """doc_id, held_out, score (probability of label 1), predicted and the size difference of each row; learns labels where held_out is false."""
    model = _learnt(docs, labels, held_out)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(lambda it: score_rows(it, model), SCHEMA)


def documents_rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return quality_scores(docs, labels, crc_mod(F.col("doc_id"), 3) == 1)


def good(docs: DataFrame, labels: DataFrame, held_out, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score ``least`` or more; each row is judged by its text alone."""
    model = _learnt(docs, labels, held_out)
    return rows_where(docs, lambda it: score_rows(it, model), lambda out: out.column("score").to_numpy() >= least)
