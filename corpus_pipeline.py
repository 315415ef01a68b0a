"""The corpus pipeline: language ID, quality, near-duplicates, decontamination, mixing. Each stage is written as Parquet and read again by the next.

Every stage takes tables with any further columns, of any name, and passes them on (the last returns its own); an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolgraph.llm import compression_quality, decontaminate, langid, minhash_dedup, mixing
from toolgraph.llm.common import crc_mod, read, remove, remove_at_exit, scratch, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters (null and empty ones too) and texts in which no language has half of the mixture.

    Learns from rows with a language only; null ids count as the empty text for the split; repeated rows are judged each.
    """
    return langid.confident(docs, crc_mod(F.col("doc_id"), 4) == 2)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that compress better by the dictionary of bad text.

    Null and empty texts have difference 0, so the calibration alone decides on them; rows without a label, or a null id, are judged but not learnt from; without labels nothing is dropped; repeated rows are judged each.
    """
    return compression_quality.good(docs, read(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 3) == 1)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near-duplicates.

    Texts without words are groups of their own each; rows of one id and text are one document, those of one id with other texts are told apart; null ids come last in a group.
    """
    return minhash_dedup.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more lies in benchmark windows.

    Null texts have no words and stay, as does everything if the benchmark is empty; repeated rows and ids are judged each by their text.
    """
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents to target weights: doc_id, its leaf, n_tokens and copies.

    Null languages and sources are those named by the empty text; null and empty texts have no tokens and get no copies but at the start of a leaf's prefix; repeated rows count each; ties in the seeded order go by id, then tokens.
    """
    return mixing.mix(docs, mixing.WEIGHTS)


STAGES = [("language_id", language_id), ("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixture)]

#: Language ID, compression and MinHash have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Once a stage's result is written, the folders that it worked in go, and so does its predecessor's result; the last one goes when the driver's Python ends."""
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark):
            docs, path = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        if last:
            remove(spark, last)
        last = path
    remove_at_exit(spark, last)
    return docs
