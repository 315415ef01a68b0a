"""Benchmark decontamination: a prefix-filtered join of benchmark windows with documents, in DataFrame operations only.

An item's windows are its runs of 13 words (a shorter item, but not an empty one, is one window). A window occurs where a document has the same words in a
row, so any one of its words must match: its shingles are single words here (all of them have to be in the document, so one is prefix enough), its prefix under the order of rarity is the single rarest word, counted over all documents. The words of documents are
joined with these prefix words; a match fixes where the window would lie, the position and length bounds discard those that stick out, and the rest are
verified word by word against the document's slice. Words are joined in full lower case (a superset of matches) and verified with A-Z lowered only.

The windows, their items included, are broadcast only if they take ``BROADCAST_BYTES`` or less, and so are the counts of their words; beyond, the join is dealt by word and candidates are joined back to their documents.

Edge cases: null texts have no words; an item without words has no window; items with equal windows are all reported, null item ids aren't named; repeated rows
and equal ids are judged each (a text is told apart by its hash); an empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, free, materialise

WINDOW, BROADCAST_BYTES = 13, 16 << 20
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words with their case as it is, found by what parts them (several times faster than by matching them)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def windows_of(benchmark: DataFrame, size: int) -> DataFrame:
    """(window: its words with A-Z lowered, joined by a space; length in words; item ids as sorted texts): distinct windows."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(ascii_lower(F.col("text"))).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(1)))
    runs = items.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, size))).alias("words"))
    return runs.groupBy(F.concat_ws(" ", "words").alias("window"), F.size("words").alias("length")).agg(F.sort_array(F.collect_set("item")).alias("items"))


def prefixes(windows: DataFrame, docs: DataFrame, small: bool) -> DataFrame:
    """(key, lead, window, length, items): the rarest word of each window over all documents, and how many words precede it."""
    vocabulary = windows.select(F.explode(F.split("window", " ")).alias("word")).select(F.lower("word").alias("key")).distinct()
    # outer: the optimizer would otherwise find the words twice, to leave out texts without any
    spoken = docs.select(F.explode_outer(words_of(F.col("text"))).alias("word")).select(F.lower("word").alias("key"))
    counts = spoken.join(F.broadcast(vocabulary) if small else vocabulary, "key", "left_semi").groupBy("key").agg(F.count("*").alias("n"))
    placed = windows.select("*", F.posexplode(F.split("window", " ")).alias("lead", "word")).withColumn("key", F.lower("word"))
    # as many rows as the windows have different words
    ranked = placed.join(F.broadcast(counts) if small else counts, "key", "left").withColumn("rank", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "lead"))
    return ranked.groupBy("window", "length").agg(F.min("rank").alias("rank"), F.first("items").alias("items")).select("rank.key", "rank.lead", "window", "length", "items")


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, text_key, start, length, items): where windows occur, start counted in words from 0."""
    windows = materialise(windows_of(benchmark, size), "windows")
    held = windows.agg(F.sum(F.octet_length("window") * 2 + F.octet_length(F.concat_ws(",", "items")) + F.size("items") * 16 + 64)).first()[0] or 0
    small = held <= broadcast_bytes
    prefix = materialise(prefixes(windows, docs, small), "prefixes")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words_of(F.col("text")).alias("words"))
    spoken = rows.select("doc_id", "text_key", "words", F.posexplode_outer("words").alias("at", "word"))
    start = F.col("at") - F.col("lead")
    inside = (start >= 0) & (start + F.col("length") <= F.size("words"))
    # no higher-order function here: it would end whole-stage code generation, and each word's row would copy its document's words
    same = ascii_lower(F.concat_ws(" ", F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("length")))) == F.col("window")
    if small:
        found = spoken.join(F.broadcast(prefix), F.lower("word") == F.col("key")).where(inside & same)
    else:
        candidates = spoken.select("doc_id", "text_key", "at", "word").join(prefix, F.lower("word") == F.col("key")).where(F.col("at") >= F.col("lead"))
        texts = rows.dropDuplicates(["doc_id", "text_key"]).select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "words")
        found = candidates.join(texts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t"))).where(inside & same)
    return found.select("doc_id", "text_key", start.alias("start"), "length", "items")


def judge(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted texts), contaminated (n_hit > 0 and 20 * n_hit >= n_words) and the row's text_key, for each row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    hits = occurrences(docs, benchmark.select("item_id", "text"), size, broadcast_bytes)
    by = hits.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "length")).alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))))
    by = by.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), F.size(covered).alias("n_hit"), "items")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    out = rows.join(by, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")), "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"), "text_key",
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that aren't contaminated."""
    # the names must differ from every column of docs
    bad_id, bad_key, key = free(docs, "bad_id", "bad_key", "key")
    bad = judge(docs, benchmark).where("contaminated").select(F.col("doc_id").alias(bad_id), F.col("text_key").alias(bad_key)).distinct()
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    return keyed.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col(bad_id)) & (F.col(key) == F.col(bad_key)), "left_anti").drop(key)
