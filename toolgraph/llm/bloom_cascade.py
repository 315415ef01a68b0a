"""URL filters with Bloom filter cascades.

Rules are (host, path prefix, verdict). A url's keys are every suffix of its host at a dot followed by each prefix of its path that is as long as some rule's
path; a rule fits exactly if its key is among them. The distinct keys of all urls are the universe. For each verdict a cascade encodes the
listed keys: level 1 holds the listed keys, level 2 the universe's keys that level 1 admits wrongly, level 3 the listed keys that level 2 admits, and so on until a
level admits nothing wrongly. A key's membership is then the parity of the first level that rejects it: exact over the universe, without a join.

Level 1's false-positive rate follows the list's and universe's sizes, so that level 2 holds about as many keys as the list and every
later level half as many: the broadcast filters take a few bytes for each listed key and grow with the logarithm of the universe. The universe itself is never
shuffled: what passes some level 1 is kept as it is read, and only that is made distinct and freed of the listed keys. Filters hold 64-bit hashes of keys; if a key of the universe has the hash of a listed one,
or two listed ones have one, hashes are made anew with another seed, so membership is exact.

Filters of up to ``MAX_BYTES`` are broadcast at once. Lists that need more are split by their hashes into as many ranges as it takes, each with cascades of its own: the urls are read once for each, and what a range finds is written and
compared with what the next one does.

Edge cases: a null url, or one without ``://``, has an empty host and path, no keys, and the default verdict; repeated urls and ids are kept as
rows; an empty table gives an empty one; of fitting rules the longest text wins, then the longest host; a rule listed with several verdicts has the greatest of them
(so block wins over allow); rules with a null are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, materialise

#: Bytes of all level 1 filters that are broadcast at most.
MAX_BYTES = 64 << 20
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    return F.coalesce(ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def keys_of(host: Column, path: Column, lengths: list[int]) -> Column:
    """All candidate rule texts: host suffixes joined with path prefixes of the given lengths."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    prefixes = F.filter(F.array(*(F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths)), lambda x: x.isNotNull())
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(keys))


class Level:
    """One Bloom filter; bits and probes come from the number of keys and the wanted rate."""

    def __init__(self, n: int, rate: float, salt: int):
        self.salt = salt
        self.m = max(64, math.ceil(n * 1.4427 * math.log2(1 / rate)))
        self.k = max(1, round(math.log2(1 / rate)))
        self.bits = np.zeros((self.m + 63) // 64 * 8, np.uint8)

    def places(self, h: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            a = (h ^ np.uint64(self.salt * 0x9E3779B97F4A7C15 & (2**64 - 1))) * np.uint64(0xD6E8FEB86659FD93)
            a ^= a >> np.uint64(32)
            b = (a * np.uint64(0xFF51AFD7ED558CCD)) | np.uint64(1)
            return ((a[:, None] + np.arange(self.k, dtype=np.uint64) * b[:, None]) >> np.uint64(8)) % np.uint64(self.m)

    def set(self, places: np.ndarray) -> None:
        np.bitwise_or.at(self.bits, places >> np.uint64(3), (1 << (places & np.uint64(7))).astype(np.uint8))

    def has(self, h: np.ndarray) -> np.ndarray:
        p = self.places(h)
        return ((self.bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def members(levels: list[Level], h: np.ndarray) -> np.ndarray:
    """Exact for keys of the universe: a key rejected first at an even level (counted from 1) is listed, or one that none rejects if their number is odd."""
    out = np.full(len(h), len(levels) % 2 == 1)
    open_ = np.ones(len(h), bool)
    for i, level in enumerate(levels):
        left = np.flatnonzero(open_)
        no = left[~level.has(h[left])]
        out[no] = i % 2 == 1
        open_[no] = False
    return out


def build(level: Level, keys: DataFrame) -> Level:
    """Sets the bits of all keys (a column h). A task has one filter for all its keys and sends the 64-bit words that it set, combined by bitwise or before and after the shuffle."""

    def part(batches):
        own = Level.__new__(Level)
        own.__dict__.update(level.__dict__, bits=np.zeros_like(level.bits))
        for batch in batches:
            own.set(own.places(batch.column("h").to_numpy().view(np.uint64)).ravel())
        words = own.bits.view(np.int64)
        at = np.flatnonzero(words)
        for i in range(0, len(at), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[i : i + 100_000]), pa.array(words[at[i : i + 100_000]])], ["at", "word"])

    got = keys.mapInArrow(part, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    level.bits.view(np.int64)[got.column("at").to_numpy()] = got.column("word").to_numpy()
    return level


def first_level(n: int, m: int) -> Level:
    """Level 1 for n listed keys in a universe of about m, still empty."""
    return Level(n, min(0.5, math.sqrt(0.5) * n / max(1, m)), 1)


def passed(levels: list[Level], h: Column) -> Column:
    """Whether any of the levels has the key."""
    return F.pandas_udf(lambda x: pd.Series(np.logical_or.reduce([level.has(x.to_numpy().view(np.uint64)) for level in levels])), "boolean")(h)


def cascade(listed: DataFrame, wrong: DataFrame, first: Level) -> list[Level]:
    """All levels. listed: the distinct listed keys (h); wrong: distinct keys of the universe, all those that ``first`` (built) admits wrongly among them. Stops when nothing is admitted wrongly."""
    levels = [first]
    inside, outside = listed, materialise(wrong.where(passed([first], F.col("h"))).join(listed, "h", "left_anti"), "wrong")
    while held := outside.count():
        levels.append(build(Level(held, 0.5, len(levels) + 1), outside))
        inside, outside = outside, materialise(inside.where(passed(levels[-1:], F.col("h"))), "wrong")
    return levels


def cascades(listed: DataFrame, keys: DataFrame, about: float) -> dict[str, list[Level]] | None:
    """The levels for each verdict; None if hashes clash. listed: (key, verdict, h); keys: (key, h) of the universe, about so many."""
    counts = {r["verdict"]: (r["keys"], r["hashes"]) for r in listed.groupBy("verdict").agg(F.count("*").alias("keys"), F.countDistinct("h").alias("hashes")).collect()}  # a row for each verdict
    lists = {v: listed.where(F.col("verdict") == v).select("h") for v in sorted(counts)}
    if listed.count() > listed.select("h").distinct().count():
        return None
    firsts = {v: build(first_level(counts[v][0], about), lists[v]) for v in lists}
    if not firsts:
        return {}
    wrong = materialise(keys.where(passed(list(firsts.values()), F.col("h"))).distinct(), "keys")
    if wrong.join(listed.select("h", F.col("key").alias("other")), "h").where("key <> other").limit(1).count():
        return None
    hashes = wrong.select("h").distinct()
    return {v: cascade(lists[v], hashes, first) for v, first in firsts.items()}


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", max_bytes: int = MAX_BYTES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url); rules: (host, path, verdict).

    A url that no rule fits gets ``default``, the verdict of keys that no cascade lists.
    """
    spark = pages.sparkSession
    listed = rules.where("host is not null and path is not null and verdict is not null").groupBy(F.concat(ascii_lower(F.col("host")), "path").alias("key")).agg(F.max("verdict").alias("verdict"), F.collect_set(F.length("path")).alias("lengths"))
    listed = materialise(listed, "rules")
    # one number for each length that a rule's path has, one row for each verdict
    lengths = sorted(r[0] for r in listed.select(F.explode("lengths")).distinct().collect())
    counts = [r["count"] for r in listed.groupBy("verdict").count().collect()]
    with_keys = lambda df: df.withColumn("keys", keys_of(F.col("host"), F.col("path"), lengths) if lengths else F.array().cast("array<string>"))
    rows = pages.select("page_id", "url").select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.lit(None).cast("struct<n:int,host:int,rule:string,verdict:string>").alias("best"))
    keys = with_keys(rows).select(F.explode("keys").alias("key"))
    about = keys.agg(F.approx_count_distinct("key")).first()[0]
    ranges = max(1, -(-sum(len(first_level(n, about).bits) for n in counts) // max(1, max_bytes)))
    seed, turn = 0, 0
    while turn < ranges:
        h = lambda k, seed=seed: F.xxhash64(F.lit(seed), k)
        here = lambda k, h=h, turn=turn: F.pmod(h(k), F.lit(ranges)) == turn
        mine = lambda df, h=h, here=here: (df.where(here(F.col("key"))) if ranges > 1 else df).withColumn("h", h(F.col("key")))
        made = cascades(mine(listed.select("key", "verdict")), mine(keys), about / ranges)
        if made is None:  # what has been found so far stays: with another seed all ranges are looked at again
            seed, turn = seed + 1, 0
            continue
        rows = _judged(with_keys(rows), spark.sparkContext.broadcast(made), h, here if ranges > 1 else None)
        if ranges > 1:
            rows = materialise(rows, "judged")
        turn += 1
    return rows.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def _judged(rows: DataFrame, filters, h, here) -> DataFrame:
    """The rows (page_id, host, path, best, keys) with the best rule so far, without their keys."""

    @F.pandas_udf("array<string>")
    def verdicts(hashes: pd.Series) -> pd.Series:
        flat = np.concatenate([np.asarray(x, np.int64) for x in hashes] or [np.zeros(0, np.int64)]).view(np.uint64)
        known = np.full(len(flat), None, object)
        for verdict, levels in filters.value.items():
            if len(flat):
                known[members(levels, flat)] = verdict
        ends = np.cumsum([len(x) for x in hashes])
        return pd.Series(np.split(known, ends[:-1]) if len(hashes) else [])

    if here is not None:
        rows = rows.withColumn("keys", F.filter("keys", lambda k: here(k)))
    marked = rows.withColumn("verdicts", verdicts(F.transform("keys", lambda k: h(k))))
    fits = F.filter(F.arrays_zip("keys", "verdicts"), lambda x: x["verdicts"].isNotNull())
    return marked.select("page_id", "host", "path", F.greatest("best", F.array_max(F.transform(fits, lambda x: _rank(x["keys"], x["verdicts"])))).alias("best"))


def _rank(rule: Column, verdict: Column) -> Column:
    return F.struct(F.length(rule).alias("n"), F.instr(rule, "/").alias("host"), rule.alias("rule"), verdict.alias("verdict"))


def rules_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, "host string, path string, verdict string")
