"""Catalogue quality: coverage, set intersections, duplicates, gaps, changes, validity, resumable work."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stored, workspace


def coverage(content: DataFrame, sources: list[str]) -> DataFrame:
    """A row for each combination of sources that items are found in: one flag for each source, and the number of items."""
    flags = [F.max(F.col("source") == s).alias(s) for s in sources]
    return content.groupBy("tool_id").agg(*flags).groupBy(*sources).agg(F.count("*").alias("n"))


def intersections(rows: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """UpSet counts: rows for each combination of flags, with their share."""
    counted = rows.select(*(c.alias(k) for k, c in flags.items())).groupBy(*flags).agg(F.count("*").alias("n"))
    # as many rows as there are combinations
    return counted.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 6))


def duplicate_lists(records: DataFrame, item: str, values: str) -> DataFrame:
    """(value, item) of the records whose whole list of values is another record's too: rows, so that no list grows with a value that many share."""
    shared = records.groupBy(values).agg(F.count("*").alias("n")).where("n > 1").select(values)
    return records.join(shared, values, "left_semi").select(F.explode(values).alias("value"), F.col(item).alias("item")).distinct()


def duplicate_values(records: DataFrame, item: str, values: str) -> DataFrame:
    """(value, item) of the values that more than one record holds."""
    held = records.select(F.explode(values).alias("value"), F.col(item).alias("item")).distinct()
    return held.join(held.groupBy("value").agg(F.count("*").alias("n")).where("n > 1").select("value"), "value", "left_semi")


def listed(rows: DataFrame, key: str, item: str, name: str = "items") -> DataFrame:
    """(key, n, sorted list) of rows (key, item): for reports whose lists are known to be short."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.sort_array(F.collect_list(item)).alias(name))


CHUNK = 1000


def chunked(rows: DataFrame, key: str | list[str], item: str, size: int = CHUNK, name: str = "items") -> DataFrame:
    """(key, chunk, n, items): the distinct items of each key in order, in lists of at most ``size``; n is how many the key has in all, over its chunks. Null items are left out.

    No task holds a key's list: items are dealt by (key, range of items), ranges being the slices between quantiles of all items, and a key's ranges are numbered on from each other's counts. So the lists of a value that all rows share are
    spread over all tasks, and each is as long as its size says, but for one a range that may be shorter.
    """
    keys = [key] if isinstance(key, str) else key
    held = rows.select(*keys, item).where(F.col(item).isNotNull()).distinct()
    # rows are sorted and cut in the partitions of a range: (key, range) is never in two
    dealt = held.repartitionByRange(*keys, item).withColumn("_range", F.spark_partition_id())
    place = F.row_number().over(Window.partitionBy("_range", *keys).orderBy(item)) - 1
    placed = dealt.select(*keys, item, "_range", F.floor(place / size).alias("_slice"))
    lists = placed.groupBy(*keys, "_range", "_slice").agg(F.array_sort(F.collect_list(item)).alias(name))
    lists = stored(lists, workspace(rows.sparkSession, "lists"))
    # a row for each range of a key, without its items
    ranges = lists.groupBy(*keys, "_range").agg(F.count("*").alias("_lists"), F.sum(F.size(name)).alias("_items"), F.min(F.get(name, F.lit(0))).alias("_first"))
    before = F.coalesce(F.sum("_lists").over(Window.partitionBy(*keys).orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select(*(F.col(k).alias(f"_of_{k}") for k in keys), F.col("_range").alias("_of__range"), before.alias("_before"), F.sum("_items").over(Window.partitionBy(*keys)).alias("n"))
    on = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in [*keys, "_range"]]
    return lists.join(ranges, on).select(*keys, (F.col("_before") + F.col("_slice")).alias("chunk"), "n", name)


def validity(records: DataFrame, key: str, bad: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) counts as one row, and the keys of the invalid records as rows."""
    marked = records.select(F.col(key), F.coalesce(bad, F.lit(False)).alias("bad"))
    return marked.agg(F.count_if(~F.col("bad")).alias("valid"), F.count_if("bad").alias("invalid")), marked.where("bad").select(key)


def union_of_values(held: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) over all sources of a key: the union that every source is brought up to."""
    return held.select(key, value).where(F.col(value).isNotNull()).distinct()


def publications_to_write(missing: DataFrame, publications: DataFrame, key: str, value: str) -> DataFrame:
    """The missing (key, value) that the key's document doesn't name as a publication of another type than Primary."""
    other = publications.where(F.coalesce(F.col("type"), F.lit("")) != "Primary").select(key, value).distinct()
    return missing.join(other, [key, value], "left_anti")


def gaps(held: DataFrame, key: str, value: str, source: str) -> DataFrame:
    """(key, value, source) that some source of the key holds and another of its sources doesn't."""
    wanted = held.select(key, value).distinct().join(held.select(key, source).distinct(), key)
    return wanted.join(held.select(key, value, source).distinct(), [key, value, source], "left_anti")


def changes(diff: DataFrame) -> DataFrame:
    """Counts of added, modified and deleted files (status, path), of files named after their folder."""
    main = F.regexp_extract("path", r"([^/]+)/([^/]+)$", 1) == F.regexp_extract("path", r"([^/]+)/([^/]+)\.json$", 2)
    return diff.where(main).agg(*(F.count_if(F.col("status") == s).alias(n) for s, n in (("A", "added"), ("M", "modified"), ("D", "deleted"))))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(status, key) between two snapshots, by a 256-bit hash of their other columns in which nulls have a place."""
    side = lambda df, n: df.select(key, F.sha2(F.to_json(F.struct(*sorted(c for c in df.columns if c != key)), {"ignoreNullFields": "false"}), 256).alias(n))
    both = side(old, "o").join(side(new, "n"), key, "full")
    return both.select(F.when(F.col("o").isNull(), "A").when(F.col("n").isNull(), "D").when(F.col("o") != F.col("n"), "M").alias("status"), key).where("status is not null")


def pending(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return work.join(done.select(key), key, "left_anti")


def counts(rows: DataFrame, **by: Column) -> DataFrame:
    """Rows for each combination of the named columns: statuses, methods, hosts, days."""
    return rows.groupBy(*(c.alias(n) for n, c in by.items())).agg(F.count("*").alias("n"))


def repeated(rows: DataFrame, *keys: str, first: str | None = None) -> DataFrame:
    """The keys that more than one row has, how many have them, and the least of another column as ``first_id``."""
    wanted = [F.count("*").alias("n"), *([F.min(first).alias("first_id")] if first else [])]
    return rows.groupBy(*keys).agg(*wanted).where("n > 1")


def smoke(statuses: DataFrame) -> DataFrame:
    """(url, ok) of addresses that don't answer, from fetched (url, status)."""
    return statuses.where(F.coalesce(F.col("status"), F.lit(0)) != 200).select("url", F.lit(False).alias("ok"))


def resumed(work: DataFrame, prior: DataFrame, key: str, evaluate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The prior results of what is still wanted, and the results of what has none: an evaluation that goes on where it stopped."""
    return linked(prior, work, key).unionByName(evaluate(pending(work, prior, key)))


def stale(existing: DataFrame, valid: DataFrame, key: str) -> DataFrame:
    return existing.join(valid.select(key), key, "left_anti")


def linked(imported: DataFrame, tools: DataFrame, key: str) -> DataFrame:
    """The imported records that belong to a tool: the second half of the dual sink."""
    return imported.join(tools.select(key), key, "left_semi")
