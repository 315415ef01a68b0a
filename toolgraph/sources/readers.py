"""Readers for the registries' documents. Records that can't be parsed come back in a rejects table instead of failing the job."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import reduce
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import recipes
from ..functions.jsonld import turtle_triples
from ..operators.storage import stored, workspace
from ..operators.triples import TAGGED, distinct_graph, from_jsonld, parser
from . import service
from .sinks import address

#: Files, and bytes of them, that one task reads; folders whose names one task lists; names, or bytes of files, that a task holds at once.
FILES, READ_BYTES, FOLDERS, NAMES, HELD = 1_000, 128 << 20, 10_000, 2_000, 4 << 20
#: What a java.net.URI has as %XX in a path.
_QUOTED = re.compile(r"""[\x00-\x20"#%<>?\[\\\]^`{|}\x7f]""")


def _opened(place: str):
    """(store, path in it, what comes before the path in addresses)."""
    from pyarrow import fs

    if place.startswith("file:"):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", place), "file:"
    base = re.match(r"[^:/]+://[^/]*", place)[0]  # the rest may hold what an URI has to quote
    store, bucket = fs.FileSystem.from_uri(f"{base}/")
    head = base.removesuffix(bucket.strip("/"))
    return store, place.removeprefix(head), head


def _names(store, folder: str) -> Iterator[list[str]]:
    """The names in a folder, up to NAMES at once; none of what isn't a folder."""
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        if not os.path.isdir(folder):
            return
        names, held = (x.name for x in os.scandir(folder)), []
        for name in names:
            held.append(name)
            if len(held) == NAMES:
                yield held
                held = []
        yield held
    elif store.get_file_info(folder).type == fs.FileType.Directory:
        names = [x.base_name for x in store.get_file_info(fs.FileSelector(folder, allow_not_found=True))]
        yield from (names[i : i + NAMES] for i in range(0, len(names), NAMES))


def _dealt(rows: DataFrame, each: int) -> DataFrame:
    n = rows.count()
    return rows.repartition(max(n // each + 1, min(n, rows.sparkSession.sparkContext.defaultParallelism), 1))


def files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame | None:
    """(path, length, modified) of the files that a path or a glob pattern of Hadoop's names, or that are in the folders that it names, without hidden and empty ones, as Spark's own readers take them.

    Those hold a record of every file on the driver, which millions of small files don't allow. Here tasks list the folders, level by level, and the names are a stored table. None: a store that only Spark reaches.
    """
    globs, folder, found = spark._jvm.org.apache.hadoop.fs, workspace(spark, "listed"), []
    for n, pattern in enumerate(globs.GlobExpander.expand(path)):
        parts = pattern.rstrip("/").split("/")
        first = next((i for i, x in enumerate(parts) if re.search(r"[*?\[{\\]", x)), len(parts))
        place = address(spark, "/".join(parts[:first]) or ("/" if pattern.startswith("/") else "."))
        try:
            root = _opened(place)[1]
        except (pa.ArrowException, OSError, NotImplementedError):
            return None

        def children(batches: Iterator[pa.RecordBatch], place=place) -> Iterator[pa.RecordBatch]:
            store = _opened(place)[0]
            for batch in batches:
                for at in batch.column("place").to_pylist():
                    for names in _names(store, at):
                        yield pa.RecordBatch.from_arrays([pa.array([at] * len(names), pa.string()), pa.array(names, pa.string())], ["at", "name"])

        def leaves(batches: Iterator[pa.RecordBatch], place=place) -> Iterator[pa.RecordBatch]:
            from pyarrow import fs

            store, _, head = _opened(place)

            def found(paths: list[str], top: bool) -> Iterator[pa.RecordBatch]:
                infos = [x for x in store.get_file_info(paths) if not re.match(r"\.|_(?!.*=)|.*\._COPYING_$", x.base_name) or top and x.type == fs.FileType.Directory]
                own = [x for x in infos if x.type == fs.FileType.File and x.size]
                times = pa.array([(x.mtime_ns or 0) // 1_000_000 * 1000 for x in own], pa.int64()).cast(pa.timestamp("us", "UTC"))
                yield pa.RecordBatch.from_arrays([pa.array([head + x.path for x in own], pa.string()), pa.array([x.size for x in own], pa.int64()), times], ["path", "length", "modified"])
                for x in infos:
                    if x.type == fs.FileType.Directory and (top or recursive or "=" in x.base_name):
                        for names in _names(store, x.path):
                            yield from found([f"{x.path}/{name}" for name in names], False)

            for batch in batches:
                paths = batch.column("place").to_pylist()
                for i in range(0, len(paths), NAMES):
                    yield from found(paths[i : i + NAMES], True)

        rows = spark.range(0, 1, 1, 1).select(F.lit(root.rstrip("/")).alias("place"))
        for i, part in enumerate(parts[first:]):
            if re.search(r"[*?\[{\\]", part):
                named = F.rlike("name", F.lit(rf"(?s)\A(?:{globs.GlobPattern(part).compiled().pattern()})\z"))
                rows = rows.mapInArrow(children, "at string, name string").where(named).select(F.concat("at", F.lit("/"), "name").alias("place"))
                rows = _dealt(stored(rows, f"{folder}/{n}-{i}"), FOLDERS)
            else:
                rows = rows.select(F.concat("place", F.lit(f"/{part}")).alias("place"))
        if first == len(parts):
            rows = rows.select(F.when(F.col("place") == "", "/").otherwise(F.col("place")).alias("place"))
        found.append(rows.mapInArrow(leaves, "path string, length long, modified timestamp"))
    return stored(reduce(DataFrame.unionAll, found), f"{folder}/files")


def texts(spark: SparkSession, path: str, then: Callable | None = None, schema: str = "") -> DataFrame:
    """(path, value): one row a file. Tasks list the files (see files) and each reads up to FILES of them; Spark's own reader, which lists them on the driver and gives a task 32 small ones, is left those that only it reaches.

    then: a function for mapInArrow that takes the texts (value) and gives rows of the schema. It gets them where they are read, HELD bytes at once: sent through the JVM to another Python process, they would be held there in batches of 64 MB.
    """
    found = files(spark, path)
    n, size = found.agg(F.count("*"), F.sum("length")).first() if found is not None else (0, 0)
    if not n:  # it also says what is wrong with a path that names nothing
        found = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
        return found.select("value").mapInArrow(then, schema) if then else found

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(held):
            return pa.RecordBatch.from_arrays([pa.array([_QUOTED.sub(lambda x: quote(x[0]), p) for p, _ in held], pa.string()), pa.array([x for _, x in held], pa.binary())], ["path", "value"])

        held, size, store, head = [], 0, None, ""
        for batch in batches:
            for p in batch.column("path").to_pylist():
                if store is None:
                    store, _, head = _opened(p)
                with store.open_input_stream(p.removeprefix(head)) as f:
                    held.append((p, f.read()))
                size += len(held[-1][1])
                if len(held) == NAMES or size >= HELD:
                    yield rows(held)
                    held, size = [], 0
        yield rows(held)

    tasks = max(n // FILES, size // READ_BYTES) + 1
    dealt = found.select("path").repartition(max(tasks, min(n, spark.sparkContext.defaultParallelism)))
    if then:
        return dealt.mapInArrow(lambda batches: then(pa.RecordBatch.from_arrays([b.column("value").cast(pa.string())], ["value"]) for b in read(batches)), schema)
    return dealt.mapInArrow(read, "path string, value binary").select("path", F.col("value").cast("string").alias("value"))


def json_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(path, doc as VARIANT), and the files that aren't JSON."""
    parsed = texts(spark, path).withColumn("doc", F.try_parse_json("value"))
    return parsed.where("doc is not null").select("path", "doc"), parsed.where("doc is null").select("path", "value")


def keyed_json(spark: SparkSession, path: str) -> DataFrame:
    """(key, doc): the entries of one JSON object."""
    docs, _ = json_documents(spark, path)
    return docs.select(F.explode(F.map_entries(F.variant_get("doc", "$", "map<string,variant>"))).alias("e")).select("e.key", F.col("e.value").alias("doc"))


def _yaml_rows(frames: Iterator[pd.DataFrame], prepare: Callable[[str], str]) -> Iterator[pd.DataFrame]:
    import yaml

    for f in frames:
        docs = []
        for v in f["value"]:
            try:
                docs.append(json.dumps(yaml.safe_load(prepare(v)), sort_keys=True, default=str))
            except (yaml.YAMLError, recipes.TemplateError):
                docs.append(None)
        yield pd.DataFrame({"path": f["path"], "json": docs, "value": f["value"]})


def yaml_documents(spark: SparkSession, path: str, templated: bool = False) -> tuple[DataFrame, DataFrame]:
    """(path, doc as VARIANT) of YAML files (templated: recipes, rendered first), and the files that aren't YAML or no template."""
    prepare = recipes.render if templated else str
    parsed = texts(spark, path).mapInPandas(lambda it: _yaml_rows(it, prepare), "path string, json string, value string")
    return parsed.where("json is not null").select("path", F.parse_json("json").alias("doc")), parsed.where("json is null").select("path", "value")


_PREFIX = re.compile(r"<(?:([A-Za-z_][\w.-]*):)?(?:urlset|sitemapindex)[\s>]")


def sitemap(spark: SparkSession, path: str, index: bool = False) -> DataFrame:
    """(loc, lastmod) of sitemaps, or of sitemap indexes, whatever prefix a file gives their namespace.

    The heads of the files are read for the prefixes that they use; each prefix's elements are then read from the files by their own tag, so that large files are split. What isn't well-formed gives no row.
    """
    tag, fields = "sitemap" if index else "url", ("loc", "lastmod")
    heads = spark.read.text(path).select(F.regexp_extract("value", _PREFIX.pattern, 1).alias("prefix"), F.rlike("value", F.lit(_PREFIX.pattern)).alias("root")).where("root").select("prefix").distinct()
    out = []
    for prefix in sorted(r.prefix for r in heads.collect()) or [""]:  # as many as there are ways to write it
        named = lambda f, prefix=prefix: f"{prefix}:{f}" if prefix else f
        rows = spark.read.format("xml").option("rowTag", named(tag)).option("mode", "DROPMALFORMED").schema(", ".join(f"`{named(f)}` string" for f in fields)).load(path)
        out.append(rows.select(*(F.col(f"`{named(f)}`").alias(f) for f in fields)))
    return reduce(DataFrame.unionByName, out)


def ontology(spark: SparkSession, path: str) -> DataFrame:
    """(label, entity) of the classes of an OWL/XML file, a row for each label of a class."""
    label = "array<struct<_VALUE:string,`_xml:lang`:string>>"
    raw = spark.read.format("xml").option("rowTag", "owl:Class").option("attributePrefix", "_").schema(f"`rdfs:label` {label}, `_rdf:about` string").load(path)
    return raw.select(F.explode("`rdfs:label`").alias("l"), F.col("`_rdf:about`").alias("entity")).select(F.col("l._VALUE").alias("label"), "entity").where("label is not null")


def server_table(spark: SparkSession, path: str) -> DataFrame:
    """(name, url) of a tab-separated table; spaces in names become underscores."""
    t = spark.read.csv(path, sep="\t", header=True)
    return t.select(F.replace(F.col("name"), F.lit(" "), F.lit("_")).alias("name"), "url")


def fair_scores(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Earlier scores: numbers by the given schema, or else texts (score_of casts them), so that the file is read once."""
    return spark.read.csv(path, header=True, schema=schema) if schema else spark.read.csv(path, header=True)


def url_list(spark: SparkSession, path: str, old: str, base: str) -> DataFrame:
    return spark.read.text(path).select(F.replace("value", F.lit(old), F.lit(base)).alias("url"))


def git_diff(spark: SparkSession, path: str) -> DataFrame:
    """(status, path) of ``git diff --name-status`` output."""
    return spark.read.csv(path, sep="\t", schema="status string, path string")


def jdbc_tables(spark: SparkSession, url: str, names: list[str], **options: str) -> dict[str, DataFrame]:
    """Whole tables, each as one partition: for dimensions. See jdbc_ranges for large ones."""
    return {n: spark.read.format("jdbc").options(url=url, dbtable=n, **options).load() for n in names}


def jdbc_ranges(spark: SparkSession, url: str, source: str, key: str, parts: int = 8, keys_of: str | None = None, **options: str) -> DataFrame:
    """A table read in up to ``parts`` ranges of an integer key, each a partition with about as many rows: their bounds are taken from the counts of 64 * parts slices of the key, which the database makes.

    keys_of: a query (one column named like the key) that the database semi-joins the table with before anything is read. Filters and columns are pushed by Spark. Rows whose key is null are in the first range.
    A table with no keys is one partition.
    """
    kept = f"(SELECT * FROM {source} WHERE {key} IN ({keys_of})) kept" if keys_of else source
    ask = lambda sql: spark.read.format("jdbc").options(url=url, dbtable=f"({sql}) asked", **options).load()
    low, high = ask(f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {kept}").first()
    reader = spark.read
    if low is None or low == high:
        return reader.format("jdbc").options(url=url, dbtable=kept, **options).load()
    width = max(1, -(-(int(high) - int(low) + 1) // (64 * parts)))
    counts = ask(f"SELECT slice, COUNT(*) AS n FROM (SELECT ({key} - {int(low)}) / {width} AS slice FROM {kept} WHERE {key} IS NOT NULL) sliced GROUP BY slice").collect()  # 64 * parts rows at most
    total, done, bounds = sum(r[1] for r in counts), 0, []
    for slice_, n in sorted((int(r[0]), r[1]) for r in counts):
        if len(bounds) < parts - 1 and done and done * parts >= total * (len(bounds) + 1):
            bounds.append(int(low) + slice_ * width)
        done += n
    edges = [None, *bounds, None]
    where = [" AND ".join(x for x in (f"{key} >= {a}" if a is not None else "", f"{key} < {b}" if b is not None else "") if x) or "1 = 1" for a, b in zip(edges, edges[1:], strict=False)]
    where[0] = f"({where[0]}) OR {key} IS NULL"
    return reader.jdbc(url, kept, predicates=where, properties=options)


def paged(spark: SparkSession, fetch: Callable[[int], list[dict] | None], schema: str, at_once: int = 64) -> DataFrame:
    """All pages of a listing from 1 on, ``at_once`` tasks taking turns with them until one is empty. Without a network, ``fetch`` reads a dump. See service.py for filters and streams."""
    return service.listing(spark, service.listing_source(lambda page, _: fetch(page), schema, at_once=at_once))


def fetched(keys: DataFrame, key: str, cache: DataFrame, fetch: Callable[[str], str | None], attempts: int = 1) -> DataFrame:
    """(key, value): cached values (of several the greatest), and fetched ones, by up to ``attempts`` requests, for the keys that the cache lacks. Each key comes once."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({key: f[key], "value": [service.retried(fetch, k, attempts=attempts) for k in f[key]]})

    wanted = keys.select(key).distinct()
    missing = wanted.join(cache.select(key), key, "left_anti").mapInPandas(rows, f"{key} string, value string")
    return cache.join(wanted, key, "left_semi").groupBy(key).agg(F.max("value").alias("value")).unionByName(missing)


def config_value(spark: SparkSession, path: str, key: str, default: str | None = None) -> str | None:
    """One top-level value of a small YAML file, as text: a release number that other reads need."""
    import yaml

    found = texts(spark, path).select("value").head(1)
    value = (yaml.safe_load(found[0].value) or {}).get(key, default) if found else default
    return None if value is None else str(value)


def keyed_yaml(spark: SparkSession, path: str) -> DataFrame:
    """(key, doc): the entries of a YAML mapping."""
    docs, _ = yaml_documents(spark, path)
    return docs.select(F.explode(F.map_entries(F.variant_get("doc", "$", "map<string,variant>"))).alias("e")).select("e.key", F.col("e.value").alias("doc"))


def listing(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(path, folder, name, length, modified) of the files there, without reading them."""
    found = files(spark, path, recursive)
    if found is None or found.isEmpty():  # see texts
        found = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path).select("path", "length", F.col("modificationTime").alias("modified"))
    return found.select("path", F.element_at(F.split("path", "/"), -2).alias("folder"), F.substring_index("path", "/", -1).alias("name"), "length", "modified")


def json_or_none(spark: SparkSession, path: str) -> DataFrame:
    """(doc): the entries of JSON lists; files that can't be parsed give none."""
    docs, _ = json_documents(spark, path)
    return docs.select(F.explode(F.coalesce(F.try_variant_get("doc", "$", "array<variant>"), F.array().cast("array<variant>"))).alias("doc"))


def jsonld(spark: SparkSession, path: str, prefixes: dict[str, str] | None = None, **how) -> DataFrame:
    """(s, p, o, o_kind) of all JSON-LD files, as from_jsonld reads them; those that can't be parsed give none."""
    docs, _ = json_documents(spark, path)
    return from_jsonld(docs, prefixes, **how)


def turtle(spark: SparkSession, path: str, tagged: bool = False) -> DataFrame:
    """(s, p, o, o_kind) of all Turtle files, as from_turtle reads them."""
    return distinct_graph(texts(spark, path, parser(turtle_triples), TAGGED), tagged)


def fetched_graphs(urls: DataFrame, cache: DataFrame, fetch: Callable[[str], str | None], **how) -> DataFrame:
    """(s, p, o, o_kind) of the JSON-LD behind each url; a failure or an answer that can't be parsed is an empty graph."""

    def safe(url: str) -> str | None:
        try:
            return fetch(url)
        except Exception:  # any failure of the provider
            return None

    return from_jsonld(fetched(urls, "url", cache, safe).select(F.try_parse_json("value").alias("doc")).where("doc is not null"), **how)


def url_statuses(urls: DataFrame, cache: DataFrame, probe: Callable[[str], int]) -> DataFrame:
    """(url, ok): whether each address answers with 200; the cache has (url, value), the status as text."""

    def status(url: str) -> str:
        try:
            return str(probe(url))
        except Exception:  # a request that fails is an address that doesn't answer
            return "0"

    return fetched(urls, "url", cache, status).select("url", (F.col("value") == "200").alias("ok"))


def nodes(spark: SparkSession, listed: DataFrame, cache: DataFrame, fetch: Callable[[str], str | None]) -> DataFrame:
    """(nid, doc) of the listed nodes (nid), each fetched once; those that fail or can't be parsed are left out."""
    return fetched(listed, "nid", cache, fetch).select("nid", F.try_parse_json("value").alias("doc")).where("doc is not null")


def side_files(spark: SparkSession, pattern: str, suffix: str) -> DataFrame:
    """(package, html) of files named ``package + suffix``."""
    name = F.substring_index("path", "/", -1)
    return texts(spark, pattern).where(F.endswith(name, F.lit(suffix))).select(F.substring(name, F.lit(1), F.length(name) - len(suffix)).alias("package"), F.col("value").alias("html"))
