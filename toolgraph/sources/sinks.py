"""Sinks: tables with committed versions for the engine, and files for people."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.storage import remove, stored
from . import versions


def bronze(df: DataFrame, path: str, sources: list[str | None] | None = None) -> int:
    """Full refresh of the sources that df has and of those named: one that is empty now loses its records. Other sources stay. Gives the table's new version; versions.read reads it."""
    return versions.commit(df, path, "source", sources or [])


def json_lines(df: DataFrame, path: str) -> None:
    """Records as JSON with sorted keys, one a line."""
    df.select(F.to_json(F.to_variant_object(F.struct(*df.columns))).alias("value")).write.mode("overwrite").text(path)


def lines(df: DataFrame, path: str) -> None:
    """A one-column table as sorted text: N-Triples, JSON-LD, manifests."""
    df.sort(df.columns[0]).write.mode("overwrite").text(path)


#: Lines of a Turtle file: a document is read as a whole.
TURTLE_LINES = 5_000


def turtle(graph: DataFrame, path: str, prefixes: dict[str, str] | None = None) -> None:
    """A graph as Turtle files of up to TURTLE_LINES lines, each with the prefixes at its head and its statements in order."""
    from ..operators import triples

    head, lines_ = triples.turtle_head(prefixes), TURTLE_LINES

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free = 0
        for batch in batches:
            at = 0
            while at < len(batch):
                if not free:
                    yield pa.RecordBatch.from_arrays([pa.array(head, pa.string())], ["value"])
                    free = lines_ - len(head)
                taken = batch.column(0).slice(at, free)
                yield pa.RecordBatch.from_arrays([taken], ["value"])
                at, free = at + len(taken), free - len(taken)

    rows = triples.turtle(graph, prefixes).repartitionByRange("s").sortWithinPartitions("s").select("value").mapInArrow(headed, "value string")
    rows.write.mode("overwrite").option("maxRecordsPerFile", lines_).text(path)


def csv(df: DataFrame, path: str) -> None:
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").csv(path, header=True)


def markdown(df: DataFrame, limit: int = 1000) -> str:
    """A report of the first ``limit`` rows in order of all columns; flags as marks. A last line says how many more there are."""
    found = df.orderBy(*df.columns).limit(limit + 1).collect()
    rows = [[{True: "✓", False: ""}.get(v, v) if isinstance(v, bool) else v for v in r] for r in found[:limit]]
    lines = [f"| {' | '.join(map(str, r))} |" for r in [df.columns, ["---"] * len(df.columns), *rows]]
    if len(found) > limit:
        lines.append(f"\n{df.count() - limit} more rows")
    return "\n".join(lines)


def _yaml(document: str) -> str:
    import yaml

    return yaml.safe_dump(json.loads(document), sort_keys=True, allow_unicode=True)


def _indented(document: str) -> str:
    return json.dumps(json.loads(document), sort_keys=True, indent=4, ensure_ascii=False, separators=(",", ": "))


FORMATS = {"json": _indented, "yaml": _yaml, "text": str}


def address(spark: SparkSession, folder: str) -> str:
    """The folder's whole address: one without a scheme is in Spark's default store."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()
    return whole if "://" in whole else whole.replace(":/", ":///", 1)


def _store(place: str):
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(place)
    return store, base.rstrip("/")


def record_files(df: DataFrame, folder: str, path: Column, document: Column, form: str = "json") -> DataFrame:
    """One file a record: writes ``folder/path`` with the document (JSON text) as JSON or YAML with sorted keys, or as the text it is, and gives (path) of the files.

    First every task writes its records to a folder of its own attempt, and the list of those that came through is stored; only then are the files moved to their places, by tasks too. So a job that fails
    while it writes leaves no file in its place, none is ever half there, and moving can be done again: what has been moved is left alone. Records without path or document are left out; of several
    with one path the greatest document is taken.
    """
    spark, turn = df.sparkSession, FORMATS[form]
    place = address(spark, folder)
    staging = f"{place.rstrip('/')}/.staging-{uuid.uuid4().hex}"

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(staging)
        own = f"{base}/{uuid.uuid4().hex}"
        store.create_dir(own, recursive=True)
        n = 0
        for batch in batches:
            places = []
            for text in batch.column("document").to_pylist():
                places.append(f"{own}/{n}")
                n += 1
                with store.open_output_stream(places[-1]) as out:
                    out.write(turn(text).encode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(places, pa.string())], ["path", "staged"])

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = _store(place)
        for batch in batches:
            for name, staged in zip(batch.column("path").to_pylist(), batch.column("staged").to_pylist(), strict=True):
                target = f"{base}/{name}"
                if store.get_file_info(staged).type == fs.FileType.File:  # else it has been moved
                    store.create_dir(target.rsplit("/", 1)[0], recursive=True)
                    if store.get_file_info(target).type == fs.FileType.File:  # some stores don't move over a file
                        store.delete_file(target)
                    store.move(staged, target)
            yield batch.select(["path"])

    rows = df.select(path.cast("string").alias("path"), document.cast("string").alias("document")).where("path is not null and document is not null").groupBy("path").agg(F.max("document").alias("document"))
    listed = stored(rows.mapInArrow(stage, "path string, staged string"), f"{staging}/list")
    listed.mapInArrow(move, "path string").write.format("noop").mode("overwrite").save()
    remove(spark, staging)
    return rows.select("path")


def dual(records: DataFrame, tools: DataFrame, key: str, bronze_path: str, linked_path: str, sources: list[str | None] | None = None) -> None:
    """Every record to the bronze table; those of a known tool also to the table of linked records. Both are refreshed for the sources that records has, and those named."""
    linked = records.join(tools.select(F.lower(key).alias("_id")).distinct(), F.lower(F.col(key)) == F.col("_id"), "left_semi")
    named = {r[0] for r in records.select("source").distinct().collect()} | set(sources or [])  # as many as there are sources
    bronze(records, bronze_path, list(named))
    bronze(linked, linked_path, list(named))  # a source none of whose records is linked any more
