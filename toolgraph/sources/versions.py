"""Tables with committed versions: data files are written beside what is there, and a version is one small file that says which of them count.

A table is a folder: ``data/<id>/_part=<key>`` holds files, ``versions/<n>.json`` names the folders of version n. A version counts once its file is there; it is made by a rename that fails if the name is taken (on stores that rename at once), so of two writers one
has to begin anew, and a job or task that fails half-way leaves nothing that any version names. Versions are never changed: readers of one keep it while the next is made, a table can be rewritten from itself, and
an earlier version can be made current again. ``vacuum`` deletes what no kept version names.

A table may be split by one column: then a version names folders by that column's values (as MD5, null apart), and a refresh replaces the values it is about and keeps the others.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHOLE = "all"


class Conflict(RuntimeError):
    """Another writer made the version first."""


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def part_name(value: str | None) -> str:
    return "null" if value is None else hashlib.md5(value.encode()).hexdigest()


def _part(column: str) -> Column:
    return F.coalesce(F.md5(F.col(column).cast("string").cast("binary")), F.lit("null"))


def numbers(spark: SparkSession, table: str) -> list[int]:
    """The versions of a table, in order; none if there is no table."""
    target, fs = _path(spark, f"{table}/versions")
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, table: str, version: int | None = None) -> dict:
    """What a version (by default the last) is made of: version, schema and parts (name -> folder below data)."""
    known = numbers(spark, table)
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"{table} has no version {version if version is not None else 'yet'}")
    target, fs = _path(spark, f"{table}/versions/{known[-1] if version is None else version}.json")
    stream = fs.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _publish(spark: SparkSession, table: str, content: dict, base: int) -> int:
    """Makes version base + 1, unless somebody has."""
    version = base + 1
    attempt, fs = _path(spark, f"{table}/versions/.{uuid.uuid4().hex}")
    target, _ = _path(spark, f"{table}/versions/{version}.json")
    stream = fs.create(attempt, False)
    try:
        stream.write(json.dumps(content | {"version": version}, sort_keys=True).encode())
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(attempt, target):
        fs.delete(attempt, False)
        raise Conflict(f"{table}: version {version} is there already")
    return version


def commit(df: DataFrame, table: str, by: str | None = None, refreshed: list[str | None] | None = None, since: int | None = None) -> int:
    """Makes df the next version, and gives its number.

    by: the column that the table is split by. With it, ``refreshed`` names the values that df is all there is of (those that df has are added; a value named without rows becomes empty); the table's other values stay as they were. Without
    ``refreshed`` df is the whole table. since: the version that df was computed from; if there is another by now, Conflict is raised, as it is if one is made meanwhile.
    """
    spark = df.sparkSession
    base = (numbers(spark, table) or [0])[-1]
    if since is not None and since != base:
        raise Conflict(f"{table}: version {since} isn't the last one, {base} is")
    old = manifest(spark, table) if base else {"parts": {}}
    name = uuid.uuid4().hex
    df.withColumn("_part", _part(by) if by else F.lit(WHOLE)).write.partitionBy("_part").parquet(f"{table}/data/{name}")
    target, fs = _path(spark, f"{table}/data/{name}")
    new = {s.getPath().getName().removeprefix("_part="): f"{name}/{s.getPath().getName()}" for s in fs.listStatus(target) if s.isDirectory()}
    kept = {}
    if by and refreshed is not None:
        gone = set(map(part_name, refreshed))
        kept = {p: f for p, f in old["parts"].items() if p not in gone}
    return _publish(spark, table, {"schema": df.schema.jsonValue(), "parts": kept | new}, base)


def read(spark: SparkSession, table: str, version: int | None = None, values: list[str | None] | None = None) -> DataFrame:
    """A version of a table, by default the last; of a split table only the given values' files are read."""
    from pyspark.sql.types import StructType

    content = manifest(spark, table, version)
    schema = StructType.fromJson(content["schema"])
    wanted = None if values is None else set(map(part_name, values))
    folders = [f"{table}/data/{f}" for p, f in sorted(content["parts"].items()) if wanted is None or p in wanted]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def restore(spark: SparkSession, table: str, version: int) -> int:
    """Makes an earlier version current again, as the next one."""
    return _publish(spark, table, {k: v for k, v in manifest(spark, table, version).items() if k != "version"}, numbers(spark, table)[-1])


def without_stale(spark: SparkSession, table: str, valid: DataFrame, key: str, by: str | None = None) -> int:
    """The next version of a table: its records whose key is still in ``valid``. Null keys aren't."""
    base = numbers(spark, table)[-1]
    return commit(read(spark, table, base).join(valid.select(key).distinct(), key, "left_semi"), table, by, since=base)


def vacuum(spark: SparkSession, table: str, keep: int = 2) -> list[str]:
    """Deletes versions but the last ``keep``, and the data folders that none of these names: also those of failed writers, so none may be at work. Gives the folders' names."""
    known = numbers(spark, table)
    named = {f.split("/")[0] for n in known[-keep:] for f in manifest(spark, table, n)["parts"].values()}
    for n in known[:-keep]:
        target, fs = _path(spark, f"{table}/versions/{n}.json")
        fs.delete(target, False)
    target, fs = _path(spark, f"{table}/data")
    stale = [s.getPath() for s in fs.listStatus(target) if s.getPath().getName() not in named]
    for p in stale:
        fs.delete(p, True)
    return sorted(p.getName() for p in stale)
