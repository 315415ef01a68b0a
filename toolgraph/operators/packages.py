"""The package catalogue as one relational plan: reduced by semi joins, with fallback versions, and its children nested by joins instead of lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_version, debian_sort_key, strip_binary_upload
from .storage import stored, workspace


def latest_versions(packages: DataFrame, preferred="release <> 'experimental'", debian_order: bool = True) -> DataFrame:
    """(package, version): the greatest version outside experimental, else the greatest of all; of equal versions that are written differently the greatest text.

    A version's key is made once for each package that has it, not for each row.
    """
    each = packages.groupBy("package", "version").agg(F.coalesce(F.bool_or(F.expr(preferred)), F.lit(False)).alias("stable"))
    key = F.struct("stable", (debian_sort_key(F.col("version")) if debian_order else F.col("version")).alias("key"), "version")
    return each.groupBy("package").agg(F.max(key)["version"].alias("version"))


def latest_release(packages: DataFrame, releases: DataFrame) -> DataFrame:
    """(package, version, release): the release of greatest sort that has the version. releases is a small dimension that Spark broadcasts by its own size check."""
    return packages.join(releases, "release").groupBy("package", "version").agg(F.max_by("release", F.struct("sort", "release")).alias("release"))


def latest(rows: DataFrame, key: str, order: list[str], *columns: str) -> DataFrame:
    """Of each key the columns of the row that is greatest in the given order; ties go by the columns."""
    top = rows.groupBy(key).agg(F.max(F.struct(*order, *(c for c in columns if c not in order))).alias("top"))
    return top.select(key, *(F.col(f"top.{c}").alias(c) for c in columns))


def enrich(rows: DataFrame, dimension: DataFrame, on: dict[str, str]) -> DataFrame:
    """The rows with the columns of a dimension where it has them (on: column -> column of the dimension); Spark broadcasts what its own size check lets through."""
    condition = [rows[a] == dimension[b] for a, b in on.items()]
    return rows.join(dimension, condition, "left")


def nest(parent: DataFrame, children: dict[str, DataFrame], key: str) -> DataFrame:
    """Each child table's rows as a sorted array of structs under its parent; null where there are none."""

    def one(df: DataFrame, item: tuple[str, DataFrame]) -> DataFrame:
        name, child = item
        fields = [c for c in child.columns if c != key]
        return df.join(child.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name)), key, "left")

    return reduce(one, children.items(), parent)


def catalogue(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of packages that a blend depends on, in their latest version and release, with ontology terms, cross-references, citations, tags, popularity and descriptions,
    and the prospective packages of blends; ordered by source and package. The packages that are wanted are written once, as three steps need them."""
    wanted = tables["blends_dependencies"].select("package").distinct()
    spark = wanted.sparkSession
    own = stored(tables["packages"].withColumn("version", strip_binary_upload(F.col("version"))).join(wanted, "package", "left_semi"), workspace(spark, "packages"))
    picked = latest_release(own.join(latest_versions(own), ["package", "version"], "left_semi"), tables["releases"])
    found = own.join(picked, ["package", "version", "release"]).distinct()
    prospective = tables["blends_prospectivepackages"].select("package", "component", F.col("chlog_version").alias("version"), "source", "homepage", "license", "blend").withColumn("release", F.lit("vcs"))
    rows = found.unionByName(prospective, allowMissingColumns=True).distinct().withColumn("version", clean_version(F.col("version")))
    named = rows.join(tables["edam"], ["source", "package"], "left")
    by_source = tables["bibref"].groupBy("source").agg(F.sort_array(F.collect_list(F.struct("key", "package", "rank", "value"))).alias("bib"))
    refs = tables["registry"].groupBy("source").agg(F.sort_array(F.collect_list(F.struct("name", "entry"))).alias("registries"))
    out = named.join(by_source, "source", "left").join(refs, "source", "left")
    return nest(out, {n: tables[t] for n, t in (("tags", "debtags"), ("popcon", "popcon"), ("descr", "descriptions")) if t in tables}, "package").orderBy("source", "package")
