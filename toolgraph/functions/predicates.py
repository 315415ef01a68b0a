"""Conditions on records, each one built-in expression that a scan can take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_text(c: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(c != "", F.lit(False))


def is_object(doc: Column) -> Column:
    """A VARIANT that holds a mapping."""
    return F.coalesce(F.startswith(F.schema_of_variant(doc), F.lit("OBJECT")), F.lit(False))


def is_list(doc: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(doc), F.lit("ARRAY")), F.lit(False))


def english(descriptions: Column) -> Column:
    """The description of the first entry (language, description) that is in English and has one; null without."""
    return F.get(F.filter(descriptions, lambda d: (d["language"] == "en") & d["description"].isNotNull()), F.lit(0))["description"]


def primary(publications: Column, others: bool = False) -> Column:
    """The publications (type, ...) of type Primary, or those of another or no type."""
    is_primary = lambda p: F.coalesce(p["type"] == "Primary", F.lit(False))
    return F.filter(publications, (lambda p: ~is_primary(p)) if others else is_primary)


def self_named(package: str = "package", source: str = "source") -> Column:
    return F.col(package) == F.col(source)


def file_shape(path: Column, extension: str, parts: int = 3) -> Column:
    """The file's name has so many parts between dots, the last of which is the extension."""
    names = F.split(F.substring_index(path, "/", -1), r"\.")
    return (F.size(names) == parts) & (F.element_at(names, -1) == extension)


def selected(path: Column, name: str, exact: bool = False) -> Column:
    """Runs for a single tool: the name is part of the path, or the file's folder has exactly that name."""
    return F.element_at(F.split(path, "/"), -2) == name if exact else F.contains(path, F.lit(name))


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in the given order, ties by every other column that can be compared."""
    rest = [c for c, t in df.dtypes if c not in order and not t.startswith(("map", "variant"))]
    return df.orderBy(*order, *rest).limit(n)
