"""Canonical forms of nested documents, built as expressions from the schema: falsy values dropped, versions as text, keys dropped, arrays sorted."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_falsy(c: Column, t: T.DataType) -> Column:
    """Null for null, empty, zero and false at every depth; a container whose parts all go, goes too."""
    if isinstance(t, T.StructType):
        parts = [drop_falsy(c[f.name], f.dataType).alias(f.name) for f in t.fields]
        return F.when(_any(parts), F.struct(*parts))
    if isinstance(t, T.ArrayType):
        kept = F.filter(F.transform(c, lambda x: drop_falsy(x, t.elementType)), lambda x: x.isNotNull())
        return F.when(F.size(kept) > 0, kept)
    if isinstance(t, T.StringType):
        return F.nullif(c, F.lit(""))
    if isinstance(t, T.BooleanType):
        return F.when(c, c)
    if isinstance(t, T.NumericType):
        return F.when(c != 0, c)
    return c


def _any(parts: list[Column]) -> Column:
    out = parts[0].isNotNull()
    for p in parts[1:]:
        out = out | p.isNotNull()
    return out


def drop_falsy_columns(df: DataFrame) -> DataFrame:
    return df.select(*(drop_falsy(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields))


def deep_sort(c: Column, t: T.DataType) -> Column:
    """Every array sorted, the inner ones first."""
    if isinstance(t, T.ArrayType):
        return F.sort_array(F.transform(c, lambda x: deep_sort(x, t.elementType)))
    if isinstance(t, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(deep_sort(c[f.name], f.dataType).alias(f.name) for f in t.fields)))
    return c


def drop_keys(c: Column, t: T.DataType, names: set[str]) -> Column:
    """Fields of the given names left out at every depth."""
    if isinstance(t, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(drop_keys(c[f.name], f.dataType, names).alias(f.name) for f in t.fields if f.name not in names)))
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda x: drop_keys(x, t.elementType, names))
    return c


def drop_paths(df: DataFrame, paths: list[str]) -> DataFrame:
    """Fields left out by path (``a``, ``a.b``, ``a.b.c``); a path that isn't there changes nothing, and a struct that loses all its fields goes."""
    by: dict[str, list[str]] = {}
    for p in paths:
        top, _, rest = p.partition(".")
        by.setdefault(top, []).append(rest)

    def without(c: Column, t: T.DataType, inner: list[str]) -> Column | None:
        if not isinstance(t, T.StructType):
            return c
        next_: dict[str, list[str]] = {}
        for p in inner:
            top, _, rest = p.partition(".")
            next_.setdefault(top, []).append(rest)
        parts = []
        for f in t.fields:
            if "" in next_.get(f.name, []):
                continue
            part = without(c[f.name], f.dataType, next_[f.name]) if f.name in next_ else c[f.name]
            if part is not None:
                parts.append(part.alias(f.name))
        return F.when(c.isNotNull(), F.struct(*parts)) if parts else None

    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in by:
            c = None if "" in by[f.name] else without(c, f.dataType, by[f.name])
        if c is not None:
            out.append(c.alias(f.name))
    return df.select(*out)


def sub_document(fields: list[str]) -> Column:
    return F.struct(*fields)


def or_default(c: Column, default: str = "") -> Column:
    """A field that the document lacks."""
    return F.coalesce(c, F.lit(default))


def merge_maps(old: Column, new: Column) -> Column:
    """The entries of both maps, those of ``new`` where both have the key."""
    kept = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k))
    return F.when(old.isNull(), new).when(new.isNull(), old).otherwise(F.map_concat(kept, new))


def version_text(c: Column, t: T.DataType) -> Column:
    """Numbers as text at every depth; booleans and nulls stay."""
    if isinstance(t, T.NumericType):
        return c.cast("string")
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda x: version_text(x, t.elementType))
    if isinstance(t, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(version_text(c[f.name], f.dataType).alias(f.name) for f in t.fields)))
    return c


def version_at(df: DataFrame, path: str) -> DataFrame:
    """version_text at ``a``, ``a.b``, ``a[]`` or ``a[].b``; a path that isn't there changes nothing."""
    top, _, rest = path.partition(".")
    name, many = top.removesuffix("[]"), top.endswith("[]")
    if name not in df.columns:
        return df
    t, c = df.schema[name].dataType, F.col(f"`{name}`")
    if not rest:
        return df.withColumn(name, version_text(c, t))
    inner = t.elementType if many and isinstance(t, T.ArrayType) else t
    if not isinstance(inner, T.StructType) or rest not in inner.names:
        return df
    put = lambda x: x.withField(rest, version_text(x[rest], inner[rest].dataType))
    return df.withColumn(name, F.transform(c, put) if many else put(c))


def rename_spaces(df: DataFrame) -> DataFrame:
    return df.toDF(*(n.replace(" ", "_") for n in df.columns))


def _truthy(x):
    if isinstance(x, dict):
        x = {k: v for k, v in ((k, _truthy(v)) for k, v in x.items()) if v}
    elif isinstance(x, list):
        x = [v for v in map(_truthy, x) if v]
    return x


@F.pandas_udf(T.StringType())
def drop_falsy_json(s: pd.Series) -> pd.Series:
    """drop_falsy for JSON texts of unknown schema, keys sorted; null for texts that can't be parsed."""

    def one(x):
        try:
            return json.dumps(_truthy(json.loads(x)), sort_keys=True, ensure_ascii=False)
        except (TypeError, ValueError):
            return None

    return s.map(one)
