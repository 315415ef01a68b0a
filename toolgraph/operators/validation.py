"""Documents against a schema: the schema becomes column expressions over the documents' own types, which give every violation as (path, rule)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VIOLATIONS = "array<struct<path:string,rule:string>>"
_TEXT = {"minLength", "maxLength", "pattern", "format"}
_NUMBER = {"minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf"}
_LIST = {"minItems", "maxItems", "uniqueItems", "items", "contains"}
_OBJECT = {"required", "properties", "additionalProperties", "dependentRequired"}
KEYWORDS = {"type", "enum", "const", "oneOf", "anyOf", "allOf", "not", "title", "description", "$schema", "$id", "$ref", "$defs"} | _TEXT | _NUMBER | _LIST | _OBJECT
#: What the named formats look like.
FORMATS = {
    "uri": r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s<>\"{}|\\^`]*$", "email": r"^[^@\s]+@[^@\s]+\.[^@\s]+$", "date": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$",
    "date-time": r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])[Tt ]([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$",
}
_KINDS = {"string": (T.StringType,), "boolean": (T.BooleanType,), "array": (T.ArrayType,), "object": (T.StructType, T.MapType), "number": (T.NumericType,), "integer": (T.NumericType,), "null": ()}


def _none() -> Column:
    return F.array().cast(_VIOLATIONS)


def _found(where: Column, path: Column, rule: str) -> Column:
    return F.when(where, F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule"))).cast(_VIOLATIONS)).otherwise(_none())


def _under(path: Column, name: str) -> Column:
    return F.when(path == "", F.lit(name)).otherwise(F.concat(path, F.lit(f".{name}")))


class Compiler:
    """A schema's rules as a column; ``$ref`` reaches into the schema itself (#/a/b), as deep as the documents' types go."""

    def __init__(self, schema: dict):
        self.root = schema

    def resolved(self, schema: dict) -> dict:
        seen = set()
        while "$ref" in schema:
            ref = schema["$ref"]
            if ref in seen or not ref.startswith("#/"):
                raise ValueError(f"can't follow {ref}")
            seen.add(ref)
            target = reduce(lambda at, name: at[name.replace("~1", "/").replace("~0", "~")], ref[2:].split("/"), self.root)
            schema = {k: v for k, v in schema.items() if k != "$ref"} | target
        return schema

    def violations(self, c: Column, t: T.DataType, schema: dict | bool, path: Column) -> Column:
        """array<struct<path, rule>> for a value; an absent one, null, has none."""
        if isinstance(schema, bool):
            return _none() if schema else _found(c.isNotNull(), path, "false")
        schema = self.resolved(schema)
        unknown = set(schema) - KEYWORDS
        if unknown:
            raise ValueError(f"unknown rules: {sorted(unknown)}")
        out = []
        kinds = schema.get("type", [])
        kinds = [kinds] if isinstance(kinds, str) else kinds
        if kinds and not any(isinstance(t, _KINDS[k]) for k in kinds):
            return F.when(c.isNotNull(), _found(F.lit(True), path, "type")).otherwise(_none())
        if kinds and isinstance(t, (T.FractionalType, T.DecimalType)) and "integer" in kinds and "number" not in kinds:
            out.append(_found(c != F.floor(c), path, "type"))
        values = [*schema.get("enum", []), *([schema["const"]] if "const" in schema else [])]
        if values:
            fits = [v for v in values if isinstance(v, str) == isinstance(t, T.StringType) and isinstance(v, bool) == isinstance(t, T.BooleanType) and v is not None and not isinstance(v, (list, dict))]
            out.append(_found(~c.isin(fits) if fits else F.lit(True), path, "enum" if "enum" in schema else "const"))
        if isinstance(t, T.StringType):
            out += self._text(c, schema, path)
        elif isinstance(t, T.NumericType):
            for rule, wrong in (("minimum", lambda x: c < x), ("maximum", lambda x: c > x), ("exclusiveMinimum", lambda x: c <= x), ("exclusiveMaximum", lambda x: c >= x), ("multipleOf", lambda x: c % x != 0)):
                if rule in schema:
                    out.append(_found(wrong(F.lit(schema[rule])), path, rule))
        elif isinstance(t, T.ArrayType):
            out += self._list(c, t, schema, path)
        elif isinstance(t, T.StructType):
            out += self._object(c, t, schema, path)
        passes = lambda s: (F.size(self.violations(c, t, s, path)) == 0).cast("int")
        for s in schema.get("allOf", []):
            out.append(self.violations(c, t, s, path))
        if "anyOf" in schema:
            out.append(_found(reduce(Column.__add__, map(passes, schema["anyOf"])) == 0, path, "anyOf"))
        if "oneOf" in schema:
            out.append(_found(reduce(Column.__add__, map(passes, schema["oneOf"])) != 1, path, "oneOf"))
        if "not" in schema:
            out.append(_found(passes(schema["not"]) == 1, path, "not"))
        return F.when(c.isNotNull(), F.concat(*out)).otherwise(_none()) if out else _none()

    def _text(self, c: Column, schema: dict, path: Column) -> list[Column]:
        out = []
        if "minLength" in schema:
            out.append(_found(F.length(c) < schema["minLength"], path, "minLength"))
        if "maxLength" in schema:
            out.append(_found(F.length(c) > schema["maxLength"], path, "maxLength"))
        if "pattern" in schema:
            out.append(_found(~F.rlike(c, F.lit(schema["pattern"])), path, "pattern"))
        if schema.get("format") in FORMATS:
            out.append(_found(~F.rlike(c, F.lit(FORMATS[schema["format"]])), path, "format"))
        return out

    def _list(self, c: Column, t: T.ArrayType, schema: dict, path: Column) -> list[Column]:
        out = []
        if "minItems" in schema:
            out.append(_found(F.size(c) < schema["minItems"], path, "minItems"))
        if "maxItems" in schema:
            out.append(_found(F.size(c) > schema["maxItems"], path, "maxItems"))
        if schema.get("uniqueItems"):
            out.append(_found(F.size(F.array_distinct(c)) < F.size(c), path, "uniqueItems"))
        if "contains" in schema:
            out.append(_found(~F.exists(c, lambda x: x.isNotNull() & (F.size(self.violations(x, t.elementType, schema["contains"], F.lit(""))) == 0)), path, "contains"))
        if "items" in schema:
            at = lambda i: F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
            out.append(F.flatten(F.transform(c, lambda x, i: self.violations(x, t.elementType, schema["items"], at(i)))))
        return out

    def _object(self, c: Column, t: T.StructType, schema: dict, path: Column) -> list[Column]:
        types = {f.name: f.dataType for f in t.fields}
        absent = lambda name: c[name].isNull() if name in types else F.lit(True)
        out = [_found(absent(name), _under(path, name), "required") for name in schema.get("required", [])]
        for name, others in schema.get("dependentRequired", {}).items():
            out += [_found(~absent(name) & absent(o), _under(path, o), "dependentRequired") for o in others]
        properties = schema.get("properties", {})
        out += [self.violations(c[name], types[name], s, _under(path, name)) for name, s in properties.items() if name in types]
        other = schema.get("additionalProperties", True)
        if other is not True:
            out += [self.violations(c[name], types[name], other, _under(path, name)) for name in types if name not in properties]
        return out


def violations(docs: DataFrame, schema: dict, key: str) -> DataFrame:
    """(key, path, rule): a row for each violation of a JSON schema by the documents' columns; a document without any has no row.

    The rules are built-in expressions, so documents are judged where they are read, in one scan. Null fields are absent: required ones are violations, rules on values don't apply. A rule on a type that a column can't have is a ``type`` violation
    of every value. Schemas with keywords that aren't known here are an error, never ignored.
    """
    rows = F.struct(*(F.col(c) for c in docs.columns))
    found = Compiler(schema).violations(rows, docs.schema, schema, F.lit(""))
    return docs.select(F.col(key), F.explode(found).alias("v")).select(key, "v.path", "v.rule")


def verdicts(docs: DataFrame, schema: dict, key: str) -> DataFrame:
    """(key, valid, messages) of each document, its violations in order."""
    found = Compiler(schema).violations(F.struct(*(F.col(c) for c in docs.columns)), docs.schema, schema, F.lit(""))
    return docs.select(key, found.alias("v")).select(key, (F.size("v") == 0).alias("valid"), F.transform(F.array_sort("v"), lambda x: F.concat_ws(": ", x["path"], x["rule"])).alias("messages"))
