"""Listings as a data source, ranges of a database table, validation by a schema, scores kept by a stream, and lists in chunks."""

import json
import re

import pytest

from toolgraph.operators import matching, quality, validation
from toolgraph.sources import readers, service
from toolgraph.streaming import incremental


def test_listing_filters_and_retries(spark, tmp_path):
    entries = [{"id": i, "kind": "ab"[i % 2], "at": i * 2} for i in range(57)]
    log = tmp_path / "log"

    def fetch(page, filters):
        with log.open("a") as out:
            out.write(f"{page} {sorted(filters.items())}\n")
        if page == 2 and log.read_text().count("2 [") < 2:
            raise OSError("try again")
        rows = entries[10 * page - 10 : 10 * page]
        return [e if all(e[k] == v for k, v in filters.items()) else {} for e in rows] or None

    source = service.listing_source(fetch, "id long, kind string, at long", ("kind",), at_once=3, pause=0.01)
    df = service.listing(spark, source)
    assert sorted(tuple(r) for r in df.collect()) == [(e["id"], e["kind"], e["at"]) for e in entries]
    assert sorted(r.id for r in df.where("kind = 'b' and at > 20").select("id").collect()) == [i for i in range(57) if i % 2 and 2 * i > 20]
    assert any("kind" in line for line in log.read_text().splitlines())
    assert service.listing(spark, service.listing_source(lambda page, _: None, "id long")).count() == 0

    def broken(page, filters):
        raise OSError("no answer")

    with pytest.raises(Exception, match="no answer"):
        service.listing(spark, service.listing_source(broken, "id long", attempts=2, pause=0.01)).collect()


def test_stream_offset_finds_the_last_full_page():
    asked = []
    for pages in (0, 1, 2, 5, 64, 1000):
        asked.clear()

        def fetch(page, _, pages=pages):
            asked.append(page)
            return [{"id": 1}] * 10 if page <= pages else [{"id": 1}] * 3 if page == pages + 1 else None

        stream = service.listing_source(fetch, "id long", page_size=10)({}).streamReader(None)
        assert stream.latestOffset() == {"pages": pages} and len(asked) <= 2 + 2 * max(1, pages).bit_length() + 2
        assert stream.latestOffset() == {"pages": pages}
        plan = stream.partitions({"pages": 0}, {"pages": pages})
        assert sorted(p for part in plan for p in range(part.first, part.last + 1, part.step)) == list(range(1, pages + 1))


def test_keys_are_fetched_once_each(spark):
    keys = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "k string")
    cache = spark.createDataFrame([("a", "1"), ("a", "2"), ("z", "9"), ("b", None)], "k string, value string")
    got = sorted((r.k, r.value) for r in readers.fetched(keys, "k", cache, lambda k: f"new {k}").collect())
    assert got == [("a", "2"), ("b", None), ("c", "new c")]


def test_ranges_of_a_table(spark):
    url, how = "jdbc:derby:memory:ranges;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = [(None, "n")] + [(i * i, f"v{i % 3}") for i in range(400)] + [(7, "hot")] * 300
    spark.createDataFrame(rows, "k long, v string").write.option("createTableColumnTypes", "v VARCHAR(8)").jdbc(url, "t", properties=how)
    df = readers.jdbc_ranges(spark, url, "t", '"k"', 8, **how)
    assert sorted(map(repr, (tuple(r) for r in df.collect()))) == sorted(map(repr, rows)) and 3 <= df.rdd.getNumPartitions() <= 8
    sizes = df.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert max(sizes) <= 301 + 701 // 8 + 60
    kept = readers.jdbc_ranges(spark, url, "t", '"k"', 4, 'SELECT "k" FROM t WHERE "v" = \'v1\'', **how).where("v <> 'hot'")
    assert kept.count() == 133 and "PushedFilters: [" in (plan := kept._jdf.queryExecution().toString()) and re.search(r"(NotEqualTo|NOT)", plan.upper().replace("NOTEQUALTO", "NOT"))
    assert readers.jdbc_ranges(spark, url, "t", '"k"', 4, 'SELECT "k" FROM t WHERE "v" = \'none\'', **how).count() == 0


def plain(value, schema, path=""):
    """The rules without Spark, for documents of nested dictionaries in which None is absent."""
    if value is None:
        return []
    out = []
    if isinstance(value, str):
        out += [(path, r) for r, bad in (("minLength", len(value) < schema.get("minLength", 0)), ("maxLength", len(value) > schema.get("maxLength", 10**9)), ("pattern", not re.search(schema.get("pattern", ""), value))) if bad]
    elif isinstance(value, (int, float)):
        out += [(path, r) for r, bad in (("minimum", value < schema.get("minimum", value)), ("maximum", value > schema.get("maximum", value)), ("multipleOf", value % schema.get("multipleOf", 1) != 0 and "multipleOf" in schema)) if bad]
    elif isinstance(value, list):
        texts = [json.dumps(v, sort_keys=True) for v in value]
        out += [(path, r) for r, bad in (("minItems", len(value) < schema.get("minItems", 0)), ("maxItems", len(value) > schema.get("maxItems", 10**9)), ("uniqueItems", schema.get("uniqueItems", False) and len(set(texts)) < len(texts))) if bad]
        for i, v in enumerate(value):
            out += plain(v, schema.get("items", {}), f"{path}[{i}]")
    else:
        out += [(f"{path}.{n}".lstrip("."), "required") for n in schema.get("required", []) if value.get(n) is None]
        for n, s in schema.get("properties", {}).items():
            out += plain(value.get(n), s, f"{path}.{n}".lstrip("."))
    if "enum" in schema and value not in schema["enum"]:
        out.append((path, "enum"))
    for word, fits in (("anyOf", lambda n: n > 0), ("oneOf", lambda n: n == 1)):
        if word in schema and not fits(sum(not plain(value, s, path) for s in schema[word])):
            out.append((path, word))
    return out


def test_validation_is_that_of_a_plain_walk(spark):
    schema = {
        "required": ["id", "name"],
        "properties": {
            "name": {"minLength": 2, "maxLength": 4, "pattern": "^[a-z]+$", "enum": ["abc", "ab", "x", "LONGER"]}, "n": {"minimum": 2, "maximum": 5, "multipleOf": 2},
            "inner": {"required": ["a"], "properties": {"a": {"enum": ["p"]}, "l": {"minItems": 1, "maxItems": 2, "uniqueItems": True, "items": {"required": ["x"], "properties": {"x": {"maximum": 1}}}}}, "oneOf": [{"required": ["a"]}, {"required": ["b"]}]},
        },
        "anyOf": [{"required": ["n"]}, {"properties": {"name": {"enum": ["abc"]}}}],
    }
    kinds = "id long, name string, n double, inner struct<a:string,b:string,l:array<struct<x:int,y:string>>>"
    names, numbers, lists = ["abc", "x", "LONGER", None, "zz1"], [1.0, 4.0, 7.0, None], [None, [], [(1, "q")], [(1, "q"), (1, "q")], [(2, None), None, (None, "r")]]
    rows = [(i, names[i % 5], numbers[i % 4], None if i % 7 == 0 else ("p" if i % 3 else None, "b" if i % 2 else None, lists[i % 5])) for i in range(140)]
    df = spark.createDataFrame(rows, kinds)
    want = {r["id"]: sorted(plain(r.asDict(True), schema)) for r in df.collect()}
    got = {i: [] for i in want}
    for r in validation.violations(df, schema, "id").collect():
        got[r.id].append((r.path, r.rule))
    assert {i: sorted(v) for i, v in got.items()} == want and len({r for v in want.values() for _, r in v}) > 10
    judged = {r.id: r for r in validation.verdicts(df, schema, "id").collect()}
    assert all(judged[i].valid == (not v) and judged[i].messages == [f"{p}: {r}" for p, r in sorted(v)] for i, v in want.items())


def test_validation_edges(spark):
    df = spark.createDataFrame([(1, "x", 1.5, ["a", None])], "id long, s string, d double, l array<string>")
    run = lambda schema: sorted((r.path, r.rule) for r in validation.violations(df, schema, "id").collect())
    assert run({"properties": {"s": {"type": "integer"}, "d": {"type": "integer"}, "l": {"type": "array", "contains": {"const": "b"}}}, "required": ["gone"]}) == [("d", "type"), ("gone", "required"), ("l", "contains"), ("s", "type")]
    assert run({"properties": {"s": {"not": {"minLength": 1}}, "d": False, "id": True}, "additionalProperties": False}) == [("d", "false"), ("l", "false"), ("s", "not")]
    assert run({"dependentRequired": {"s": ["t"]}, "allOf": [{"properties": {"s": {"format": "uri"}}}]}) == [("s", "format"), ("t", "dependentRequired")]
    assert run({}) == [] and validation.violations(df.where("false"), {"required": ["gone"]}, "id").count() == 0
    with pytest.raises(ValueError, match="unknown rules"):
        run({"requiredd": []})
    with pytest.raises(ValueError, match="can't follow"):
        run({"$ref": "#/a", "a": {"$ref": "#/a"}})


def test_a_stream_keeps_its_scores(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for batch in ([("a", "1", 1), ("a", "22", 2), ("b", "x", 1), (None, "n", 1)], [("a", "22", 3), ("b", "yy", 2), ("b", "zzz", 2), ("c", None, 1)], [("a", "1", 9)], [("b", "zzz", 10)]):
            spark.createDataFrame(batch, "k string, content string, t long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            arriving = spark.readStream.schema("k string, content string, t long").parquet(f"{tmp_path}/in")
            scored = incremental.evaluate_changes(arriving, "k", "content", "t", lambda text: {"size": len(text)}, "size long")
            scored.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/check").option("path", f"{tmp_path}/out").trigger(availableNow=True).start().awaitTermination()
        rows = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect())
        assert rows == [("a", 1, 2), ("a", 2, 1), ("b", 1, 1), ("b", 2, 3), ("c", 1, 0)]
        assert sorted(tuple(r) for r in incremental.current(spark.read.parquet(f"{tmp_path}/out"), "k").collect()) == [("a", 2, 1), ("b", 2, 3), ("c", 1, 0)]
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_chunks_of_hot_values(spark):
    rows = [("hot", i % 997) for i in range(3000)] + [("one", 5), ("one", 5), ("none", None), (None, 3), (None, 1)]
    got = quality.chunked(spark.createDataFrame(rows, "k string, i long").repartition(7), "k", "i", 50).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.k or "", r.chunk)):
        by.setdefault(r.k, []).append(r)
    assert set(by) == {"hot", "one", None} and all([r.chunk for r in v] == list(range(len(v))) for v in by.values())
    assert {k: ([x for r in v for x in r["items"]], {r.n for r in v}) for k, v in by.items()} == {"hot": (list(range(997)), {997}), "one": ([5], {1}), None: ([1, 3], {2})}
    assert max(len(r["items"]) for r in got) <= 50 and len(by["hot"]) <= 997 // 50 + 8
    assert quality.chunked(spark.createDataFrame([], "k string, i long"), "k", "i").collect() == []


def test_files_without_partner(spark):
    make = lambda rows: spark.createDataFrame(rows, "file long, method string, value string")
    files = spark.createDataFrame([(i,) for i in range(5)], "file long")
    got = matching.without_partner(make([(0, "a", "x"), (1, "a", "y"), (2, "b", "x"), (3, "a", None)]), make([(9, "a", "x"), (8, "a", "x"), (8, "a", None)]), files)
    assert sorted(r.file for r in got.collect()) == [1, 2, 3, 4]
