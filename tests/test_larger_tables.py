"""What only shows on tables of several partitions, several machines or many files."""

import gc
import subprocess
import sys
import tracemalloc
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from toolgraph import cli
from toolgraph.functions import jsonld, licenses
from toolgraph.operators import components, matching, triples
from toolgraph.plans import catalog, documents, files
from toolgraph.sources import readers, sinks

HERE = str(Path(__file__).resolve().parent.parent)
SF = "/root/testdata/sf0.001"


def test_sitemap_of_a_partition_without_rows(spark, tmp_path):
    rows = spark.createDataFrame([("<url><loc>a</loc></url>",)], "value string").repartition(3)
    files.xml_files(rows, "urlset", f"{tmp_path}/made")
    assert [r.loc for r in readers.sitemap(spark, f"{tmp_path}/made").collect()] == ["a"]
    # a document that is broken off gives no rows of nulls
    (tmp_path / "broken.xml").write_text("<urlset>\n<url><loc>b</loc></url>\n</urlset>\n</urlset>\n")
    (tmp_path / "foot.xml").write_text("</urlset>\n")
    assert [r.loc for r in readers.sitemap(spark, f"{tmp_path}/*.xml").collect()] == ["b"]


@pytest.mark.parametrize("name", ["recipe_triples", "bioconductor_triples", "container_triples", "node_triples", "legacy_node_triples", "triple_property_counts", "convert_packages"])
def test_rows_of_one_file_are_dealt_to_tasks(spark, monkeypatch, name):
    want = sorted(map(str, catalog.QUERIES[name](spark, SF).collect()))
    dealt = []
    monkeypatch.setattr(catalog, "DEALT", 40)
    monkeypatch.setattr(documents, "spread", lambda df: dealt.append(catalog.spread(df)) or dealt[-1])
    assert sorted(map(str, catalog.QUERIES[name](spark, SF).collect())) == want
    if name != "triple_property_counts":
        assert dealt and all(df.rdd.getNumPartitions() == df.count() // 40 + 1 for df in dealt)


def test_licences_are_worked_out_once_for_each_text(spark):
    rows = spark.createDataFrame([("MIT",), ("MIT",), ("nothing",), (None,)], "raw string")
    found = licenses.normalise(rows, "raw")
    assert sorted(((r.raw or "", r.spdx or "") for r in found.collect())) == [("", ""), ("MIT", "MIT"), ("MIT", "MIT"), ("nothing", "")]
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: next(i for i, c in enumerate(line) if c.isalpha())
    for at, line in enumerate(plan):
        if "Aggregate [_raw" in line:  # nothing but the rows' texts feeds the list of distinct ones
            below = [x for i, x in enumerate(plan[at + 1 :]) if all(depth(y) > depth(line) for y in plan[at + 1 : at + 2 + i])]
            assert below and not any("RLIKE" in x or "PythonUDF" in x or "ArrowEval" in x for x in below)


def test_database_is_reached_from_other_processes(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.executor.memory", "1g").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "{tmp_path}").getOrCreate()
import __spark_entry__ as e
print([e.queries()[q](s, "{SF}").count() for q in ("jdbc_table", "jdbc_ranged")])
"""
    ran = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=HERE)
    db = duckdb.connect()
    for t in ("customer", "orders"):
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = [len(db.sql(catalog.ORACLE_SQL[q]).df()) for q in ("jdbc_table", "jdbc_ranged")]
    assert ran.stdout.strip().endswith(str(want)), ran.stderr[-2000:]


def test_pairs_of_a_value_are_dealt_to_tasks(spark, monkeypatch):
    left = [(i, "m", "hot") for i in range(60)] + [(i, "m", "x") for i in range(5)] + [(1, "n", "hot"), (7, "m", None), (7, "m", "hot")]
    right = [(i, "m", "hot") for i in range(40)] + [(i, "m", "x") for i in range(3)] + [(2, "n", "hot"), (8, "m", None)]
    want = sorted({(a, b, m) for a, m, v in left for b, n, w in right if m == n and v == w and v})
    monkeypatch.setattr(matching, "PAIRS", 100)
    a, b = (spark.createDataFrame(x, "file long, method string, value string") for x in (left, right))
    found = matching.edges(a, b)
    assert sorted(map(tuple, found.collect())) == want
    most = max(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect())
    assert most < len(want) / 2  # 2,400 of one value
    assert matching.edges(a.limit(0), b).count() == 0


def test_turtle_files_are_bounded(spark, tmp_path, monkeypatch):
    graph = spark.range(300).selectExpr("concat('http://e.example/', id) s", "'http://schema.org/name' p", "cast(id as string) o", "'literal' o_kind")
    monkeypatch.setattr(sinks, "TURTLE_LINES", 50)
    sinks.turtle(graph.coalesce(1), f"{tmp_path}/t", {"e": "http://e.example/"})
    sizes = [len(f.read_text().splitlines()) for f in (tmp_path / "t").glob("*.txt")]
    assert max(sizes) <= 50 and sum(n - 1 for n in sizes) == 300
    assert readers.turtle(spark, f"{tmp_path}/t/*.txt").exceptAll(graph).count() == 0 and readers.turtle(spark, f"{tmp_path}/t/*.txt").count() == 300


def test_tasks_list_and_read_files(spark, tmp_path, monkeypatch):
    for i, name in enumerate(["a/m.yaml", "b/m.yaml", "c d%/m.yaml", "b/n.json", "b/_hidden.yaml", ".x/m.yaml", "b/[z].yaml", "b/raw.yaml", "b/empty.yaml"]):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes([f"{name}\nö".encode(), b"\xff\xfe"][name == "b/raw.yaml"] * (name != "b/empty.yaml"))
    monkeypatch.setattr(readers, "NAMES", 2)
    monkeypatch.setattr(readers, "FILES", 1)
    raw = F.base64(F.col("value").cast("binary")).alias("value")
    for pattern in ["*/m.yaml", "b", "*/*.yaml", "{a/m,b/n}.*", "[^a]*/?.[jy]*", "b/\\[z\\].yaml", "a/m.yaml"]:
        found = readers.texts(spark, f"{tmp_path}/{pattern}")
        want = spark.read.text(f"{tmp_path}/{pattern}", wholetext=True).select(F.col("_metadata.file_path").alias("path"), raw)
        assert sorted(map(tuple, found.select("path", raw).collect())) == sorted(map(tuple, want.collect())), pattern
        # the driver's plan names the stored list, none of the files
        assert not any(f.endswith((".yaml", ".json")) for f in found.inputFiles())
    assert readers.texts(spark, f"{tmp_path}/*/m.yaml").rdd.getNumPartitions() == 5
    want = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path)).select("path", "length", F.col("modificationTime").cast("string"))
    listed = readers.listing(spark, str(tmp_path)).select("path", "length", F.col("modified").cast("string"))
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, want.collect()))
    assert not any(f.endswith((".yaml", ".json")) for f in listed.inputFiles())
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.texts(spark, f"{tmp_path}/none*")


def test_commands_open_each_file_once(spark, tmp_path, monkeypatch):
    (tmp_path / "a.json").write_text('{"Package": "A", "License": "MIT"}')
    made, convert = [], cli.converter.convert
    monkeypatch.setattr(cli.converter, "convert", lambda *x: made.append(x[0]) or convert(*x))
    assert cli.run(spark, ["convert", f"{tmp_path}/*.json", "--out", f"{tmp_path}/out"]) == 0
    assert made[0].inputFiles() and all(f.endswith(".parquet") for f in made[0].inputFiles())
    assert "MapInArrow" not in made[0]._jdf.queryExecution().optimizedPlan().toString()
    assert [r.license for r in spark.read.parquet(f"{tmp_path}/out/converted").collect()] == ["MIT"]


def test_neighbours_are_joined_before_rounds(spark, tmp_path, monkeypatch):
    left, rounds = [], components._rounds
    monkeypatch.setattr(components, "_rounds", lambda edges, folder: left.append(edges.count()) or rounds(edges, folder))
    monkeypatch.setattr(components, "HELD", 300)
    chains = [(i, i + 1) for i in range(2000) if i % 500 != 499] + [(-3, 1999), (None, 5), (8, 8)]
    found = components.components(spark.createDataFrame(chains, "u long, v long").repartition(4), f"{tmp_path}/a")
    assert {r.node: r.component for r in found.collect()} == {i: i // 500 * 500 if i < 1500 else -3 for i in range(2000)} | {-3: -3}
    assert left[0] < 40  # of 1,997 edges
    # numbers that say nothing of who is linked
    far = [(i * 7919 % 10007, (i + 1) * 7919 % 10007) for i in range(600)]
    found = components.components(spark.createDataFrame(far, "u long, v long").repartition(4), f"{tmp_path}/b")
    assert found.count() == 601 and [r.component for r in found.select("component").distinct().collect()] == [0]


def turtle_document(n: int) -> str:
    return "@prefix e: <http://e.example/> .\n" + "\n".join(f'e:x{i} a e:Thing ; e:size {i} ; e:name "x", "thing {i}"@en ; e:at [ e:in ( e:a "b" ) ] .' for i in range(n))


def test_turtle_documents_leave_nothing_behind():
    text = turtle_document(2_000)
    gc.collect()
    gc.disable()
    try:
        found = list(jsonld.turtle_triples(text))
        assert gc.collect() == 0  # what only a collection would free
        tracemalloc.start()
        before = tracemalloc.get_traced_memory()[0]
        assert sum(1 for _ in jsonld.turtle_triples(text)) == len(found) == 2_000 * 6 + 2_000 * 4
        assert tracemalloc.get_traced_memory()[1] - before < 2 * len(text)  # neither its tokens nor its triples at once
    finally:
        tracemalloc.stop()
        gc.enable()
    assert len(set(found)) == 2_000 * 5 + 1 + 4


def test_triples_of_one_document_are_handed_on_in_batches():
    class Texts:
        def mapInArrow(self, rows, _):
            texts = pa.array(["many", None, "long", "none"])
            return list(rows([pa.RecordBatch.from_arrays([texts], ["t"])]))

    read = {"many": [("s", "p", "o", "iri", None, None)] * 25_000, "long": [("s", "p", "o" * 1_000_000, "literal", None, None)] * 20, "none": []}
    batches = triples._parsed(Texts(), lambda text: iter(read[text]))
    assert sum(len(b) for b in batches) == 25_020 and max(len(b) for b in batches) <= 10_000 and max(b.nbytes for b in batches) < 6_000_000


def test_turtle_files_are_parsed_where_they_are_read(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.ttl").write_text(turtle_document(i + 1))
    found = readers.turtle(spark, f"{tmp_path}/*.ttl", tagged=True)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1  # no text goes through the JVM to another Python process
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, set(jsonld.turtle_triples(turtle_document(3)))))
