"""Registered queries that go through files: tables written by the sinks into a folder of their own, and read back by the readers."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import packages, quality, storage, triples
from ..sources import readers, service, sinks, versions
from ..streaming import incremental
from .catalog import Tables, query


def workspace(spark: SparkSession) -> str:
    return storage.workspace(spark, "files")


def written(t: Tables, df: DataFrame, path, document, form: str = "json") -> str:
    """The folder that holds one file a record."""
    folder = workspace(t._spark)
    sinks.record_files(df, folder, path, document, form)
    return folder


def xml_files(rows: DataFrame, root: str, folder: str) -> None:
    """Documents of its rows (value) between the root's tags, one for each partition."""

    def wrapped(batches):
        import pyarrow as pa

        head, foot = (pa.RecordBatch.from_arrays([pa.array([x])], ["value"]) for x in (f"<{root}>", f"</{root.split(' ')[0]}>"))
        yield head  # a partition without rows is a document too
        yield from batches
        yield foot

    rows.mapInArrow(wrapped, "value string").write.text(folder)


def supplier_files(t: Tables, form: str) -> str:
    doc = F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.struct(F.col("s_name").alias("name"), F.array("s_nationkey").alias("nations")).alias("about")))
    return written(t, t.supplier, F.concat(F.lit("t"), "s_suppkey", F.lit("/t"), "s_suppkey", F.lit(f".{form}")), doc, form)


_FILES = "SELECT s_suppkey AS id, 't' || s_suppkey AS folder, s_name AS name, s_nationkey AS nation FROM supplier"


def read_back(docs: DataFrame) -> DataFrame:
    at = lambda path, kind: F.variant_get("doc", path, kind)
    return docs.select(at("$.id", "long").alias("id"), F.element_at(F.split("path", "/"), -2).alias("folder"), at("$.about.name", "string").alias("name"), at("$.about.nations[0]", "int").alias("nation"))


@query(_FILES)
def json_files(t):
    return read_back(readers.json_documents(t._spark, f"{supplier_files(t, 'json')}/*/*.json")[0])


@query(_FILES)
def yaml_files(t):
    return read_back(readers.yaml_documents(t._spark, f"{supplier_files(t, 'yaml')}/*/*.yaml")[0])


@query("SELECT 't' || s_suppkey AS folder, 't' || s_suppkey || '.json' AS name, true AS filled FROM supplier")
def listed_files(t):
    return readers.listing(t._spark, supplier_files(t, "json")).select("folder", "name", (F.col("length") > 0).alias("filled"))


@query("SELECT n_name AS key, n_nationkey AS id FROM nation")
def keyed_json_file(t):
    folder = workspace(t._spark)
    one = t.nation.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("n_name", F.struct(F.col("n_nationkey").alias("id"))))))).alias("value"))
    one.write.text(folder)
    return readers.keyed_json(t._spark, f"{folder}/*.txt").select("key", F.variant_get("doc", "$.id", "int").alias("id"))


@query("SELECT n_name AS key, n_nationkey AS id FROM nation")
def keyed_yaml_file(t):
    folder = workspace(t._spark)
    one = t.nation.agg(F.array_join(F.array_sort(F.collect_list(F.concat("n_name", F.lit(": "), "n_nationkey"))), "\n").alias("value"))
    one.write.text(folder)
    return readers.keyed_yaml(t._spark, f"{folder}/*.txt").select("key", F.variant_get("doc", "$", "int").alias("id"))


@query("SELECT p_partkey AS key, p_brand AS brand, '[\"' || p_name || '\"]' AS names FROM part")
def csv_files(t):
    folder = workspace(t._spark)
    sinks.csv(t.part.select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("brand"), F.array("p_name").alias("names")), folder)
    return readers.fair_scores(t._spark, folder, "key long, brand string, names string")


@query("SELECT replace(n_name, '_', ' ') AS name, 'http://n/' || n_nationkey AS url FROM nation")
def tab_separated_servers(t):
    folder = workspace(t._spark)
    t.nation.select(F.replace("n_name", F.lit("_"), F.lit(" ")).alias("name"), F.concat(F.lit("http://n/"), "n_nationkey").alias("url")).write.csv(folder, sep="\t", header=True)
    return readers.server_table(t._spark, folder).select(F.replace("name", F.lit("_"), F.lit(" ")).alias("name"), "url")


@query("SELECT url AS loc, CASE WHEN page_id % 2 = 0 THEN '2024-01-01' END AS lastmod FROM pages")
def sitemap_files(t):
    folder = workspace(t._spark)
    mod = F.when(F.col("page_id") % 2 == 0, "<lastmod>2024-01-01</lastmod>").otherwise("")
    loc = F.replace(F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    # as several files, of which some give the namespace a prefix
    for prefix, rest in (("", 0), ("sm:", 1)):
        of = lambda text, prefix=prefix: F.regexp_replace(text, "<(/?)", f"<$1{prefix}")
        row = F.concat(of(F.lit("<url><loc>")), loc, of(F.concat(F.lit("</loc>"), mod, F.lit("</url>"))))
        xml_files(t.pages.where(F.col("page_id") % 3 % 2 == rest).select(row.alias("value")), f'{prefix}urlset xmlns{":" * bool(prefix)}{prefix[:-1]}="http://www.sitemaps.org/schemas/sitemap/0.9"', f"{folder}/{rest}")
    return readers.sitemap(t._spark, f"{folder}/*")


@query("SELECT CASE o_orderkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'M' ELSE 'D' END AS status, count(*) AS n FROM orders GROUP BY 1")
def diff_lines(t):
    folder = workspace(t._spark)
    line = F.concat(F.element_at(F.array(F.lit("A"), F.lit("M"), F.lit("D")), (F.col("o_orderkey") % 3 + 1).cast("int")), F.lit("\tdata/"), "o_orderkey")
    t.orders.select(line.alias("value")).write.text(folder)
    return readers.git_diff(t._spark, folder).groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT 'https://e.example/' || p_partkey || '.json' AS url FROM part")
def manifest_urls(t):
    folder = workspace(t._spark)
    sinks.lines(t.part.select(F.concat(F.lit("../../content/data/"), "p_partkey", F.lit(".json")).alias("value")), folder)
    return readers.url_list(t._spark, folder, "../../content/data/", "https://e.example/")


@query(f"SELECT 'urn:supplier:' || s_suppkey AS s, '{triples.SC}name' AS p, s_name AS o, 'literal' AS o_kind FROM supplier")
def jsonld_files(t):
    folder = workspace(t._spark)
    g = triples.triples(t.supplier, F.concat(F.lit("urn:supplier:"), "s_suppkey"), [triples.Rule(triples.SC + "name", F.col("s_name"))])
    sinks.record_files(triples.jsonld(g), folder, F.concat(F.sha2("s", 256), F.lit(".jsonld")), F.col("value"))
    return readers.jsonld(t._spark, f"{folder}/*.jsonld")


_E, _XSD = "http://e.example/", "http://www.w3.org/2001/XMLSchema#"
_TYPED = f"""SELECT '{_E}part/' || p_partkey AS s, '{triples.TYPE}' AS p, '{triples.SC}Product' AS o, 'iri' AS o_kind, NULL AS lang, NULL AS datatype FROM part
UNION ALL SELECT '{_E}part/' || p_partkey, '{triples.SC}name', 'a "' || p_name || '"' || chr(10) || '\\x', 'literal', CASE WHEN p_partkey % 3 = 0 THEN 'en' WHEN p_partkey % 3 = 1 THEN 'de-AT' END, NULL FROM part
UNION ALL SELECT '{_E}part/' || p_partkey, '{triples.SC}size', p_size::VARCHAR, 'literal', NULL, '{_XSD}integer' FROM part
UNION ALL SELECT '{_E}part/' || p_partkey, '{_E}brand', '{_E}brand/' || replace(p_brand, '#', '.'), 'iri', NULL, NULL FROM part
UNION ALL SELECT '{_E}part/' || p_partkey, '{_E}brand', p_brand, 'literal', NULL, NULL FROM part
UNION ALL SELECT 'urn:supplier:' || s_suppkey, '{triples.SC}name', s_name, 'literal', NULL, NULL FROM supplier
UNION ALL SELECT 'urn:supplier:' || s_suppkey, '{triples.DCT}relation', '{_E}part/' || s_suppkey, 'iri', NULL, NULL FROM supplier
UNION ALL SELECT 'urn:supplier:' || s_suppkey, '{triples.DCT}relation', '{_E}part/' || (s_suppkey + 1), 'iri', NULL, NULL FROM supplier"""


def typed_graph(t: Tables) -> DataFrame:
    """Parts and suppliers with classes, links, quotes, languages and numbers, and a property that has both a link and a text."""
    part, supplier = F.concat(F.lit(f"{_E}part/"), "p_partkey"), F.concat(F.lit("urn:supplier:"), "s_suppkey")
    none = F.lit(None).cast("string")

    def facts(df, s, p, o, kind="literal", lang=none, datatype=none):
        return df.select(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), lang.alias("lang"), datatype.alias("datatype"))

    tongue = F.when(F.col("p_partkey") % 3 == 0, "en").when(F.col("p_partkey") % 3 == 1, "de-AT")
    return reduce(DataFrame.unionByName, [
        facts(t.part, part, triples.TYPE, F.lit(triples.SC + "Product"), "iri"), facts(t.part, part, triples.SC + "name", F.concat(F.lit('a "'), "p_name", F.lit('"\n\\x')), lang=tongue),
        facts(t.part, part, triples.SC + "size", F.col("p_size").cast("string"), datatype=F.lit(_XSD + "integer")), facts(t.part, part, _E + "brand", F.concat(F.lit(_E + "brand/"), F.replace("p_brand", F.lit("#"), F.lit("."))), "iri"),
        facts(t.part, part, _E + "brand", F.col("p_brand")), facts(t.supplier, supplier, triples.SC + "name", F.col("s_name")),
        facts(t.supplier, supplier, triples.DCT + "relation", F.concat(F.lit(_E + "part/"), "s_suppkey"), "iri"), facts(t.supplier, supplier, triples.DCT + "relation", F.concat(F.lit(_E + "part/"), F.col("s_suppkey") + 1), "iri"),
    ])


_CONTEXT = {"@vocab": triples.SC, "e": _E, "dct": triples.DCT, "xsd": _XSD, "size": {"@id": triples.SC + "size", "@type": "xsd:integer"}, "relation": {"@id": "dct:relation", "@type": "@id"}, "brandName": "e:brand"}


@query(_TYPED)
def compact_documents(t):
    """Compacted JSON-LD, read back by its own context."""
    docs = triples.compact(typed_graph(t), _CONTEXT).select(F.parse_json("value").alias("doc"))
    return triples.from_jsonld(docs, {}, None, tagged=True)


@query(f"SELECT '{_E}part/' || p_partkey AS s, 'e:part/' || p_partkey AS id, 'Product' AS class, p_size::VARCHAR AS size, p_brand AS brand FROM part")
def compact_terms(t):
    """The names that compaction chose: a prefix for the subject, the vocabulary's class, a term that carries the datatype."""
    docs = triples.compact(typed_graph(t), _CONTEXT).where(F.contains("s", F.lit("part/"))).select("s", F.parse_json("value").alias("d"))
    at = lambda path: F.variant_get("d", path, "string")
    return docs.select("s", at("$['@id']").alias("id"), at("$['@type']").alias("class"), at("$.size").alias("size"), at("$.brandName[0]").alias("brand"))


@query(_TYPED)
def turtle_files(t):
    """Turtle, written and read back."""
    folder = workspace(t._spark)
    sinks.turtle(typed_graph(t), folder, {"e": _E, "schema": triples.SC, "xsd": _XSD})
    return readers.turtle(t._spark, f"{folder}/*.txt", tagged=True)


_BLANK = "CASE WHEN s LIKE 'urn:blank:%' THEN 'blank' ELSE s END"


@query(f"""WITH n AS (SELECT '{_E}s' || s_suppkey AS s, s_name, '{_E}n' || s_nationkey AS nation, 'City' || (s_suppkey % 7) AS city, s_nationkey FROM supplier)
SELECT s, '{triples.SC}name' AS p, s_name AS o FROM n UNION ALL SELECT s, '{triples.SC}nationality', nation FROM n UNION SELECT nation, '{triples.SC}name', 'Nation ' || s_nationkey FROM n UNION ALL SELECT s, '{triples.SC}address', 'blank' FROM n
UNION SELECT 'blank', '{triples.SC}addressLocality', city FROM n UNION ALL SELECT s, 'city', city FROM n""")
def nested_documents(t):
    """JSON-LD with a context, a nested node that has a name and one that hasn't, and which city each blank address leads to."""
    context = F.lit(json.dumps({"nm": triples.SC + "name", "sc": triples.SC, "lives": {"@id": "sc:address"}, "from": {"@id": "sc:nationality", "@type": "@id"}, "city": "sc:addressLocality"}))
    doc = F.concat(
        F.lit('{"@context":'), context, F.lit(f',"@id":"{_E}s'), "s_suppkey", F.lit('","nm":"'), "s_name", F.lit(f'","from":{{"@id":"{_E}n'), "s_nationkey", F.lit('","nm":"Nation '), "s_nationkey",
        F.lit('"},"lives":{"city":"City'), F.col("s_suppkey") % 7, F.lit('"},"unknown":"gone"}'),
    )
    g = triples.from_jsonld(t.supplier.select(F.parse_json(doc).alias("doc")), {}, None)
    shown = lambda c: F.when(F.startswith(c, F.lit("urn:blank:")), "blank").otherwise(F.col(c)).alias(c)
    cities = g.where(F.col("p") == triples.SC + "address").select("s", F.col("o").alias("b")).join(g.where(F.col("p") == triples.SC + "addressLocality").select(F.col("s").alias("b"), "o"), "b").select("s", F.lit("city").alias("p"), "o")
    return g.select(shown("s"), "p", shown("o")).distinct().unionByName(cities)


@query("SELECT 'http://edamontology.org/topic_' || p_partkey AS entity, p_name AS label FROM part UNION ALL SELECT 'http://edamontology.org/topic_' || p_partkey, upper(p_name) FROM part WHERE p_partkey % 3 = 0")
def ontology_file(t):
    """Classes of which every third has two labels, one with a language."""
    folder = workspace(t._spark)
    second = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('<rdfs:label xml:lang="en">'), F.upper("p_name"), F.lit("</rdfs:label>"))).otherwise("")
    row = F.concat(F.lit('<owl:Class rdf:about="http://edamontology.org/topic_'), "p_partkey", F.lit('"><rdfs:label>'), "p_name", F.lit("</rdfs:label>"), second, F.lit("</owl:Class>"))
    xml_files(t.part.select(row.alias("value")), 'rdf:RDF xmlns:rdf="r" xmlns:rdfs="s" xmlns:owl="o"', folder)
    return readers.ontology(t._spark, folder).select("entity", "label")


PAGE = 50


def listed_pages(t: Tables, rows: DataFrame, folder: str) -> None:
    """A listing's dump: pages of up to PAGE entries (part, part's name and brand), a file each, by the key."""
    page = F.floor(F.col("p_partkey") / PAGE) + 1
    pages = rows.groupBy(page.alias("page")).agg(F.to_json(F.sort_array(F.collect_list(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))))).alias("doc"))
    sinks.record_files(pages, folder, F.concat(F.lit("page-"), "page", F.lit(".json")), F.col("doc"), "text")


def dumped(address: str):
    """The service that answers from a dump; it fails on the first request for every seventh page of a task."""
    seen = set()

    def fetch(page: int, filters: dict) -> list[dict] | None:
        from pyarrow import fs

        if page % 7 == 0 and page not in seen:
            seen.add(page)
            raise OSError("try again")
        store, base = fs.FileSystem.from_uri(address)
        name = f"{base}/page-{page}.json"
        if store.get_file_info(name).type != fs.FileType.File:
            return None
        entries = json.loads(store.open_input_stream(name).read())
        # an entry that doesn't fit leaves its place, so that a page isn't taken for the end
        return [e if all(e[k] == v for k, v in filters.items()) else {} for e in entries]

    return fetch


@query("SELECT p_partkey AS id, p_name AS name FROM part")
def paged_listing(t):
    folder = workspace(t._spark)
    listed_pages(t, t.part, folder)
    fetch = dumped(sinks.address(t._spark, folder))
    return service.listing(t._spark, service.listing_source(fetch, "id long, name string", at_once=6, pause=0.01))


@query("SELECT p_partkey AS id, p_brand AS brand FROM part WHERE p_brand = 'Brand#13' AND p_partkey > 7")
def selected_listing(t):
    """A filter that the service takes, and one that Spark keeps."""
    folder = workspace(t._spark)
    listed_pages(t, t.part, folder)
    source = service.listing_source(dumped(sinks.address(t._spark, folder)), "id long, name string, brand string", ("brand",), at_once=6, pause=0.01)
    return service.listing(t._spark, source).where("brand = 'Brand#13' and id > 7").select("id", "brand")


@query(f"SELECT p_partkey AS id, p_name AS name FROM part WHERE p_partkey < (SELECT (max(p_partkey) + 1) // {PAGE} * {PAGE} FROM part)")
def streamed_listing(t):
    """The complete pages as a stream that is stopped when half of them are there, and started again."""
    spark, folder = t._spark, workspace(t._spark)
    source = service.listing_source(dumped(sinks.address(spark, f"{folder}/dump")), "id long, name string", at_once=4, page_size=PAGE, pause=0.01)
    half = F.col("p_partkey") < t.part.agg(F.max("p_partkey")).first()[0] // 2 // PAGE * PAGE
    for rows in (t.part.where(half), t.part.where(~half)):
        listed_pages(t, rows, f"{folder}/dump")
        stream = service.listing_stream(spark, source).writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/out").trigger(availableNow=True).start()
        stream.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query("SELECT c_custkey::VARCHAR AS pmid, CASE WHEN c_custkey % 3 = 0 THEN 'cached' ELSE '10.1/' || c_custkey END AS value FROM customer")
def fetched_with_cache(t):
    keys = t.customer.select(F.col("c_custkey").cast("string").alias("pmid"))
    cache = keys.where("cast(pmid as long) % 3 = 0").withColumn("value", F.lit("cached"))
    return readers.fetched(keys, "pmid", cache, lambda k: f"10.1/{k}")


@query("SELECT url, CASE WHEN length(url) % 2 = 0 THEN max(CASE WHEN page_id % 2 = 0 THEN '200' ELSE '404' END) = '200' ELSE length(url) % 4 <> 1 END AS ok FROM pages GROUP BY url")
def url_checks(t):
    """Half of the addresses are cached; the others are probed, of which some don't answer."""
    cache = t.pages.where("length(url) % 2 = 0").select("url", F.when(F.col("page_id") % 2 == 0, "200").otherwise("404").alias("value"))

    def probe(url: str) -> int:
        if len(url) % 4 == 1:
            raise OSError("no answer")
        return 200

    return readers.url_statuses(t.pages.select("url"), cache, probe)


@query(f"SELECT s_suppkey::VARCHAR AS s, '{triples.SC}name' AS p, s_name AS o FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey::VARCHAR, '{triples.SC}url', s_suppkey::VARCHAR FROM supplier WHERE s_suppkey % 4 = 1")
def fetched_graph_names(t):
    """Graphs of which half are cached; of the others every second is fetched, and the rest fail or aren't JSON."""
    url = F.col("s_suppkey").cast("string")
    cache = t.supplier.where("s_suppkey % 2 = 0").select(url.alias("url"), F.to_json(F.struct(url.alias("@id"), F.col("s_name").alias("name"))).alias("value"))

    def fetch(key: str) -> str:
        if int(key) % 4 == 1:
            return json.dumps({"@id": key, "url": key})
        if int(key) % 8 == 3:
            raise OSError("no answer")
        return "<html>"

    return readers.fetched_graphs(t.supplier.select(url.alias("url")), cache, fetch).select("s", "p", "o")


@query("""WITH c AS (SELECT page_id, 1 AS turn, html FROM pages WHERE page_id % 5 <> 0 UNION ALL SELECT page_id, 2, CASE WHEN page_id % 3 = 0 THEN html || 'changed' ELSE html END FROM pages)
SELECT page_id, count(DISTINCT html) AS version, length(arg_max(html, turn)) AS size FROM c GROUP BY 1""")
def scores_as_a_stream(t):
    """Pages scored as they arrive, in two runs of one stream: the second brings all again, of which some are new and some have changed. How often each was scored, and its last score."""
    spark, folder = t._spark, workspace(t._spark)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for turn, html in ((1, F.when(F.col("page_id") % 5 != 0, F.col("html"))), (2, F.when(F.col("page_id") % 3 == 0, F.concat("html", F.lit("changed"))).otherwise(F.col("html")))):
            t.pages.select("page_id", html.alias("html"), F.lit(turn).alias("turn")).where("html is not null").write.mode("append").parquet(f"{folder}/in")
            arriving = spark.readStream.schema("page_id long, html string, turn int").parquet(f"{folder}/in")
            scored = incremental.evaluate_changes(arriving, "page_id", "html", "turn", lambda text: {"size": len(text)}, "size long")
            scored.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/out").trigger(availableNow=True).start().awaitTermination()
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return incremental.current(spark.read.parquet(f"{folder}/out"), "page_id")


@query("SELECT l_returnflag AS source, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 UNION ALL SELECT 'A', count(*) FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber = 1")
def refreshed_partitions(t):
    """A full load, then a refresh of two sources of which one has fewer records now and the other none."""
    folder = workspace(t._spark)
    load = t.lineitem.select(F.col("l_returnflag").alias("source"), "l_orderkey", "l_linenumber")
    sinks.bronze(load, folder)
    sinks.bronze(load.where("source = 'A' and l_linenumber = 1"), folder, ["A", "N"])
    return versions.read(t._spark, folder).groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT c_mktsegment AS source, count(*) AS imported, count(*) FILTER (EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS linked FROM customer GROUP BY 1")
def dual_sink(t):
    folder = workspace(t._spark)
    records = t.customer.select(F.col("c_mktsegment").alias("source"), F.concat(F.lit("T"), "c_custkey").alias("tool"))
    sinks.dual(records, t.orders.select(F.concat(F.lit("t"), "o_custkey").alias("tool")), "tool", f"{folder}/imports", f"{folder}/data")
    counted = lambda part, name: versions.read(t._spark, f"{folder}/{part}").groupBy("source").agg(F.count("*").alias(name))
    return counted("imports", "imported").join(counted("data", "linked"), "source", "left").select("source", "imported", F.coalesce("linked", F.lit(0)).alias("linked"))


@query("SELECT o_orderkey % 2 = 0 AS kept, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1")
def stale_removed(t):
    """A table cleaned in place: read and rewritten in one step."""
    folder = workspace(t._spark)
    versions.commit(t.orders.select("o_orderkey"), folder)
    versions.without_stale(t._spark, folder, t.orders.where("o_orderkey % 2 = 0"), "o_orderkey")
    return versions.read(t._spark, folder).groupBy((F.col("o_orderkey") % 2 == 0).alias("kept")).agg(F.count("*").alias("n"))


@query("SELECT 1 AS version, c_mktsegment, count(*) AS n FROM customer GROUP BY 2 UNION ALL SELECT 2, c_mktsegment, count(*) FROM customer WHERE c_acctbal > 0 GROUP BY 2 UNION ALL SELECT 3, c_mktsegment, count(*) FROM customer GROUP BY 2")
def restored_versions(t):
    """Three versions of a table: loaded, reduced, and the first again."""
    folder = workspace(t._spark)
    load = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    first = versions.commit(load, folder, "c_mktsegment")
    versions.commit(versions.read(t._spark, folder).where("c_acctbal > 0"), folder, "c_mktsegment", since=first)
    versions.restore(t._spark, folder, first)
    rows = [versions.read(t._spark, folder, n).select(F.lit(n).alias("version"), "c_mktsegment") for n in versions.numbers(t._spark, folder)]
    return reduce(DataFrame.unionByName, rows).groupBy("version", "c_mktsegment").agg(F.count("*").alias("n"))


_RELEASES = [("sid", 3), ("bookworm", 2), ("experimental", 4)]
#: Versions in their order.
_VERSIONS = ["0.9-1", "1.0~beta1-1", "1.0~rc1-2", "1.0-1", "1.0-1.1", "1.0-2", "1.0-10", "1.0+dfsg-1", "1.0+dfsg1-1", "1.0.1-1", "1.2-1", "1.10-1", "1.10-alpha-3", "1:0.5-1", "2:0.1~a-1"]
_VERSION = f"[{', '.join(map(repr, _VERSIONS))}][1 + (l_linenumber * 3 + l_suppkey + l_partkey) % {len(_VERSIONS)}]"
_RANK = "list_position([" + ", ".join(map(repr, _VERSIONS)) + "], version)"
_PACKAGES = f"""SELECT DISTINCT 'p' || (l_partkey % 200) AS package, {_VERSION} || CASE WHEN l_orderkey % 2 = 0 THEN '+b2' ELSE '' END AS version,
CASE l_returnflag WHEN 'A' THEN 'sid' WHEN 'N' THEN CASE WHEN l_partkey % 200 = 7 THEN 'experimental' ELSE 'bookworm' END ELSE 'experimental' END AS release, 's' || (l_partkey % 200 % 50) AS source, 'main' AS component, 'http://h' AS homepage, 'MIT' AS license, 'med' AS blend FROM lineitem"""


@query(f"""WITH own AS (SELECT DISTINCT package, regexp_replace(version, '\\+b[0-9]+$', '') AS version, release, source, component, homepage, license, blend FROM ({_PACKAGES}) WHERE CAST(substr(package, 2) AS INT) % 3 <> 0),
latest AS (SELECT package, coalesce(arg_max(version, {_RANK}) FILTER (release <> 'experimental'), arg_max(version, {_RANK})) AS version FROM own GROUP BY 1),
picked AS (SELECT package, version, arg_max(release, CASE release WHEN 'sid' THEN 3 WHEN 'bookworm' THEN 2 ELSE 4 END) AS release FROM own JOIN latest USING (package, version) GROUP BY 1, 2),
found AS (SELECT own.package, own.version, own.release, own.source FROM own JOIN picked USING (package, version, release) UNION SELECT 'pro' || s_suppkey, '0.' || s_nationkey || '-3', 'vcs', 'sp' || s_suppkey FROM supplier),
tags AS (SELECT 'p' || p_partkey AS package, count(*) AS n FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) FROM part) GROUP BY 1)
SELECT found.package, regexp_replace(regexp_replace(version, '-[.\\d]+$', ''), '\\+dfsg.*$', '') AS version, release, source, coalesce(tags.n, 0) AS n_tags, CASE WHEN CAST(regexp_replace(source, '[a-z]+', '') AS INT) % 2 = 0 AND release <> 'vcs' THEN 'doi:10/' || source ELSE '' END AS bib,
CASE WHEN source = 's4' THEN 't' ELSE '' END AS topic FROM found LEFT JOIN tags ON found.package = tags.package""")
def package_catalogue(t):
    """The whole import query: reduced, latest version and release, prospective packages, ontology terms, citations and tags."""
    spark, own = t._spark, t.lineitem.selectExpr(
        "'p' || (l_partkey % 200) package", f"array({', '.join(map(repr, _VERSIONS))})[cast((l_linenumber * 3 + l_suppkey + l_partkey) % {len(_VERSIONS)} as int)] || CASE WHEN l_orderkey % 2 = 0 THEN '+b2' ELSE '' END version",
        "CASE l_returnflag WHEN 'A' THEN 'sid' WHEN 'N' THEN CASE WHEN l_partkey % 200 = 7 THEN 'experimental' ELSE 'bookworm' END ELSE 'experimental' END release", "'s' || (l_partkey % 200 % 50) source", "'main' component",
        "'http://h' homepage", "'MIT' license", "'med' blend",
    ).distinct()
    source = own.select("source").distinct()
    tables = {
        "packages": own, "releases": spark.createDataFrame(_RELEASES, "release string, sort int"), "blends_dependencies": own.where("cast(substr(package, 2) as int) % 3 <> 0").select("package", "blend"),
        "blends_prospectivepackages": t.supplier.selectExpr("'pro' || s_suppkey package", "'main' component", "'0.' || s_nationkey || '-3' chlog_version", "'sp' || s_suppkey source", "'http://h' homepage", "'MIT' license", "'med' blend"),
        "edam": own.where("source = 's4'").select("source", "package").distinct().withColumn("topics", F.array(F.lit("t"))), "bibref": source.where("cast(substr(source, 2) as int) % 2 = 0").select("source", F.lit("doi").alias("key"), F.lit("x").alias("package"), F.lit(0).alias("rank"), F.concat(F.lit("10/"), "source").alias("value")),
        "registry": source.select("source", F.lit("bio.tools").alias("name"), F.col("source").alias("entry")), "debtags": t.part.select(F.concat(F.lit("p"), "p_partkey").alias("package"), F.explode(F.split("p_name", " ")).alias("tag")),
    }
    out = packages.catalogue(tables)
    return out.select(
        "package", "version", "release", "source", F.coalesce(F.size("tags"), F.lit(0)).cast("bigint").alias("n_tags"), F.array_join(F.coalesce(F.transform("bib", lambda b: F.concat_ws(":", b["key"], b["value"])), F.array().cast("array<string>")), ",").alias("bib"),
        F.coalesce(F.get("topics", F.lit(0)), F.lit("")).alias("topic"),
    ).withColumn("n_tags", F.greatest("n_tags", F.lit(0)))


@query(f"SELECT l_partkey, l_linenumber, count(*) AS n, arg_max(version, {_RANK}) AS version FROM (SELECT *, {_VERSION} AS version FROM lineitem) GROUP BY 1, 2")
def greatest_versions(t):
    """The greatest of the versions with suffixes, pre-releases, revisions and epochs that a group of rows has."""
    rows = t.lineitem.select("l_partkey", "l_linenumber", F.expr(f"array({', '.join(map(repr, _VERSIONS))})[cast((l_linenumber * 3 + l_suppkey + l_partkey) % {len(_VERSIONS)} as int)]").alias("version"))
    return rows.groupBy("l_partkey", "l_linenumber").agg(F.count("*").alias("n"), F.max_by("version", text.debian_sort_key(F.col("version"))).alias("version"))


@query("SELECT event_type AS metric, count(*) AS n, round(avg(CASE WHEN value > 100 THEN 1.0 ELSE 0.0 END), 6) AS share FROM events GROUP BY 1")
def metric_shares(t):
    e = t.events.select(F.col("event_type").alias("metric"), F.when(F.col("value") > 100, 1.0).otherwise(0.0).alias("high"))
    return e.groupBy("metric").agg(F.count("*").alias("n"), F.round(F.avg("high"), 6).alias("share"))


@query("SELECT page_id, 'https://doi.org/10.1/%5B' || page_id || '%5D' AS doi, '10.1/[' || page_id || ']' AS clean FROM pages")
def doi_addresses(t):
    raw = F.concat(F.lit("doi:10.1/["), "page_id", F.lit("]"))
    return t.pages.select("page_id", F.concat(F.lit("https://doi.org/"), text.percent_escape_doi(text.clean_doi(raw))).alias("doi"), text.clean_doi(raw).alias("clean"))


@query("""WITH c AS (SELECT "F", "O", "P", count(*) AS n FROM (SELECT o_custkey, bool_or(o_orderstatus = 'F') AS "F", bool_or(o_orderstatus = 'O') AS "O", bool_or(o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1) GROUP BY 1, 2, 3)
SELECT '| F | O | P | n |' AS line UNION ALL SELECT '| --- | --- | --- | --- |' UNION ALL SELECT '| ' || CASE WHEN "F" THEN '✓' ELSE '' END || ' | ' || CASE WHEN "O" THEN '✓' ELSE '' END || ' | ' || CASE WHEN "P" THEN '✓' ELSE '' END || ' | ' || n || ' |' FROM c""")
def coverage_report(t):
    found = quality.coverage(t.orders.select(F.col("o_custkey").alias("tool_id"), F.col("o_orderstatus").alias("source")), ["F", "O", "P"])
    return t._spark.createDataFrame([(x,) for x in sinks.markdown(found).splitlines()], "line string")


_RECIPE = """{%- set name = "NAME" %}{% set version = "1.KEY.SIZE" %}{% set major, rest = version.split(".")[0], version.split(".")[1:] %}
{% set brands = ["BRAND", "", "z"] %}
package:
  name: {{ name|lower|replace(" ", "-") }}
  version: "{{ version }}"
source:
  - url: https://e.example/{{ name[0]|lower }}/{{ name|lower|replace(" ", "-") }}/{{ major ~ "." ~ rest|join("_") }}.tar.gz
requirements:
  host:
    - {{ compiler("c") }}
{%- for b in brands if b %}
    - {{ b }}{{ "  # [linux]" if loop.first }}
{%- else %}
    - none
{%- endfor %}
about:
  summary: {% if SIZE is even and not missing %}even{% elif SIZE > 25 %}large{% else %}{{ missing|default("odd") }}{% endif %}
  home: {{ os.environ.get("HOME") }}
"""


@query("""SELECT replace(lower(p_name), ' ', '-') AS name, '1.' || p_partkey || '.' || p_size AS version, 'https://e.example/' || lower(p_name[1]) || '/' || replace(lower(p_name), ' ', '-') || '/1.' || p_partkey || '_' || p_size || '.tar.gz' AS url,
  CASE WHEN p_size % 2 = 0 THEN 'even' WHEN p_size > 25 THEN 'large' ELSE 'odd' END AS summary, replace(p_brand, '#', '') || ',z' AS host FROM part""")
def recipe_files(t):
    """Recipes with sets, loops, tests, slices and calls of the build system, a file for each part."""
    recipe = F.lit(_RECIPE)
    for mark, value in (("NAME", F.col("p_name")), ("KEY", F.col("p_partkey").cast("string")), ("SIZE", F.col("p_size").cast("string")), ("BRAND", F.replace("p_brand", F.lit("#"), F.lit("")))):
        recipe = F.replace(recipe, F.lit(mark), value)
    folder = written(t, t.part.withColumn("recipe", recipe), F.concat("p_partkey", F.lit("/meta.yaml")), F.col("recipe"), "text")
    docs = readers.yaml_documents(t._spark, f"{folder}/*/meta.yaml", templated=True)[0]
    at = lambda path, kind="string": F.try_variant_get("doc", path, kind)
    host = F.array_join(F.filter(at("$.requirements.host", "array<string>"), lambda x: x.isNotNull()), ",")
    return docs.select(at("$.package.name").alias("name"), at("$.package.version").alias("version"), at("$.source[0].url").alias("url"), at("$.about.summary").alias("summary"), host.alias("host"))


@query("SELECT 'Pkg' || s_suppkey AS package, '10.1/' || s_suppkey AS doi FROM supplier")
def citation_files(t):
    html = F.concat(F.lit("<a href='https://doi.org/10.1/"), "s_suppkey", F.lit("'>x</a>"))
    folder = written(t, t.supplier.withColumn("html", html), F.concat(F.lit("Pkg"), "s_suppkey", F.lit(".bioconductor.citation.html")), F.col("html"), "text")
    return readers.side_files(t._spark, f"{folder}/*", ".bioconductor.citation.html").select("package", F.explode(text.doi_links(F.col("html"))).alias("doi"))


@query("SELECT o_orderkey AS id, o_orderstatus AS status FROM orders")
def metric_lists(t):
    folder = workspace(t._spark)
    lists = t.orders.groupBy(F.floor(F.col("o_orderkey") / 1000).alias("part")).agg(F.to_json(F.collect_list(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")))).alias("doc"))
    sinks.record_files(lists.unionByName(t._spark.createDataFrame([(-1, "<html>")], "part long, doc string")), folder, F.concat("part", F.lit(".json")), F.col("doc"), "text")
    return readers.json_or_none(t._spark, f"{folder}/*.json").select(F.variant_get("doc", "$.id", "long").alias("id"), F.variant_get("doc", "$.status", "string").alias("status"))


@query("SELECT p_partkey::VARCHAR AS nid, p_name AS title FROM part WHERE p_partkey % 4 <> 0")
def listed_nodes(t):
    # every fourth node fails, one in two is cached
    listed = t.part.select(F.col("p_partkey").cast("string").alias("nid"), "p_name", "p_partkey")
    answer = F.to_json(F.struct("nid", F.col("p_name").alias("title")))
    cache = listed.where("p_partkey % 4 <> 0").select("nid", answer.alias("value")).unionAll(listed.where("p_partkey % 8 = 0").select("nid", F.lit("{")))
    return readers.nodes(t._spark, listed.select("nid"), cache, lambda nid: None).select("nid", F.variant_get("doc", "$.title", "string").alias("title"))


def database(rows: DataFrame, table: str, *index: str) -> tuple[str, dict]:
    """A table in the database that Spark brings along, in order of the columns of its index if it has one: its address, and how it is read.

    That database belongs to one process, or, as an archive in a folder that all share, to any number that only read it. So tasks write the rows as files, the driver has the database import these, which it does page by page, and archives it.
    """
    import zipfile
    from pathlib import Path
    from urllib.parse import unquote, urlparse

    spark = rows.sparkSession
    place = urlparse(sinks.address(spark, workspace(spark)))
    if place.scheme != "file":
        raise ValueError(f"the database needs a folder of the file system, not {place.geturl()}")
    folder, name = Path(unquote(place.path)), f"t{uuid.uuid4().hex}"
    (rows.repartitionByRange(*index).sortWithinPartitions(*index) if index else rows).write.csv(f"{folder}/rows", quoteAll=False, escape='"', emptyValue='""', nullValue="")
    driver, none = spark._jvm.org.apache.derby.iapi.jdbc.AutoloadedDriver(), spark._jvm.java.util.Properties()
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR(64)"}
    columns = ", ".join(f'"{c}" {kinds[kind]}' for c, kind in rows.dtypes)
    connection = driver.connect(f"jdbc:derby:{folder}/{name};create=true", none)
    statement = connection.createStatement()
    statement.execute(f"CREATE TABLE {table} ({columns})")
    for part in sorted((folder / "rows").glob("part-*")):
        statement.execute(f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(NULL, '{table.upper()}', '{part}', NULL, NULL, 'UTF-8', 0)")
    if index:
        statement.execute(f"CREATE INDEX by_key ON {table} ({', '.join(f'{chr(34)}{c}{chr(34)}' for c in index)})")
    connection.close()
    try:
        driver.connect(f"jdbc:derby:{folder}/{name};shutdown=true", none)
    except Exception as closed:  # its answer to a shutdown is an error
        if "08006" not in str(closed) and "shutdown" not in str(closed):
            raise
    with zipfile.ZipFile(folder / "database.jar", "w", zipfile.ZIP_STORED) as archive:  # stored, so that pages are found without reading those before them
        for file in sorted((folder / name).rglob("*")):
            if file.is_file() and file.suffix != ".lck":
                archive.write(file, str(file.relative_to(folder)))
    return f"jdbc:derby:jar:({folder}/database.jar){name}", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@query("SELECT c_custkey, c_name FROM customer")
def jdbc_table(t):
    url, options = database(t.customer.select("c_custkey", "c_name"), "customer")
    return readers.jdbc_tables(t._spark, url, ["customer"], **options)["customer"].select("c_custkey", "c_name")


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) AND o_orderstatus = 'F'")
def jdbc_ranged(t):
    """Eight ranges of a key, after the database's own semi join, with the filter pushed down."""
    url, options = database(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), "orders", "o_custkey", "o_totalprice")
    rows = readers.jdbc_ranges(t._spark, url, "orders", "\"o_custkey\"", 8, 'SELECT "o_custkey" FROM orders WHERE "o_totalprice" > 400000', **options)
    return rows.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderstatus")


def config_release(spark: SparkSession, release: str) -> str | None:
    """A release number through a configuration file."""
    folder = workspace(spark)
    spark.createDataFrame([(f"release_version: {json.dumps(release)}",)], "value string").coalesce(1).write.text(folder)
    return readers.config_value(spark, f"{folder}/*.txt", "release_version")


@query("SELECT p_partkey, '3.' || (SELECT max(p_size) FROM part) AS release FROM part")
def release_setting(t):
    """A release number that a step before has left in a configuration file."""
    newest = t.part.agg(F.max("p_size")).first()[0]
    return t.part.select("p_partkey", F.lit(config_release(t._spark, f"3.{newest}")).alias("release"))


@query("SELECT 'bioconductor-pkg' || s_suppkey AS id, 'Pkg' || s_suppkey AS name, '1.' || s_nationkey AS version, CASE WHEN s_suppkey % 2 = 0 THEN '10.1/' || s_suppkey END AS doi FROM supplier")
def convert_command(t):
    """The convert command, from package files and citation pages to a table."""
    from .. import cli

    package = F.concat(F.lit("Pkg"), "s_suppkey")
    doc = F.to_json(F.struct(package.alias("Package"), F.lit("A B [aut]").alias("Author"), F.concat(F.lit("1."), "s_nationkey").alias("Version")))
    packages_ = written(t, t.supplier, F.concat(package, F.lit(".json")), doc)
    html = F.concat(F.lit("<a href='https://doi.org/10.1/"), "s_suppkey", F.lit("'>x</a>"))
    citations = written(t, t.supplier.where("s_suppkey % 2 = 0"), F.concat(package, F.lit(".bioconductor.citation.html")), html, "text")
    out = workspace(t._spark)
    code = cli.run(t._spark, ["convert", f"{packages_}/*.json", "--citations", f"{citations}/*", "--out", out])
    if code:
        raise RuntimeError(f"the command ended with {code}")
    return t._spark.read.parquet(f"{out}/converted").select(F.col("biotoolsID").alias("id"), "name", F.col("version")[0].alias("version"), F.get("publication", F.lit(0))["doi"].alias("doi"))
