"""The registered queries: each capability over the driver's tables, beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import canon, licenses, text
from ..operators import matching, packages, quality, triples, upsert

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")


#: Rows that one task maps at once.
DEALT = 50_000


def spread(table: DataFrame) -> DataFrame:
    """The table dealt to tasks of about DEALT rows each: millions of short rows can be a few MB of Parquet, which one task would read and map. Only the files' footers are read for their count."""
    tasks = table.count() // DEALT + 1
    return table.repartition(tasks) if tasks > 1 else table


def query(sql: str):
    """Registers f(tables) under its name, with its SQL."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        ORACLE_SQL[f.__name__] = sql
        return f

    return register


SUPPLIER = "urn:supplier:"


def supplier_graph(t: Tables) -> DataFrame:
    # nation has 25 rows: Spark broadcasts it by its own size check
    s = spread(t.supplier).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return triples.facts(s, F.concat(F.lit(SUPPLIER), "s_suppkey"), [
        triples.Rule(triples.TYPE, F.lit(triples.SC + "Organization"), True), triples.Rule(triples.SC + "name", F.col("s_name")),
        triples.Rule(triples.SC + "location", F.concat(F.lit("urn:nation:"), "n_name"), True),
    ])


def customer_graph(t: Tables) -> DataFrame:
    return triples.facts(spread(t.customer), F.concat(F.lit("urn:customer:"), "c_custkey"), [
        triples.Rule(triples.TYPE, F.lit(triples.SC + "Person"), True), triples.Rule(triples.SC + "name", F.col("c_name")), triples.Rule(triples.SC + "category", F.col("c_mktsegment")),
    ])


def place_graph(t: Tables) -> DataFrame:
    n = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return triples.facts(n, F.concat(F.lit("urn:nation:"), "n_name"), [triples.Rule(triples.TYPE, F.lit(triples.SC + "Country"), True), triples.Rule(triples.SC + "containedInPlace", F.concat(F.lit("urn:region:"), "r_name"), True)])


_RDF, _SC = triples.TYPE, triples.SC
_GRAPH = f"""
SELECT 'urn:supplier:' || s_suppkey AS s, '{_RDF}' AS p, '{_SC}Organization' AS o, 'iri' AS o_kind FROM supplier
UNION SELECT 'urn:supplier:' || s_suppkey, '{_SC}name', s_name, 'literal' FROM supplier WHERE s_name <> ''
UNION SELECT 'urn:supplier:' || s_suppkey, '{_SC}location', 'urn:nation:' || n_name, 'iri' FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
_ALL = f"""{_GRAPH}
UNION SELECT 'urn:customer:' || c_custkey, '{_RDF}', '{_SC}Person', 'iri' FROM customer
UNION SELECT 'urn:customer:' || c_custkey, '{_SC}name', c_name, 'literal' FROM customer
UNION SELECT 'urn:customer:' || c_custkey, '{_SC}category', c_mktsegment, 'literal' FROM customer
UNION SELECT 'urn:nation:' || n_name, '{_RDF}', '{_SC}Country', 'iri' FROM nation JOIN region ON n_regionkey = r_regionkey
UNION SELECT 'urn:nation:' || n_name, '{_SC}containedInPlace', 'urn:region:' || r_name, 'iri' FROM nation JOIN region ON n_regionkey = r_regionkey"""


def whole_graph(t: Tables) -> DataFrame:
    return triples.union_graph(supplier_graph(t), customer_graph(t), place_graph(t))


@query(_GRAPH)
def triples_supplier(t):
    return triples.union_graph(supplier_graph(t))


@query(f"SELECT o AS class, count(*) AS n FROM ({_ALL}) WHERE p = '{_RDF}' GROUP BY o")
def triple_class_counts(t):
    return triples.class_counts(whole_graph(t)).orderBy(F.desc("n"), "class")


@query(f"SELECT p AS property, count(*) AS n FROM ({_ALL}) GROUP BY p")
def triple_property_counts(t):
    return triples.property_counts(whole_graph(t)).orderBy(F.desc("n"), "property")


@query("SELECT n_name AS name FROM nation UNION SELECT r_name FROM region UNION SELECT n_name FROM nation")
def graph_union_distinct(t):
    return t.nation.select(F.col("n_name").alias("name")).union(t.region.select("r_name")).union(t.nation.select("n_name")).distinct()


@query(rf"""SELECT '<urn:doc:' || doc_id || '> <{_SC}text> "' || replace(replace(replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t') || '" .' AS value FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text <> '')""")
def ntriples_lines(t):
    return triples.ntriples(triples.triples(t.documents, F.concat(F.lit("urn:doc:"), "doc_id"), [triples.Rule(triples.SC + "text", F.col("text"))]))


@query(f"""WITH g AS ({_GRAPH}) SELECT s, count(*) AS n_facts, sum(length(o))::BIGINT AS n_chars FROM g GROUP BY s""")
def jsonld_documents(t):
    # the documents are read again, so that what is compared went through the JSON text
    g = triples.jsonld(triples.union_graph(supplier_graph(t))).select("s", F.try_parse_json("value").alias("d"))
    names = [triples.TYPE, triples.SC + "name", triples.SC + "location"]
    objects = F.filter(F.flatten(F.array(*(F.coalesce(F.try_variant_get("d", f"$['{n}']", "array<map<string,string>>"), F.array().cast("array<map<string,string>>")) for n in names))), lambda x: x.isNotNull())
    size = F.aggregate(objects, F.lit(0).cast("bigint"), lambda a, x: a + F.length(F.coalesce(F.element_at(x, "@id"), F.element_at(x, "@value"))))
    return g.select("s", F.size(objects).cast("bigint").alias("n_facts"), size.alias("n_chars"))


_TERMS = [("red", "topic_0001"), ("blue", "topic_0002"), ("green", "topic_0003"), ("steel", "operation_0001"), ("small", "operation_0002"), ("large", "operation_0003")]


@query("SELECT DISTINCT p_partkey, CASE word " + " ".join(f"WHEN '{w}' THEN '{e}'" for w, e in _TERMS) + " END AS entity FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part) WHERE word IN (" + ", ".join(f"'{w}'" for w, _ in _TERMS) + ")")
def label_lookup(t):
    terms = t._spark.createDataFrame([(w, f"http://edamontology.org/{e}") for w, e in _TERMS], "label string, entity string")
    return triples.labels_to_terms(t.part.withColumn("labels", F.split("p_name", " ")), "p_partkey", "labels", terms)


@query("SELECT p_partkey, p_name FROM part WHERE list_contains(string_split(p_name, ' '), 'red') OR list_contains(string_split(p_name, ' '), 'small')")
def array_member_filter(t):
    words = F.split("p_name", " ")
    return t.part.where(F.array_contains(words, "red") | F.array_contains(words, "small")).select("p_partkey", "p_name")


@query("SELECT c_custkey, nullif(c_name, '') AS c_name, nullif(CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END, 0) AS balance, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment FROM customer")
def drop_falsy_flat(t):
    doc = F.struct("c_name", F.struct(F.when(F.col("c_acctbal") < 0, 0.0).otherwise(F.col("c_acctbal")).alias("balance"), F.array(F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))).alias("segments")).alias("inner"))
    c = t.customer.select("c_custkey", doc.alias("doc"))
    c = c.withColumn("doc", canon.drop_falsy(F.col("doc"), c.schema["doc"].dataType))
    return c.select("c_custkey", "doc.c_name", "doc.inner.balance", F.get("doc.inner.segments", F.lit(0)).alias("segment"))


@query("SELECT o_orderkey, string_agg(l_partkey::VARCHAR || ':' || l_linenumber, ',' ORDER BY l_partkey, l_linenumber) AS lines FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def deep_array_sort(t):
    joined = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    nested = joined.groupBy("o_orderkey").agg(F.collect_list(F.struct("l_partkey", "l_linenumber")).alias("lines"))
    sorted_ = canon.deep_sort(F.col("lines"), nested.schema["lines"].dataType)
    return nested.select("o_orderkey", F.array_join(F.transform(sorted_, lambda x: F.concat_ws(":", x["l_partkey"], x["l_linenumber"])), ",").alias("lines"))


@query("SELECT p_partkey, p_size::VARCHAR AS version, p_size::VARCHAR || '|' || (p_size + 1)::VARCHAR AS versions FROM part")
def version_string(t):
    doc = t.part.select("p_partkey", F.col("p_size").alias("version"), F.array(F.struct(F.col("p_size").alias("version")), F.struct((F.col("p_size") + 1).alias("version"))).alias("versions"))
    doc = canon.version_at(canon.version_at(canon.version_at(doc, "version"), "versions[].version"), "missing.path")
    return doc.select("p_partkey", "version", F.array_join(F.transform("versions", lambda x: x["version"]), "|").alias("versions"))


_VERSIONS = "p_size || '.' || (p_partkey % 7) || CASE p_partkey % 5 WHEN 0 THEN '+dfsg-3' WHEN 1 THEN '-2' WHEN 2 THEN '+lgpl-2' WHEN 3 THEN '-0biolinux4' ELSE '-1ubuntu2' END"


@query(rf"SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace({_VERSIONS}, '-[.\d]+$', ''), '\+dfsg.*$', ''), '\+lgpl.*$', ''), '-\d*biolinux\d*$', '') AS version FROM part")
def version_cleanup(t):
    return t.part.select("p_partkey", text.clean_version(F.expr(_VERSIONS)).alias("version"))


@query("SELECT p_partkey, replace(replace(lower(p_name || ' / ' || p_brand), '/', ''), ' ', '-') AS slug FROM part")
def slugify(t):
    return t.part.select("p_partkey", text.slug(F.concat_ws(" / ", "p_name", "p_brand")).alias("slug"))


@query(r"SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE url END AS bare, regexp_replace('https://bioconductor.org/packages/' || CASE WHEN page_id % 2 = 0 THEN 'release' ELSE '3.18/bioc' END || '/html/p' || page_id || '.html?x=1', '^(https?://bioconductor\.org/packages/)(?:release|[^/]+/bioc)/html/([^/]+)\.html(?:\?.*)?$', '\1\2') AS package FROM pages")
def url_normalise(t):
    made = F.concat(F.lit("https://bioconductor.org/packages/"), F.when(F.col("page_id") % 2 == 0, "release").otherwise("3.18/bioc"), F.lit("/html/p"), "page_id", F.lit(".html?x=1"))
    return t.pages.select("page_id", text.remove_protocol(F.col("url")).alias("bare"), text.normalise_package_url(made).alias("package"))


@query("SELECT split_part(split_part(url, '://', 2), '/', 1) AS host, count(*) AS n FROM pages GROUP BY 1")
def url_host_counts(t):
    return quality.counts(t.pages, host=F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1)))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'tool' || page_id ELSE 't' || page_id END AS id FROM pages")
def id_from_uri(t):
    uri = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://metrics.example/biotools:tool"), "page_id", F.lit(":1.4/cmd/x"))).otherwise(F.concat(F.lit("https://metrics.example/t"), "page_id"))
    return t.pages.select("page_id", text.id_from_uri(uri, "https://metrics.example/").alias("id"))


_HREF = text.HREF.replace("'", r"\x27")
_BARE = r"regexp_replace(u, '^[\x22\x27]|[\x22\x27]$', '', 'g')"
_LINKS = f"""SELECT page_id, trim(replace(replace(replace(replace(replace({_BARE}, '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&amp;', '&')) AS link FROM (SELECT page_id, unnest(regexp_extract_all(html, '{_HREF}', 1)) AS u FROM pages)"""


@query(f"""SELECT page_id, link, count(*) AS n FROM ({_LINKS}) GROUP BY 1, 2""")
def html_links(t):
    return t.pages.select("page_id", F.explode(text.hrefs(F.col("html"))).alias("link")).groupBy("page_id", "link").agg(F.count("*").alias("n"))


@query(f"""SELECT page_id, string_agg(x, ',' ORDER BY x) AS links FROM (SELECT page_id, string_split(link, '/')[-1] AS x FROM ({_LINKS})) GROUP BY 1""")
def link_tails(t):
    found = t.pages.select("page_id", text.doi_links(F.col("html"), "").alias("links")).where(F.size("links") > 0)
    return found.select("page_id", F.array_join(F.array_sort("links"), ",").alias("links"))


@query("SELECT page_id, length(regexp_replace(html, '<[^>]*>', '', 'g'))::BIGINT AS n FROM pages")
def html_text_len(t):
    return t.pages.select("page_id", F.length(text.strip_tags(F.col("html"))).cast("bigint").alias("n"))


@query("SELECT page_id, replace(url || '|a', '|', '%7C') AS url, replace(replace('10.1/[' || page_id || ']', '[', '%5B'), ']', '%5D') AS doi FROM pages")
def percent_escape(t):
    return t.pages.select("page_id", text.percent_escape_url(F.concat("url", F.lit("|a"))).alias("url"), text.percent_escape_doi(F.concat(F.lit("10.1/["), "page_id", F.lit("]"))).alias("doi"))


_LICENSE_LINES = r"SELECT doc_id, unnest(regexp_extract_all(text, '(?i)[^\n]*licen[sc]e[^\n]*')) AS line FROM documents"


def license_rows(t: Tables) -> DataFrame:
    # lines first: a pattern that starts with [^\n]* tries each place of a line again
    lines = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.where(F.rlike("line", F.lit("(?i)licen[sc]e")))


@query(_LICENSE_LINES)
def license_lines(t):
    return license_rows(t)


@query(f"""WITH l AS ({_LICENSE_LINES}) SELECT doc_id, line, CASE WHEN regexp_matches(lower(line), '\\bapache\\b') THEN 'Apache-2.0' WHEN regexp_matches(lower(line), '\\bmit\\b') THEN 'MIT' END AS spdx FROM l""")
def license_spdx(t):
    return licenses.normalise(license_rows(t), "line")


_LICENSES = [
    ("Apache License (>= 2)", "Apache-2.0"), ("GPL (>= 3) + file LICENSE", "GPL-3.0-or-later"), ("GPL (>= 2) + file LICENSE", "GPL-2.0-or-later"), ("file LICENSE", None), ("GPL (>=3) | file LICENSE", "GPL-3.0-only"),
    ("MIT + file LICENCE", "MIT"), ("BSD 3-clause License + file LICENSE", "BSD-3-Clause"), ("LGPL (>= 2)", "LGPL-2-or-later"), ("MPL-2.0", "MPL-2.0"), ("CC BY 4.0", "CC-BY-4.0"), ("EPL-2.0", "EPL-1.0"), ("CC0-1.0", "CC0-1.0"), ("GPL-2.0", "GPL-2.0-only"),
    ("BSD_3_clause + file LICENSE", "BSD-3-Clause"), ("\u00c1pache", "Apache-2.0"), ("\uff2d\uff29\uff34", "MIT"),
]
_LICENSE_CASE = lambda i: f"CASE p_partkey % {len(_LICENSES)} " + " ".join(f"WHEN {k} THEN '{x[i]}'" for k, x in enumerate(_LICENSES) if x[i]) + " END"


@query(f"SELECT p_partkey, {_LICENSE_CASE(0)} AS raw, {_LICENSE_CASE(1)} AS spdx FROM part UNION ALL SELECT -1 - p_partkey, 'GPL (>= ' || p_size || ')', 'GPL-' || p_size || '.0-or-later' FROM part")
def license_vectors(t):
    rows = t.part.select("p_partkey", F.expr(_LICENSE_CASE(0)).alias("raw")).unionAll(t.part.select(-1 - F.col("p_partkey"), F.concat(F.lit("GPL (>= "), "p_size", F.lit(")"))))
    return licenses.normalise(rows, "raw")


def sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Customers and suppliers as records whose names and homepages collide: by nation and balance band, and by nation and last digit."""

    def side(df: DataFrame, k: str, n: str, b: str) -> DataFrame:
        band = F.floor(F.col(b) / 500)
        return df.select(F.col(k).alias("file"), F.concat_ws("-", n, band).alias("name"), F.concat(F.lit("https://"), F.concat_ws("/", n, F.col(k) % 100)).alias("homepage"))

    return side(t.customer, "c_custkey", "c_nationkey", "c_acctbal"), side(t.supplier, "s_suppkey", "s_nationkey", "s_acctbal")


METHODS = ["name_insensitive", "homepage"]


def identity_edges(t: Tables) -> DataFrame:
    left, right = sides(t)
    return matching.edges(matching.keys(left, METHODS), matching.keys(right, METHODS))


_EDGES = """SELECT DISTINCT f1, f2, method FROM (
  SELECT c_custkey AS f1, s_suppkey AS f2, 'name_insensitive' AS method FROM customer JOIN supplier ON c_nationkey = s_nationkey AND floor(c_acctbal / 500) = floor(s_acctbal / 500)
  UNION ALL SELECT c_custkey, s_suppkey, 'homepage' FROM customer JOIN supplier ON c_nationkey = s_nationkey AND c_custkey % 100 = s_suppkey % 100)"""


@query(_EDGES)
def identity_pairs(t):
    return identity_edges(t)


@query(f"""WITH RECURSIVE e AS MATERIALIZED ({_EDGES}), c AS MATERIALIZED (SELECT f1, list_sort(list(DISTINCT f2)) AS may, row_number() OVER (ORDER BY f1) AS turn FROM e GROUP BY f1),
g AS (SELECT 0::BIGINT AS turn, []::BIGINT[] AS taken, NULL::BIGINT AS f1, NULL::BIGINT AS f2
  UNION ALL SELECT turn, CASE WHEN f2 IS NULL THEN taken ELSE list_append(taken, f2) END, f1, f2 FROM (SELECT c.turn, g.taken, c.f1, list_filter(c.may, lambda x: NOT list_contains(g.taken, x))[1] AS f2 FROM g JOIN c ON c.turn = g.turn + 1))
SELECT g.f1, g.f2, string_agg(method, ',' ORDER BY method) AS methods FROM g JOIN e ON g.f1 = e.f1 AND g.f2 = e.f2 GROUP BY 1, 2""")
def greedy_match(t):
    left, right = sides(t)
    m = matching.matched(matching.keys(left, METHODS), matching.keys(right, METHODS))
    return m.select("f1", "f2", F.array_join("methods", ",").alias("methods"))


@query("SELECT o_orderkey AS f1, o_orderkey + 1 AS f2 FROM orders WHERE o_orderkey % 500 <> 499 AND o_orderkey < (SELECT max(o_orderkey) FROM orders)")
def chained_match(t):
    """Chains of 500 files: each shares values with two neighbours on the other side, and the first one's choice decides on all others'."""
    k = F.col("o_orderkey")
    left = t.orders.select(k.alias("file"), F.lit("m").alias("method"), F.explode(F.when(k % 500 == 499, F.array(k)).otherwise(F.array(k, k + 1)).cast("array<string>")).alias("value"))
    right = t.orders.where(k % 500 != 0).select(k.alias("file"), F.lit("m").alias("method"), k.cast("string").alias("value"))
    return matching.assign(left, right)


@query("""SELECT file, method, value FROM (
  SELECT c_custkey AS file, 'name' AS method, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_name END AS value FROM customer
  UNION ALL SELECT c_custkey, 'name_insensitive', nullif(CASE WHEN c_custkey % 7 = 0 THEN '' ELSE lower(c_name) END, '') FROM customer
  UNION ALL SELECT c_custkey, 'homepage', 'bioconductor.org/packages/P' || c_nationkey FROM customer
  UNION ALL SELECT c_custkey, 'biotoolsID_unprefixed', 'x' || c_custkey FROM customer
  UNION ALL SELECT DISTINCT c_custkey, 'doi', unnest(['10.1/' || c_nationkey, '10.1/' || c_nationkey, '10.2/' || c_custkey]) FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT c_custkey, 'name_homepage', lower(c_name) || chr(31) || 'bioconductor.org/packages/P' || c_nationkey FROM customer WHERE c_custkey % 7 <> 0) WHERE value IS NOT NULL""")
def identity_keys(t):
    k = F.col("c_custkey")
    doi = lambda *x: F.struct(F.concat(*(F.lit(y) if isinstance(y, str) else y for y in x)).alias("doi"))
    n = F.col("c_nationkey")
    rows = t.customer.select(
        k.alias("file"), F.when(k % 7 == 0, "").otherwise(F.col("c_name")).alias("name"), F.concat(F.lit("https://bioconductor.org/packages/release/bioc/html/P"), n, F.lit(".html")).alias("homepage"),
        F.concat(F.when(k % 2 == 0, "bioconductor-").otherwise(""), F.lit("x"), k).alias("biotoolsID"), F.when(k % 3 == 0, F.array(doi("10.1/", n), doi("10.1/", n), doi("10.2/", k), F.struct(F.lit(None).cast("string").alias("doi")))).alias("publication"),
    )
    return matching.keys(rows, sorted(matching.IDENTITIES))


@query(f"SELECT c_custkey AS file FROM customer WHERE NOT EXISTS (SELECT 1 FROM ({_EDGES}) e WHERE e.f1 = c_custkey)")
def unmatched_left(t):
    left, right = (matching.keys(x, METHODS) for x in sides(t))
    return matching.without_partner(left, right, t.customer.select(F.col("c_custkey").alias("file")))


@query(f"SELECT s_suppkey AS file FROM supplier WHERE NOT EXISTS (SELECT 1 FROM ({_EDGES}) e WHERE e.f2 = s_suppkey)")
def unmatched_right(t):
    left, right = (matching.keys(x, METHODS) for x in sides(t))
    return matching.without_partner(right, left, t.supplier.select(F.col("s_suppkey").alias("file")))


@query("SELECT 'flag' AS method, l_returnflag AS value, count(DISTINCT l_orderkey) AS n, true AS chunks_fit, sum(DISTINCT l_orderkey)::BIGINT AS total FROM lineitem GROUP BY 2")
def inverted_index_chunks(t):
    """The files of values that very many share, in lists of at most 500."""
    rows = t.lineitem.select(F.lit("flag").alias("method"), F.col("l_returnflag").alias("value"), F.col("l_orderkey").alias("file"))
    chunks = matching.inverted_index(rows, chunk=500)
    total = F.aggregate("files", F.lit(0).cast("long"), lambda a, x: a + x)
    return chunks.groupBy("method", "value").agg(F.max("n").alias("n"), (F.max(F.size("files")) <= 500).alias("chunks_fit"), F.sum(total).alias("total"))


@query("SELECT lang AS method, source AS value, count(*) AS n FROM documents GROUP BY 1, 2")
def inverted_index(t):
    return matching.inverted_index(t.documents.select(F.col("lang").alias("method"), F.col("source").alias("value"), F.col("doc_id").alias("file")), lists=False)


@query("""WITH n AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice AS p FROM orders WHERE o_orderkey % 3 <> 0),
o AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS s, o_totalprice AS p FROM orders WHERE o_orderkey % 4 <> 0)
SELECT coalesce(n.k, o.k) AS k, CASE WHEN o.k IS NULL THEN 'uploaded' WHEN n.k IS NULL THEN 'only_existing' WHEN n.s = o.s AND n.p = o.p THEN 'unchanged' ELSE 'updated' END AS action FROM n FULL JOIN o ON n.k = o.k""")
def upsert_actions(t):
    o = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("p"))
    old = o.where("k % 4 <> 0").withColumn("s", F.when(F.col("k") % 5 == 0, "X").otherwise(F.col("s")))
    return upsert.actions(o.where("k % 3 <> 0"), old, "k", ["s", "p"])


@query("""SELECT a.c_custkey, CASE WHEN a.c_custkey % 2 = 0 AND a.c_custkey % 4 <> 0 THEN upper(a.c_mktsegment) || '!' ELSE a.c_mktsegment END AS c_mktsegment,
CASE WHEN a.c_custkey % 2 = 0 THEN CASE WHEN a.c_custkey % 4 <> 0 THEN a.c_name END ELSE a.c_name END AS c_name FROM customer a""")
def field_merge(t):
    old = t.customer.select("c_custkey", "c_mktsegment", "c_name")
    new = old.where("c_custkey % 2 = 0").withColumns({"c_mktsegment": F.expr("CASE WHEN c_custkey % 4 <> 0 THEN upper(c_mktsegment) || '!' END"), "c_name": F.expr("CASE WHEN c_custkey % 4 <> 0 THEN c_name END")})
    return upsert.overwrite(old, new, "c_custkey", ["c_mktsegment", "c_name"], nullable=("c_name",))


@query("SELECT o_orderkey, count(l_orderkey) AS n, string_agg(l_linenumber || '/' || l_suppkey, ',' ORDER BY l_linenumber, l_suppkey) AS lines FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def nest_children(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_suppkey")
    nested = packages.nest(t.orders.select("o_orderkey"), {"lines": lines}, "o_orderkey")
    return nested.select("o_orderkey", F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("n"), F.array_join(F.transform("lines", lambda x: F.concat_ws("/", x["l_linenumber"], x["l_suppkey"])), ",").alias("lines")).withColumn("n", F.greatest("n", F.lit(0)))


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def semi_join_reduce(t):
    return quality.linked(t.customer.select("c_custkey", "c_name"), t.orders.where("o_orderpriority = '1-URGENT'").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def stale_delete(t):
    return quality.stale(t.orders.select("o_orderkey"), t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def latest_by_rank(t):
    return packages.latest(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderkey", "o_totalprice")


@query("SELECT o_custkey::VARCHAR AS package, coalesce(max(o_orderkey) FILTER (o_orderstatus <> 'P'), max(o_orderkey))::VARCHAR AS version FROM orders GROUP BY 1")
def max_with_fallback(t):
    p = t.orders.select(F.col("o_custkey").cast("string").alias("package"), F.col("o_orderkey").cast("string").alias("version"), "o_orderstatus")
    return packages.latest_versions(p, "o_orderstatus <> 'P'")


@query("SELECT CAST(l_partkey % 100 AS VARCHAR) AS package, CAST(l_linenumber AS VARCHAR) AS version, max(o_orderpriority) AS release FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2")
def latest_release(t):
    p = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select((F.col("l_partkey") % 100).cast("string").alias("package"), F.col("l_linenumber").cast("string").alias("version"), F.col("o_orderpriority").alias("release"))
    releases = t.orders.select(F.col("o_orderpriority").alias("release")).distinct().withColumn("sort", F.col("release"))
    return packages.latest_release(p, releases)


@query("SELECT l_orderkey AS k, l_linenumber AS v FROM lineitem UNION SELECT o_orderkey, 0 FROM orders")
def union_distinct_versions(t):
    return t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("v")).union(t.orders.select("o_orderkey", F.lit(0))).distinct()


@query("SELECT s_suppkey, s_name, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey ORDER BY 1")
def left_enrich(t):
    placed = packages.enrich(packages.enrich(t.supplier, t.nation, {"s_nationkey": "n_nationkey"}), t.region, {"n_regionkey": "r_regionkey"})
    return placed.select("s_suppkey", "s_name", "n_name", "r_name").orderBy("s_suppkey")


@query("""SELECT "F", "O", "P", count(*) AS n FROM (SELECT o_custkey, bool_or(o_orderstatus = 'F') AS "F", bool_or(o_orderstatus = 'O') AS "O", bool_or(o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1) GROUP BY 1, 2, 3""")
def coverage_matrix(t):
    return quality.coverage(t.orders.select(F.col("o_custkey").alias("tool_id"), F.col("o_orderstatus").alias("source")), ["F", "O", "P"])


@query("""WITH f AS (SELECT lang = 'en' AS english, n_chars > 2000 AS long, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AS labelled FROM documents d)
SELECT english, long, labelled, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 6) AS share FROM f GROUP BY 1, 2, 3""")
def upset_counts(t):
    d = t.documents.join(t.labels.select("doc_id", F.lit(True).alias("known")).distinct(), "doc_id", "left")
    return quality.intersections(d, {"english": F.col("lang") == "en", "long": F.col("n_chars") > 2000, "labelled": F.coalesce("known", F.lit(False))})


@query("SELECT md5(text) AS digest, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY text HAVING count(*) > 1")
def duplicates_exact(t):
    return quality.repeated(t.documents, "text", first="doc_id").select(F.md5("text").alias("digest"), "n", "first_id")


@query("""WITH o AS (SELECT l_orderkey, list_sort(list(DISTINCT l_suppkey)) AS s FROM lineitem GROUP BY 1), d AS (SELECT s FROM o GROUP BY s HAVING count(*) > 1)
SELECT value, count(DISTINCT l_orderkey) AS n FROM (SELECT l_orderkey, unnest(o.s) AS value FROM o JOIN d ON o.s = d.s) GROUP BY 1""")
def duplicate_lists(t):
    r = t.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_suppkey")).alias("values"))
    return quality.duplicate_lists(r, "l_orderkey", "values").groupBy("value").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicates_by_key(t):
    return quality.repeated(t.lineitem, "l_orderkey", "l_linenumber")


@query("SELECT value, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT l_partkey AS value, l_orderkey AS item FROM lineitem) GROUP BY 1 HAVING count(*) > 1")
def duplicate_values(t):
    r = t.lineitem.groupBy("l_orderkey").agg(F.collect_set("l_partkey").alias("values"))
    return quality.listed(quality.duplicate_values(r, "l_orderkey", "values"), "value", "item").select("value", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"))


_HELD = "SELECT DISTINCT l_orderkey AS tool, l_partkey AS doi, l_returnflag AS source FROM lineitem"


@query(f"WITH h AS ({_HELD}) SELECT a.tool, a.doi, b.source FROM (SELECT DISTINCT tool, doi FROM h) a JOIN (SELECT DISTINCT tool, source FROM h) b ON a.tool = b.tool EXCEPT SELECT * FROM h")
def doi_enrichment_gap(t):
    held = t.lineitem.select(F.col("l_orderkey").alias("tool"), F.col("l_partkey").alias("doi"), F.col("l_returnflag").alias("source")).distinct()
    return quality.gaps(held, "tool", "doi", "source").select("tool", "doi", "source")


@query("""WITH a AS (SELECT * FROM orders WHERE o_orderkey % 7 <> 0), b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 9 <> 0)
SELECT status, count(*) AS n FROM (SELECT CASE WHEN a.o_orderkey IS NULL THEN 'A' WHEN b.o_orderkey IS NULL THEN 'D' WHEN a.o_orderstatus <> b.s THEN 'M' END AS status FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey) WHERE status IS NOT NULL GROUP BY 1""")
def snapshot_changes(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    new = o.where("o_orderkey % 9 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 11 == 0, "X").otherwise(F.col("o_orderstatus")))
    return quality.snapshot_diff(o.where("o_orderkey % 7 <> 0"), new, "o_orderkey").groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (o_orderkey % 3 = 0) AS added, count(*) FILTER (o_orderkey % 3 = 1) AS modified, count(*) FILTER (o_orderkey % 3 = 2) AS deleted FROM orders WHERE o_orderkey % 2 = 0")
def change_counts(t):
    name = F.concat(F.lit("t"), "o_orderkey")
    path = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("data/"), name, F.lit("/"), name, F.lit(".json"))).otherwise(F.concat(F.lit("data/"), name, F.lit("/other.json")))
    return quality.changes(t.orders.select(F.element_at(F.array(F.lit("A"), F.lit("M"), F.lit("D")), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("status"), path.alias("path")))


@query("SELECT event_type AS status, count(*) AS n FROM events GROUP BY 1")
def status_counts(t):
    return quality.counts(t.events, status=F.col("event_type"))


@query("SELECT event_id, CAST(props ->> 'k' AS BIGINT) AS k FROM events")
def json_props(t):
    return t.events.select("event_id", F.variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query("SELECT c_custkey, k, v FROM (SELECT c_custkey, 'c_acctbal' AS k, c_acctbal AS v FROM customer UNION ALL SELECT c_custkey, 'c_nationkey', c_nationkey::DOUBLE FROM customer) WHERE v > 0")
def wide_to_long(t):
    c = t.customer.select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("c_nationkey"))
    return c.unpivot(["c_custkey"], ["c_acctbal", "c_nationkey"], "k", "v").where("v > 0")


@query("SELECT o_orderkey, make_date(year(o_orderdate), CASE WHEN o_orderkey % 3 > 0 THEN month(o_orderdate) ELSE 1 END, CASE WHEN o_orderkey % 3 > 1 THEN day(o_orderdate) ELSE 1 END) AS d FROM orders")
def partial_dates(t):
    parts = F.array(F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate"))
    return t.orders.select("o_orderkey", text.partial_date(F.slice(parts, 1, (F.col("o_orderkey") % 3 + 1).cast("int"))).alias("d"))


@query("SELECT doc_id, 'todo' AS state FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'done' FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def resume_anti(t):
    todo = quality.pending(t.documents.select("doc_id"), t.labels, "doc_id").withColumn("state", F.lit("todo"))
    return todo.unionByName(quality.linked(t.documents.select("doc_id"), t.labels, "doc_id").withColumn("state", F.lit("done")))


@query("SELECT count(*) FILTER (event_id % 7 <> 0) AS valid, count(*) FILTER (event_id % 7 = 0) AS invalid FROM events")
def validity_report(t):
    e = t.events.withColumn("props", F.when(F.col("event_id") % 7 == 0, F.substring("props", 1, 3)).otherwise(F.col("props")))
    return quality.validity(e, "event_id", F.try_parse_json("props").isNull())[0]


@query("SELECT o_orderkey, c_custkey AS tool, CASE WHEN o_orderkey % 2 = 0 THEN 'biotools:T' || o_orderkey ELSE 'doi:10/' || o_orderkey END AS ref, lower('T' || o_orderkey) AS id FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 2 = 0")
def cross_references(t):
    ref = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("biotools:T"), "o_orderkey")).otherwise(F.concat(F.lit("doi:10/"), "o_orderkey"))
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_custkey").alias("tool"), ref.alias("ref"))
    return o.withColumn("id", F.explode(text.cross_refs(F.array("ref"))))


@query(r"SELECT doc_id, regexp_replace(trim(regexp_replace(regexp_replace('<jats:p>Abstract  ' || text || '</jats:p>', '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), '^Abstract ', '') AS abstract FROM documents")
def abstract_text(t):
    made = F.concat(F.lit("<jats:p>Abstract  "), "text", F.lit("</jats:p>"))
    return t.documents.select("doc_id", text.clean_abstract(made).alias("abstract"))


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def daily_counts(t):
    return quality.counts(t.events, day=F.date_trunc("day", "ts").cast("timestamp_ntz"), event_type=F.col("event_type"))
