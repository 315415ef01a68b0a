from pyspark.sql import functions as F

from toolgraph.functions import canon, text
from toolgraph.operators import matching, packages, triples, upsert
from toolgraph.sources import readers, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_clean_version(spark):
    for given, want in (("1.2.3+dfsg-4", "1.2.3"), ("2.0-3", "2.0"), ("1.5+lgpl-2", "1.5"), ("3.1-0biolinux4", "3.1"), ("1.0-1ubuntu2", "1.0-1ubuntu2")):
        assert one(spark, text.clean_version(F.lit(given))) == want


def test_urls_and_slugs(spark):
    assert one(spark, text.normalise_package_url(F.lit("https://bioconductor.org/packages/release/bioc/html/limma.html"))) == "https://bioconductor.org/packages/limma"
    assert one(spark, text.normalise_package_url(F.lit("https://www.bioconductor.org/packages/release/bioc/html/limma.html"))).startswith("https://www.")
    assert one(spark, text.slug(F.lit("BioVoxxel Toolbox / 2"))) == "biovoxxel-toolbox--2"
    assert one(spark, text.url_quote(F.lit("http://a.b/c d~*"))) == "http://a.b/c%20d~%2A"
    html = '<a href="https://doi.org/10.1/a">x</a><a href="http://dx.doi.org/10.2/b">y</a>'
    assert one(spark, text.doi_links(F.lit(html))) == ["10.1/a", "10.2/b"]
    assert one(spark, text.cross_refs(F.array(F.lit("biotools:Bowtie2"), F.lit("doi:10.1/x"), F.lit("BioTools:Foo")))) == ["bowtie2"]
    assert one(spark, text.html_text(F.lit("<p>a &amp; b</p>"))) == "a & b"


def test_package_versions_sort_as_packages_do(spark):
    versions = ["1.0~rc1", "1.0", "1.0-2", "1.0-10", "1.0+b1", "1.2", "1.10", "1:0.1"]
    rows = spark.createDataFrame([(v,) for v in versions], "v string").orderBy(text.debian_sort_key(F.col("v"))).collect()
    got = [r.v for r in rows]
    assert got[0] == "1.0~rc1" and got[-1] == "1:0.1" and got.index("1.0-2") < got.index("1.0-10") < got.index("1.2") < got.index("1.10")


def test_canonical_forms(spark):
    assert spark.range(1).select(canon.drop_falsy_json(F.lit('{"a":0,"b":"","c":[{"d":null}],"e":"x","f":{"g":[]}}')).alias("x")).first().x == '{"e": "x"}'
    df = spark.createDataFrame([((0, "", [(None,)], "x"),)], "d struct<a:int,b:string,c:array<struct<d:string>>,e:string>")
    assert canon.drop_falsy_columns(df).first().d.asDict() == {"a": None, "b": None, "c": None, "e": "x"}
    df = spark.createDataFrame([(([2, 1],),)], "d struct<v:array<int>>")
    t = df.schema["d"].dataType
    assert df.select(canon.deep_sort(F.col("d"), t).alias("d")).first().d.v == [1, 2]
    assert df.select(canon.drop_keys(F.struct("d"), spark.range(1).select(F.struct(F.struct(F.lit(1).alias("v")).alias("d")).alias("s")).schema["s"].dataType, set()).alias("x")).count() == 1


def test_matching_vectors(spark):
    def pairs(rows):
        # each pair shares a value of its own
        left, right = ([(r[i], "m", "-".join(r)) for r in rows] for i in (0, 1))
        schema = "file string, method string, value string"
        return {(r.f1, r.f2) for r in matching.assign(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)).collect()}

    assert pairs([("L1", "R1"), ("L2", "R1"), ("L2", "R2")]) == {("L1", "R1"), ("L2", "R2")}
    assert pairs([("L1", "R1"), ("L1", "R2"), ("L2", "R1")]) == {("L1", "R1")}


def test_merges(spark):
    new = spark.createDataFrame([(1, "n", None)], "id int, a string, b string")
    old = spark.createDataFrame([(1, "o", "kept")], "id int, a string, b string")
    assert upsert.preserve(new, old, "id", ["b"]).first().asDict() == {"id": 1, "a": "n", "b": "kept"}
    assert upsert.overwrite(old, new, "id", ["a", "b"], ("b",)).first().asDict() == {"id": 1, "a": "n", "b": None}
    assert one(spark, upsert.add_collection(F.array(F.lit("X")), "BioConductor")) == ["BioConductor", "X"]


def test_tool_mapper(spark):
    doc = spark.createDataFrame(
        [("t", "T", [("A", "Person", "https://orcid.org/1", ["Developer"]), ("N", "Funding agency", None, ["Contributor"])], [("10.1/[x]", "7")])],
        "biotoolsID string, name string, credit array<struct<name:string,typeEntity:string,orcidid:string,typeRole:array<string>>>, publication array<struct<doi:string,pmid:string>>",
    )
    rules = [r for k, r in triples.tool_rules().items() if k.split("#")[0] in ("*type", "name", "credit") or k in ("publication#pmid", "publication#doi")]
    got = {(r.p, r.o, r.o_kind) for r in triples.triples(doc, F.concat(F.lit("https://bio.tools/"), "biotoolsID"), rules).collect()}
    assert (triples.SC + "author", "https://orcid.org/1", "iri") in got and (triples.SC + "funder", "N", "literal") in got
    assert (triples.SC + "citation", "https://doi.org/10.1/%5Bx%5D", "iri") in got and (triples.SC + "citation", "pubmed:7", "literal") in got


def test_recipe_mapper(spark):
    docs = [
        '{"package": {"name": "foo", "version": "1.10"}, "about": {"summary": "S", "home": "http://h"}, "source": {"url": ["http://a", "http://b"]}, "extra": {"identifiers": ["biotools:Foo", "DOI:10.1/x", "usegalaxy-eu:foo"], "recipe-maintainers": ["m"]}}',
        '{"package": {"name": "bar"}, "about": {"description": "D", "summary": "S"}, "source": {"url": "http://c"}}', '{"package": {"name": "list"}, "source": [{"url": "http://d"}]}', '{"about": {}}', '{"package": {"name": "empty"}, "extra": null}',
    ]
    flat = triples.flatten_recipes(spark.createDataFrame([(d,) for d in docs], "j string").select(F.parse_json("j").alias("doc")))
    rows = {r.name: r for r in flat.collect()}
    assert set(rows) == {"foo", "bar", "list", "empty"} and set(flat.columns) == set(triples.RECIPE)
    assert rows["foo"].asDict() == {
        "name": "foo", "description": "S", "home": "http://h", "dois": ["DOI:10.1/x"], "identifiers": ["usegalaxy-eu:foo"], "biotools": "https://bio.tools/foo", "license": None, "version": "1.10",
        "summary": "S", "source_urls": ["http://a", "http://b"], "software_help": None, "maintainers": ["m"],
    }
    assert rows["bar"].source_urls == ["http://c"] and rows["bar"].description == "D" and rows["list"].source_urls == [] == rows["empty"].dois
    got = {(r.s, r.p, r.o) for r in triples.triples(flat, F.concat(F.lit(triples.PREFIXES["bioconda"]), "name"), list(triples.mapper(triples.RECIPE).values())).collect()}
    assert (triples.PREFIXES["bioconda"] + "foo", triples.SC + "downloadUrl", "http://b") in got and (triples.PREFIXES["bioconda"] + "bar", triples.TYPE, triples.SC + "SoftwareApplication") in got


def test_node_mapper(spark):
    nodes = spark.createDataFrame(
        [([("/icy",)], [("software",)], [("Icy",)], [("<b>a</b>",)], [("u-1",), (None,)], [(" http://p.org/1 ", "P")], [("GPL",), ("MIT",)], [("2020",), ("2021",), ("",)], [(9,)]), ([("",)], [("software",)], [("A/B c",)], *[None] * 6), ([("/t",)], [("training",)], *[None] * 7)],
        "path array<struct<alias:string>>, type array<struct<target_id:string>>, title array<struct<value:string>>, body array<struct<value:string>>, field_has_function array<struct<target_uuid:string>>,"
        "field_has_reference_publication array<struct<uri:string,title:string>>, field_has_license array<struct<value:string>>, changed array<struct<value:string>>, field_is_dependent_of array<struct<target_id:int>>",
    )
    flat = triples.flatten_nodes(nodes)
    assert set(flat.columns) == {"node", *triples.NODE}
    got = {(r.s, r.p.removeprefix(triples.SC), r.o, r.o_kind) for r in triples.triples(flat, F.col("node"), list(triples.mapper(triples.NODE).values())).collect()}
    icy, other = "http://biii.eu/icy", "http://biii.eu/ab-c"
    assert got == {
        (icy, triples.TYPE, triples.SC + "SoftwareApplication", "iri"), (icy, "name", "Icy", "literal"), (icy, "description", "a", "literal"), (icy, "featureList", "http://biii.eu/u-1", "iri"),
        (icy, "citation", "http://p.org/1", "iri"), (icy, "citation", "P", "literal"), (icy, "license", "GPL", "literal"), (icy, "license", "MIT", "literal"), (icy, "dateModified", "2021", "literal"),
        (icy, "softwareRequirements", "http://biii.eu/node/9", "iri"), (other, triples.TYPE, triples.SC + "SoftwareApplication", "iri"), (other, "name", "A/B c", "literal"),
    }


def test_legacy_node_mapper(spark):
    link = "array<struct<uri:string,title:string>>"
    doc = spark.createDataFrame(
        [([("/icy",)], [("software",)], [("Icy",)], [("<p>a &amp; b</p>",)], [("u-1",), ("http://e.org/t",), (None,)], [(7,), (None,)], [(9,)], [("http://d.org/a b", "D"), ("", "E"), (None, None)], [(0,), (86400,), (90061,)]), ([("x",)], *[None] * 8)],
        "path array<struct<alias:string>>, type array<struct<target_id:string>>, title array<struct<value:string>>, body array<struct<value:string>>, field_has_function array<struct<target_uuid:string>>,"
        f"field_platform array<struct<target_id:int>>, field_is_dependent_of array<struct<target_id:int>>, field_has_documentation {link}, created array<struct<value:long>>",
    )
    at = triples.LEGACY
    want = {
        (triples.TYPE, "http://biii.eu/software", "iri"), (triples.DC + "title", "Icy", "literal"), ("http://www.w3.org/2000/01/rdf-schema#comment", "a & b", "literal"),
        (at + "hasFunction", "http://biii.eu/u-1", "iri"), (at + "hasFunction", "http://e.org/t", "iri"), (at + "hasPlatform", "http://biii.eu/taxonomy/term/7", "iri"),
        (at + "requires", "http://biii.eu/node/9", "iri"), (at + "hasDocumentation", "http://d.org/a%20b", "iri"), (at + "hasDocumentation", "D", "literal"), (at + "hasDocumentation", "E", "literal"),
        (triples.DC + "created", "1970-01-02T01:01:01", "literal"),
    }
    got = triples.legacy_node_triples(doc).collect()
    assert {(r.p, r.o, r.o_kind) for r in got} == want and {r.s for r in got} == {"http://biii.eu/icy"}


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"b": {"x": 1}, "a": {"x": 2}}')
    (tmp_path / "bad.json").write_text("{")
    good, bad = readers.json_documents(spark, f"{tmp_path}/*.json")
    assert good.count() == 1 and bad.count() == 1
    assert {r.key for r in readers.keyed_json(spark, f"{tmp_path}/a.json").collect()} == {"a", "b"}
    (tmp_path / "meta.yaml").write_text('{% set name = "Foo" %}\npackage:\n  name: {{ name|lower }}\n  version: "{{ v }}"\n')
    docs, _ = readers.yaml_documents(spark, f"{tmp_path}/meta.yaml", templated=True)
    assert docs.selectExpr("variant_get(doc, '$.package.name', 'string') n").first().n == "foo"
    (tmp_path / "s.xml").write_text('<urlset xmlns="http://x"><url><loc>u1</loc></url><url><loc>u2</loc><lastmod>d</lastmod></url></urlset>')
    assert {(r.loc, r.lastmod) for r in readers.sitemap(spark, f"{tmp_path}/s.xml").collect()} == {("u1", None), ("u2", "d")}
    (tmp_path / "servers.tsv").write_text("name\turl\nA B\thttp://x\n")
    assert readers.server_table(spark, f"{tmp_path}/servers.tsv").first().name == "A_B"
    assert readers.paged(spark, lambda p: [{"id": p}] if p < 8 else None, "struct<id:long>", at_once=3).count() == 7
    cache = spark.createDataFrame([("1", "d1")], "pmid string, value string")
    got = readers.fetched(spark.createDataFrame([("1",), ("2",)], "pmid string"), "pmid", cache, lambda k: "d" + k)
    assert {(r.pmid, r.value) for r in got.collect()} == {("1", "d1"), ("2", "d2")}
    sinks.json_lines(spark.createDataFrame([(1, "x")], "b int, a string"), f"{tmp_path}/out")
    assert spark.read.text(f"{tmp_path}/out").first().value == '{"a":"x","b":1}'
    assert sinks.markdown(spark.createDataFrame([(True, 1)], "f boolean, n int")).splitlines()[2] == "| ✓ | 1 |"


def test_package_catalogue(spark):
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    tables = {
        "packages": make([("a", "1.2-1", "sid", "main", "sa", "h", "MIT", "b"), ("a", "1.10-1", "experimental", "main", "sa", "h", "MIT", "b"), ("z", "1", "sid", "main", "sz", "h", "", "b")], "package string, version string, release string, component string, source string, homepage string, license string, blend string"),
        "releases": make([("sid", 1), ("experimental", 2)], "release string, sort int"),
        "blends_dependencies": make([("a", "b")], "package string, blend string"),
        "blends_prospectivepackages": make([("p", "main", "0.1-1", "sp", "h", "MIT", "b")], "package string, component string, chlog_version string, source string, homepage string, license string, blend string"),
        "edam": make([("sa", "a", ["t"])], "source string, package string, topics array<string>"),
        "bibref": make([("sa", "doi", "a", 0, "10.1/a")], "source string, key string, package string, rank int, value string"),
        "registry": make([("sa", "bio.tools", "A")], "source string, name string, entry string"),
        "debtags": make([("a", "x"), ("a", "y")], "package string, tag string"),
    }
    rows = {r.package: r for r in packages.catalogue(tables).collect()}
    assert set(rows) == {"a", "p"} and rows["a"].version == "1.2" and rows["p"].release == "vcs"
    assert [t.tag for t in rows["a"].tags] == ["x", "y"] and rows["a"].registries[0].entry == "A"
