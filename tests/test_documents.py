"""Readers, sinks, matching, conversion, commands and streams on small fixtures, and the cases that went wrong before."""

import json
import random

import pytest
from pyspark.sql import functions as F

import toolgraph
from toolgraph import cli
from toolgraph.functions import canon, licenses, predicates, recipes, text
from toolgraph.operators import converter, mappers, matching, packages, publications, quality, triples
from toolgraph.sources import readers, sinks, versions
from toolgraph.streaming import incremental

KEYS = "file long, method string, value string"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def greedy(left, right):
    """The ordered assignment, file by file."""
    taken, out = set(), {}
    for f1 in sorted({x[0] for x in left}):
        mine = {x[1:] for x in left if x[0] == f1}
        free = sorted({x[0] for x in right if x[1:] in mine and x[0] not in taken})
        if free:
            out[f1] = free[0]
            taken.add(free[0])
    return out


def test_assignment_is_the_ordered_one(spark):
    r = random.Random(6)
    for values, files in ((3, 14), (12, 14), (40, 25)):
        left, right = ([(i, r.choice("ab"), f"v{r.randrange(values)}") for i in range(files) for _ in range(r.choice([1, 1, 2]))] for _ in range(2))
        got = matching.assign(spark.createDataFrame(left, KEYS), spark.createDataFrame(right, KEYS)).collect()
        assert {x.f1: x.f2 for x in got} == greedy(left, right) and len(got) == len({x.f2 for x in got})
    # one value that all share: the n-th takes the n-th, in one round
    left, right = [(i, "a", "v") for i in range(60)], [(i * 2, "a", "v") for i in range(40)]
    got = matching.assign(spark.createDataFrame(left, KEYS), spark.createDataFrame(right, KEYS))
    assert {x.f1: x.f2 for x in got.collect()} == {i: 2 * i for i in range(40)}
    nothing = spark.createDataFrame([], KEYS)
    assert matching.assign(nothing, nothing).count() == 0 and matching.matched(nothing, spark.createDataFrame(left, KEYS)).count() == 0


def test_identity_registry(spark):
    matching.register_identity("by_owner", lambda: F.array(F.lower("owner")))
    try:
        rows = spark.createDataFrame([("f", "Me", "Icy", " https://bioconductor.org/packages/3.18/bioc/html/Icy.html", "bioconductor-icy")], "file string, owner string, name string, homepage string, biotoolsID string")
        got = {(x.method, x.value) for x in matching.keys(rows, ["by_owner", "name", "name_insensitive", "biotoolsID_unprefixed"]).collect()}
        assert got == {("by_owner", "me"), ("name", "Icy"), ("name_insensitive", "icy"), ("biotoolsID_unprefixed", "icy")}
        with pytest.raises(ValueError, match="nope"):
            matching.keys(rows, ["nope"])
    finally:
        del matching.IDENTITIES["by_owner"]


def test_snapshots_tell_nulls_apart(spark):
    schema = "id int, x string, y string"
    old = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "s", "t"), (4, "", None)], schema)
    new = spark.createDataFrame([(1, None, "a"), (2, None, None), (3, "s", "t"), (5, "q", "q"), (4, None, "")], schema)
    assert {(r.status, r.id) for r in quality.snapshot_diff(old, new, "id").collect()} == {("M", 1), ("M", 4), ("A", 5)}


def test_graph_texts_are_valid(spark):
    rows = [('s"1', 'p"q', 'o"\n', "literal"), ('s"1', "p", "http://x/<y>", "iri"), ("s2", "p", "\\", "literal")]
    g = spark.createDataFrame(rows, "s string, p string, o string, o_kind string")
    docs = {r.s: json.loads(r.value) for r in triples.jsonld(g).collect()}
    assert docs['s"1'] == {"@id": 's"1', 'p"q': [{"@value": 'o"\n'}], "p": [{"@id": "http://x/<y>"}]} and docs["s2"]["p"] == [{"@value": "\\"}]
    assert '<s%221> <p> <http://x/%3Cy%3E> .' in {r.value for r in triples.ntriples(g).collect()}


def test_jsonld_of_other_writers(spark):
    doc = {"@context": {"x": "y"}, "@graph": [
        {"@id": "biotools:a", "@type": ["schema:SoftwareApplication", "Thing"], "name": "A", "version": [1, {"@value": "2"}], "author": {"@id": "https://orcid.org/1", "name": "followed"}, "http://e.org/p": True},
        {"name": "without an id"},
    ]}
    got = triples.from_jsonld(spark.createDataFrame([(json.dumps(doc),)], "j string").select(F.parse_json("j").alias("doc"))).collect()
    a = "https://bio.tools/a"
    assert {tuple(r) for r in got} == {
        (a, triples.TYPE, triples.SC + "SoftwareApplication", "iri"), (a, triples.TYPE, triples.SC + "Thing", "iri"), (a, triples.SC + "name", "A", "literal"), (a, triples.SC + "version", "1", "literal"),
        (a, triples.SC + "version", "2", "literal"), (a, triples.SC + "author", "https://orcid.org/1", "iri"), (a, "http://e.org/p", "true", "literal"),
        ("https://orcid.org/1", triples.SC + "name", "followed", "literal"), (blank(got, "without an id"), triples.SC + "name", "without an id", "literal"),
    }


def blank(rows, o):
    (s,) = {r.s for r in rows if r.o == o}
    assert s.startswith("urn:blank:")
    return s


JSONLD = {"@context": [
    "https://schema.org/", {"@base": "http://b.org/x/", "@language": "en", "e": "http://e.org/", "nm": "http://x/name", "knows": {"@id": "e:knows", "@type": "@id"}, "steps": {"@id": "e:steps", "@container": "@list"},
     "said": {"@id": "e:said", "@container": "@language"}, "when": {"@id": "e:when", "@type": "xsd:date"}, "xsd": "http://www.w3.org/2001/XMLSchema#", "parent": {"@reverse": "e:child"}, "plain": {"@id": "e:plain", "@language": None}, "gone": None, "kind": "@type", "id": "@id"},
]}


def test_jsonld_contexts(spark):
    doc = JSONLD | {
        "id": "a", "kind": ["Thing", "e:Own"], "nm": "N", "name": ["x", "x", {"@value": "y", "@language": "fr"}], "knows": ["../b", "e:c", "_:q"], "steps": ["one", {"id": "e:two"}, 3], "said": {"de": ["ja", "doch"], "en": "yes"},
        "when": "2020-01-01", "parent": {"id": "e:mother", "plain": "p"}, "gone": "g", "author": {"@id": "http://b", "name": "Bob", "address": {"city": "C", "@context": {"@vocab": "http://v/"}}}, "e:q": {"id": "_:q", "plain": "q"}, "nothing": None, "e:n": 1.5,
    }
    run = lambda *docs: triples.from_jsonld(spark.createDataFrame([(json.dumps(d),) for d in docs], "j string").select(F.parse_json("j").alias("doc")), {}, None, {"https://schema.org": {"@context": {"@vocab": "http://schema.org/"}}}, tagged=True)
    rows = run(doc).collect()
    got = {(r.s, r.p, r.o, r.lang, r.datatype) for r in rows}
    S, E, R, X = "http://schema.org/", "http://e.org/", "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "http://www.w3.org/2001/XMLSchema#"
    a, q, address = "http://b.org/x/a", blank(rows, "q"), blank(rows, "C")
    steps = [r for r in rows if r.p == E + "steps"]
    (first,) = {r.o for r in steps}
    of = lambda s, p: next(r.o for r in rows if (r.s, r.p) == (s, p))
    second = of(first, R + "rest")
    third = of(second, R + "rest")
    assert got == {
        (a, R + "type", S + "Thing", None, None), (a, R + "type", E + "Own", None, None), (a, "http://x/name", "N", "en", None), (a, S + "name", "x", "en", None), (a, S + "name", "y", "fr", None),
        (a, E + "knows", "http://b.org/b", None, None), (a, E + "knows", E + "c", None, None), (a, E + "knows", q, None, None), (q, E + "plain", "q", None, None), (a, E + "q", q, None, None),
        (a, E + "steps", first, None, None), (first, R + "first", "one", "en", None), (first, R + "rest", second, None, None), (second, R + "first", E + "two", None, None), (second, R + "rest", third, None, None),
        (third, R + "first", "3", None, X + "integer"), (third, R + "rest", R + "nil", None, None), (a, E + "said", "ja", "de", None), (a, E + "said", "doch", "de", None), (a, E + "said", "yes", "en", None),
        (a, E + "when", "2020-01-01", None, X + "date"), (E + "mother", E + "child", a, None, None), (E + "mother", E + "plain", "p", None, None), (a, S + "author", "http://b", None, None), ("http://b", S + "name", "Bob", "en", None),
        ("http://b", S + "address", address, None, None), (address, "http://v/city", "C", "en", None), (a, E + "n", "1.5", None, X + "double"),
    }
    # labels of blank nodes hold within a document, equal nameless nodes are one, lists of documents are read
    twice = run({"@context": {"@vocab": "http://v/"}, "@id": "http://1", "p": [{"@id": "_:l", "q": "1"}, {"r": "same"}]}, [{"@context": {"@vocab": "http://v/"}, "@id": "http://2", "p": [{"@id": "_:l", "q": "2"}, {"r": "same"}]}]).collect()
    assert len({r.o for r in twice if r.p == "http://v/p"}) == 3
    assert run({"@id": "http://1", "p": 1}, [], {"@id": "x"}, "text", {"@context": None, "a": {"b": "c"}}).collect() == []


def test_compact_and_turtle_say_the_same_graph(spark, tmp_path):
    rng = random.Random(4)
    names = ["http://e.org/", "http://e.org/a#", "urn:x:", "http://v/", "http://v/a:b", "http://v/@id", "http://v/name", "http://e.org/é ü", "http://e.org//x", "http://e.org/a.b.", "http://e.org/-1"]
    texts = ['q"\\', "a\nb\t", "", "é\u2028", "true", "1", "@x", "http://e.org/"]
    kinds = [("literal", None, None), ("literal", "en", None), ("literal", None, "http://www.w3.org/2001/XMLSchema#integer"), ("literal", None, "http://e.org/T")]
    rows = [(rng.choice(names), rng.choice([*names[3:], triples.TYPE]), *((rng.choice(names), "iri", None, None) if rng.random() < 0.5 else (rng.choice(texts), *rng.choice(kinds)))) for _ in range(400)]
    g = spark.createDataFrame(rows, triples.TAGGED).where(F.col("s") != "http://v/@id").distinct()
    want = sorted(map(repr, g.collect()))
    context = {"@vocab": "http://v/", "e": "http://e.org/", "xsd": "http://www.w3.org/2001/XMLSchema#", "name": {"@id": "http://v/name", "@type": "@id"}, "n": {"@id": "http://v/name", "@type": "xsd:integer"}, "own": "e:a.b."}
    docs = triples.compact(g, context).select(F.parse_json("value").alias("doc"))
    assert sorted(map(repr, triples.from_jsonld(docs, {}, None, tagged=True).collect())) == want
    sinks.turtle(g, f"{tmp_path}/ttl", {"e": "http://e.org/", "v": "http://v/"})
    escaped = g.withColumns({c: F.when((F.col("o_kind") == "iri") | (F.lit(c) != "o"), F.replace(c, F.lit(" "), F.lit("%20"))).otherwise(F.col(c)) for c in ("s", "p", "o")})
    assert sorted(map(repr, readers.turtle(spark, f"{tmp_path}/ttl/*.txt", tagged=True).collect())) == sorted(map(repr, escaped.distinct().collect()))
    by_hand = "PREFIX e: <http://e.org/>\n@base <http://b/> . # c\n<x> a e:T ; e:p 'no', 1, 2.5, true, \"a\\u0041\"@en-GB , [ e:q ( <y> 1e3 ) ] ; .".replace("'no', ", "")
    got = triples.from_turtle(spark.createDataFrame([(by_hand,)], "t string"), tagged=True).collect()
    assert len(got) == 11 and {(r.o, r.lang) for r in got if r.o == "aA"} == {("aA", "en-GB")} and {r.o for r in got if r.datatype} == {"1", "2.5", "true", "1e3"}


def test_links_are_those_of_anchors(spark):
    html = "<link href=\"https://doi.org/10.1/l\"><a href='https://doi.org/10.1/q'>x</a><A id=1 HREF = \" https://dx.doi.org/10.2/r?a=1&amp;b \">y</A><a name=z>n</a><a href=https://doi.org/10.3/u>v</a><abbr href=\"https://doi.org/no\">"
    assert one(spark, text.doi_links(F.lit(html))) == ["10.1/q", "10.2/r?a=1&b", "10.3/u"]


def test_licences(spark):
    raw = ["Ápache", "ＭＩＴ", "GPL (>= 3)", "LGPL (>= 2)", "lgpl 2.1", "LGPL-2", "Artistic-1.0", "bsd", "MPL-2.0", "", None, "file LICENSE", "CC BY-NC-ND 4.0", "something of its own"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, raw string")
    got = [r.spdx for r in licenses.normalise(rows, "raw").orderBy("i").collect()]
    assert got == ["Apache-2.0", "MIT", "GPL-3.0-or-later", "LGPL-2-or-later", "LGPL-2.1-only", "LGPL-2.0-only", "Artistic-1.0", None, "MPL-2.0", None, None, None, "CC-BY-NC-ND-4.0", None]
    own = licenses.normalise(rows, "raw", aliases={"something-of-its-own": "Own-1.0"}, spdx=[*licenses.SPDX, "Some-2.0"], cutoff=0.99)
    assert {r.raw: r.spdx for r in own.collect()}["something of its own"] == "Own-1.0" and {r.raw: r.spdx for r in own.collect()}["MPL-2.0"] is None


def test_package_versions_of_any_length(spark):
    versions = ["0.9", "1.0~rc1", "1.0", "1.0-2", "1.0-10", "1." + "9" * 20, "1.1" + "0" * 25, "1:0.1", "1:0.1:2", "12:0"]
    rows = spark.createDataFrame([(v,) for v in versions], "v string").orderBy(text.debian_sort_key(F.col("v"))).collect()
    assert [r.v for r in rows] == versions


def test_canonical_helpers(spark):
    df = spark.createDataFrame([((1, ("x", 2)), 3)], "a struct<b:int,c:struct<d:string,e:int>>, f int")
    assert canon.drop_paths(df, ["a.c.e", "f", "zz.y"]).first().asDict(True) == {"a": {"b": 1, "c": {"d": "x"}}}
    assert canon.drop_paths(df, ["a.b", "a.c"]).columns == ["f"]
    assert canon.rename_spaces(spark.createDataFrame([(1,)], "`a b` int")).columns == ["a_b"]
    v = spark.createDataFrame([(1, [(2.5,)], (3,))], "v int, l array<struct<v:double>>, s struct<v:int>")
    out = canon.version_at(canon.version_at(canon.version_at(v, "v"), "l[].v"), "s.v").first()
    assert (out.v, out.l[0].v, out.s.v) == ("1", "2.5", "3")


def test_publications_of_three_providers(spark):
    answers = lambda doc: spark.createDataFrame([("10.1/x", json.dumps(doc))], "doi string, j string").select("doi", F.try_parse_json("j").alias("doc"))
    csl = publications.from_csl(answers({"title": "T", "container-title-short": "S", "issued": {"date-parts": [[2001]]}, "author": [{"family": "F"}, {"given": "G", "family": "H"}, {"literal": "Group"}, {}]})).first()
    assert (csl.title, csl.journal, str(csl.date), [a.name for a in csl.authors], csl.citationCount, csl.abstract) == ("T", "S", "2001-01-01", ["F", "G H", "Group"], None, "")
    ref = publications.from_crossref(answers({"title": ["T"], "published-online": {"date-parts": [[2002, 3]]}, "published": {"date-parts": [[1999]]}, "is-referenced-by-count": 4})).first()
    assert (ref.title, str(ref.date), ref.citationCount, ref.authors) == ("T", "2002-03-01", 4, [])
    assert publications.from_europepmc(answers({"resultList": {"result": []}})).count() == 0
    archive = publications.from_europepmc(answers({"resultList": {"result": [{"title": "E", "citedByCount": 9, "journalInfo": {"printPublicationDate": "2003-04-05"}}]}}))
    assert publications.best(archive, publications.from_csl(answers({"title": "T"}))).first().title == "E"


def test_readers(spark, tmp_path):
    (tmp_path / "conf.yaml").write_text("release_version: '3.18'\ndevel: 4\n")
    assert readers.config_value(spark, f"{tmp_path}/conf.yaml", "release_version") == "3.18" and readers.config_value(spark, f"{tmp_path}/conf.yaml", "none", "d") == "d"
    assert {(r.key, r.v) for r in readers.keyed_yaml(spark, f"{tmp_path}/conf.yaml").selectExpr("key", "variant_get(doc, '$', 'string') v").collect()} == {("release_version", "3.18"), ("devel", "4")}
    (tmp_path / "data").mkdir()
    (tmp_path / "data" / "x.bioconductor.citation.html").write_text("<a href='https://doi.org/10.1/x'>")
    assert {(r.folder, r.name) for r in readers.listing(spark, str(tmp_path / "data")).collect()} == {("data", "x.bioconductor.citation.html")}
    assert readers.side_files(spark, f"{tmp_path}/data/*", ".bioconductor.citation.html").first().package == "x"
    (tmp_path / "m1.json").write_text('[{"a": 1}, {"a": 2}]')
    (tmp_path / "m2.json").write_text("<html>")
    assert readers.json_or_none(spark, f"{tmp_path}/m*.json").count() == 2
    (tmp_path / "g.jsonld").write_text('{"@id": "biotools:a", "name": "A"}')
    assert readers.jsonld(spark, f"{tmp_path}/g.jsonld").first().s == "https://bio.tools/a"
    (tmp_path / "o.owl").write_text('<rdf:RDF xmlns:rdf="r" xmlns:owl="o" xmlns:rdfs="s"><owl:Class rdf:about="http://e/topic_1"><rdfs:label>red</rdfs:label></owl:Class><owl:Class rdf:about="http://e/topic_2"><rdfs:label>blue</rdfs:label></owl:Class></rdf:RDF>')
    assert {(r.label, r.entity) for r in readers.ontology(spark, f"{tmp_path}/o.owl").collect()} == {("red", "http://e/topic_1"), ("blue", "http://e/topic_2")}
    (tmp_path / "scores.csv").write_text("url,F1A,d\nu,1,2.5\n")
    assert readers.fair_scores(spark, f"{tmp_path}/scores.csv").select(text.score_of(F.col("F1A")).alias("x")).first().x == 1
    assert readers.fair_scores(spark, f"{tmp_path}/scores.csv", "url string, F1A int, d double").first().d == 2.5
    (tmp_path / "urls.txt").write_text("../../content/data/a.json\n")
    assert readers.url_list(spark, f"{tmp_path}/urls.txt", "../../content/data/", "https://e/").first().url == "https://e/a.json"
    (tmp_path / "diff.txt").write_text("A\tdata/a/a.json\nM\tdata/b/b.json\nD\tdata/c/other.json\n")
    assert quality.changes(readers.git_diff(spark, f"{tmp_path}/diff.txt")).first().asDict() == {"added": 1, "modified": 1, "deleted": 0}
    cache = spark.createDataFrame([("http://up", "200")], "url string, value string")

    def probe(url):
        if "bad" in url:
            raise OSError
        return 404

    asked = spark.createDataFrame([("http://up",), ("http://bad",), ("http://gone",)], "url string")
    assert {(r.url, r.ok) for r in readers.url_statuses(asked, cache, probe).collect()} == {("http://up", True), ("http://bad", False), ("http://gone", False)}

    def graph(url):
        if "bad" in url:
            raise OSError
        return '{"@id": "http://s", "name": "N"}' if "up" in url else "<html>"

    assert readers.fetched_graphs(asked, cache.where("false"), graph).first().o == "N"
    assert readers.nodes(spark, spark.createDataFrame([("1",), ("2",)], "nid string"), spark.createDataFrame([], "nid string, value string"), lambda n: '{"nid": 1}' if n == "1" else None).count() == 1


def test_recipes_with_branches():
    recipe = '{% set name = "Foo" %}{% set v = "1.0" %}{% if name == "Foo" %}a: {{ name|lower }}{% if nothing %}\nb: 1{% else %}\nb: {{ v|replace(".", "_") }}{% endif %}{% elif v %}a: 2{% else %}a: 3{% endif %}{# gone #}\nc: {{ missing }}'
    assert recipes.render(recipe) == "a: foo\nb: 1_0\nc: "


@pytest.mark.parametrize(("template", "text"), [
    ("{{ 'a' ~ 1 ~ x }}", "a1"), ("{{ v.split('.')[0] }}.{{ v[:3] }}-{{ v.split('.')[1:]|join('+') }}", "1.1.2-2+3"), ("{{ x | default('d') }}{{ '' | default('e', true) }}{{ none }}", "deNone"), ("{{ compiler('c') }}{{ pin_compatible('numpy', max_pin='x') }}{{ os.environ.get('A', 'b') }}", ""),
    ("{% for k, n in {'a': 1, 'b': 2}.items() %}{{ loop.index }}{{ k }}{{ n }}{% if not loop.last %},{% endif %}{% endfor %}", "1a1,2b2"), ("{% for i in range(5) if i is odd %}{{ i }}{% else %}none{% endfor %}{% for i in [] %}{% else %}none{% endfor %}", "13none"),
    ("{% set a, b = 'x', 'y' %}{{ b }}{{ a }}{% set c %}<{{ a }}>{% endset %}{{ c }}", "yx<x>"), ("{{ 'yes' if v is defined and 'q' not in v else 'no' }}{{ 1 if false }}", "yes"), ("{{ 2 + 3 * 4 - 7 // 2 }} {{ -1 + 2 }} {{ 7 % 4 == 3 and not false }} {{ 1 < 2 }}", "11 1 True True"),
    ("a\n  {%- if true %} b {%- endif -%} \n c", "a bc"), ("{% raw %}{{ x }}{% endraw %}", "{{ x }}"), ("{{ ('a', 'b')|join('-') }}{{ ['b', 'a']|sort|first }}{{ v|length }}{{ ' x '|trim|upper }}", "a-ba5X"), ("{{ 'it''s' }}{{ \"q\\\"\" }}", 'itsq"'),
    ("{{ '{}-{n}'.format(v, n=2) }}{{ x.y.z }}{{ x()() }}{{ x[0] + 1 }}", "1.2.3-2"), ("{{ v.__class__ }}{{ ''.join(['a', 'b']) }}{{ 'a' 'b' }}{{ '10'|int + 1 }}", "abab11"), ("{% for a in x %}{{ a }}{% endfor %}{% if x == y %}same{% endif %}", "same"),
])
def test_recipe_language(template, text):
    assert recipes.render(template, v="1.2.3") == text


@pytest.mark.parametrize("template", ["{% if %}", "{% if a %}", "{% endfor %}", "{{ a b }}", "{{ 1 + 'a' }}", "{{ a | nosuch }}", "{% include 'x' %}", "{{ range(10**9) }}", "{{ range(1000000) }}", "{{ 'a' * 1000000000 }}", "{% for a in %}{% endfor %}", "{{ ] }}", "{{ 1 / 0 }}", "{% for a, b in 1 %}{% endfor %}"])
def test_recipes_that_fail(template):
    with pytest.raises(recipes.TemplateError):
        recipes.render(template)


def test_versions_of_a_table(spark, tmp_path):
    table = f"{tmp_path}/t"
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("", 4)], "s string, v int")
    assert versions.numbers(spark, table) == [] and versions.commit(rows, table, "s") == 1
    now = lambda n=None, **k: sorted((r.s, r.v) for r in versions.read(spark, table, n, **k).collect() if r.s is not None)
    # a refresh to nothing, of null too; other values stay
    versions.commit(rows.where("s = 'a'").withColumn("v", F.lit(9)), table, "s", ["b", None])
    assert now() == [("", 4), ("a", 9)] and now(1) == [("", 4), ("a", 1), ("b", 2)] and now(values=["a"]) == [("a", 9)]
    assert versions.read(spark, table).count() == 2 and versions.read(spark, table, 1).count() == 4
    # in place, from itself
    versions.without_stale(spark, table, spark.createDataFrame([(9,)], "v int"), "v", "s")
    assert now() == [("a", 9)]
    assert versions.restore(spark, table, 1) == 4 and len(now()) == 3
    # a job whose task fails half-way, and a writer that came too late, leave nothing
    with pytest.raises(Exception, match="half-way"):
        versions.commit(rows.withColumn("v", F.when(F.col("v") == 4, F.raise_error(F.lit("half-way"))).otherwise(F.col("v"))), table, "s")
    with pytest.raises(versions.Conflict):
        versions.commit(rows, table, "s", since=3)
    assert versions.numbers(spark, table) == [1, 2, 3, 4] and len(now()) == 3
    assert len(versions.vacuum(spark, table, 1)) == 3 and versions.numbers(spark, table) == [4] and len(now()) == 3
    versions.commit(rows.limit(0), table)
    assert versions.read(spark, table).count() == 0 and versions.read(spark, table).schema == rows.schema
    with pytest.raises(FileNotFoundError):
        versions.read(spark, f"{tmp_path}/none")


def test_record_files_that_fail_leave_nothing_in_place(spark, tmp_path):
    rows = spark.createDataFrame([(f"d{i}/x.json", "{}" if i != 7 else "no json") for i in range(20)], "path string, doc string").repartition(4)
    with pytest.raises(Exception, match="JSON|Expecting"):
        sinks.record_files(rows, str(tmp_path / "out"), F.col("path"), F.col("doc"))
    assert not list((tmp_path / "out").glob("d*"))
    sinks.record_files(rows.where("doc = '{}'"), str(tmp_path / "out"), F.col("path"), F.col("doc"))
    sinks.record_files(rows.where("doc = '{}'"), str(tmp_path / "out"), F.col("path"), F.lit("[1]"))  # over what is there
    assert {p.read_text() for p in (tmp_path / "out").glob("d*/x.json")} == {"[\n    1\n]"} and len(list((tmp_path / "out").glob("d*"))) == 19


def test_sinks(spark, tmp_path):
    import yaml

    df = spark.createDataFrame([("a", 1, '{"b": {"y": "ü"}, "a": 1}'), ("b", 2, "[1]")], "id string, n int, doc string")
    for form in ("json", "yaml"):
        made = sinks.record_files(df, str(tmp_path / form), F.concat("id", F.lit("/"), "id", F.lit(f".{form}")), F.col("doc"), form)
        assert {r.path for r in made.collect()} == {f"a/a.{form}", f"b/b.{form}"}
    assert (tmp_path / "json" / "a" / "a.json").read_text().startswith('{\n    "a": 1,') and yaml.safe_load((tmp_path / "yaml" / "a" / "a.yaml").read_text()) == {"b": {"y": "ü"}, "a": 1}
    records = spark.createDataFrame([("s1", "X", 1), ("s2", "y", 2)], "source string, tool string, v int")
    sinks.dual(records, spark.createDataFrame([("x",)], "tool string"), "tool", f"{tmp_path}/bronze", f"{tmp_path}/linked")
    sinks.bronze(records.where("source = 's1'").withColumn("v", F.lit(9)), f"{tmp_path}/bronze")
    assert {(r.source, r.v) for r in versions.read(spark, f"{tmp_path}/bronze").collect()} == {("s1", 9), ("s2", 2)} and versions.read(spark, f"{tmp_path}/linked").count() == 1
    sinks.dual(records.where("source = 's2'"), spark.createDataFrame([("y",)], "tool string"), "tool", f"{tmp_path}/bronze", f"{tmp_path}/linked", ["s1"])
    assert {r.source for r in versions.read(spark, f"{tmp_path}/bronze").collect()} == {r.source for r in versions.read(spark, f"{tmp_path}/linked").collect()} == {"s2"}
    sinks.csv(df.withColumn("l", F.array("n")), f"{tmp_path}/csv")
    assert spark.read.csv(f"{tmp_path}/csv", header=True).where("id = 'a'").first().l == "[1]"
    sinks.lines(df.select("id"), f"{tmp_path}/lines")
    assert [r.value for r in spark.read.text(f"{tmp_path}/lines").collect()] == ["a", "b"]
    report = sinks.markdown(spark.range(5), 3).splitlines()
    assert report[2:5] == ["| 0 |", "| 1 |", "| 2 |"] and report[-1] == "2 more rows"


def test_strict_packages(spark):
    full = {c: "x" for c in triples.BIOCONDUCTOR}
    raw = spark.createDataFrame([(json.dumps(full),), (json.dumps({"Package": "p", "Depends": "R"}),), ("{}",)], "j string").select(F.parse_json("j").alias("doc"))
    assert {r.Package for r in mappers.flatten_bioconductor(raw).collect()} == {"x", "p"} and mappers.flatten_bioconductor(raw, strict=True).count() == 1


def test_commands(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "old").mkdir()
    for name, license_ in (("limma", "GPL (>= 2)"), ("edgeR", "MIT + file LICENSE")):
        (tmp_path / "in" / f"{name}.bioconductor.json").write_text(json.dumps({"Package": name, "Author": "A B [aut]", "License": license_, "Version": "1", "Description": "D"}))
    (tmp_path / "in" / "limma.bioconductor.citation.html").write_text("<a href='https://doi.org/10.1/l'>x</a>")
    (tmp_path / "old" / "l.json").write_text(json.dumps({"biotoolsID": "limma", "name": "limma", "homepage": "https://bioconductor.org/packages/release/bioc/html/limma.html", "collectionID": ["Z"], "owner": "me", "license": "Zlib"}))
    (tmp_path / "old" / "m.json").write_text(json.dumps({"biotoolsID": "other", "name": "other"}))
    args = [f"{tmp_path}/in/*.json", f"{tmp_path}/old/*.json", "--out", f"{tmp_path}/out", "--citations", f"{tmp_path}/in/*.html"]
    assert cli.run(spark, ["sync", *args, "--methods", "nope"]) == 1 and "nope" in capsys.readouterr().err
    assert cli.run(spark, ["sync", *args, "--dry-run"]) == 0 and "updated: 2 rows" in capsys.readouterr().out and not (tmp_path / "out").exists()
    assert cli.run(spark, ["sync", *args]) == 0
    read = lambda n: {r.biotoolsID: r for r in spark.read.parquet(f"{tmp_path}/out/{n}").collect()}
    assert set(read("created")) == {"bioconductor-edger"} and set(read("backups")) == {"limma"}
    limma = read("updated")["limma"]
    assert (limma.license, limma.collectionID, limma.owner, limma.publication[0].doi) == ("GPL-2.0-or-later", ["BioConductor", "Z"], "me", "10.1/l") and read("updated")["other"].name == "other"
    assert cli.run(spark, ["convert", args[0], "--out", f"{tmp_path}/c"]) == 0
    (tmp_path / "new").mkdir()
    for i, r in enumerate(spark.read.parquet(f"{tmp_path}/c/converted").toJSON().collect()):
        (tmp_path / "new" / f"{i}.json").write_text(r)
    assert cli.run(spark, ["compare", args[1], f"{tmp_path}/new/*.json", "--out", f"{tmp_path}/m", "--methods", "name_homepage", "name"]) == 0
    found = spark.read.parquet(f"{tmp_path}/m/matches").collect()
    assert [(r.f1, r.f2, r.methods) for r in found] == [("limma", "bioconductor-limma", ["name", "name_homepage"])]
    assert cli.run(spark, ["update", f"{tmp_path}/m/matches", f"{tmp_path}/c/converted", args[1], "--out", f"{tmp_path}/u", "--no-backup"]) == 0
    assert {(r.action, r.n) for r in spark.read.parquet(f"{tmp_path}/u/summary").collect()} == {("created", 1), ("updated", 1), ("only_existing", 1)} and not (tmp_path / "u" / "backups").exists()


def test_public_names(spark):
    assert {n for n in toolgraph.__all__ if callable(getattr(toolgraph, n)) or n == "IDENTITIES"} == set(toolgraph.__all__) and toolgraph.convert is converter.convert
    with pytest.raises(AttributeError):
        toolgraph.nothing


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    rows = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:10:00"), ("b", "2024-01-01 01:30:00")]
    spark.createDataFrame(rows, "k string, t string").selectExpr("k", "cast(t as timestamp) t").coalesce(1).write.parquet(str(src))
    stream = lambda: spark.readStream.schema("k string, t timestamp").parquet(str(src))
    work = incremental.evaluate_new(stream(), "k", "t", lambda df: df.withColumn("score", F.length("k")))
    for name, df, mode in (("evaluated", work, "append"), ("counted", incremental.counts_by_window(stream(), "t", "1 hour", "2 hours", "k"), "complete")):
        df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start().awaitTermination(60)
    assert sorted((r.k, r.score) for r in spark.table("evaluated").collect()) == [("a", 1), ("b", 1)]
    assert sorted((r.k, r.n) for r in spark.table("counted").collect()) == [("a", 2), ("b", 1)]


def test_queries_need_the_training_operators_only_where_they_are():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert len(names) > 100 and set(entry.oracle_sql()) <= names and {"suite_triples", "greedy_match"} <= names


def test_jdbc_reader(spark):
    # without a driver for it, the reader itself says so
    with pytest.raises(Exception, match="(?i)driver|jdbc"):
        readers.jdbc_tables(spark, "jdbc:nosuch:x", ["t"])


def test_versions_without_the_preferred_release(spark):
    p = spark.createDataFrame([("a", "1.0", "experimental"), ("b", "2", "sid"), ("b", "3", "experimental")], "package string, version string, release string")
    assert {(r.package, r.version) for r in packages.latest_versions(p).collect()} == {("a", "1.0"), ("b", "2")}
    assert one(spark, predicates.file_shape(F.lit("x/a.b.jsonld"), "jsonld")) is True
