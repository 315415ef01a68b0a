"""Registered queries over raw documents: made of the driver's tables, flattened, mapped to triples, converted, applied; beside the SQL that gives the same rows from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import authors, canon, licenses, predicates, text
from ..operators import converter, mappers, matching, publications, quality, triples, upsert, validation
from .catalog import _TERMS, Tables, query, spread

SC, BSC, TYPE, EDAM = triples.SC, triples.BSC, triples.TYPE, triples.PREFIXES["edam"]


def fact_sql(source: str, subject: str, facts: list[tuple[str, str, str]], nodes: str = "") -> str:
    """SQL for the triples (predicate, object, kind) of each row of a table; ``nodes``: more rows of (s, p, o, o_kind)."""
    rows = " UNION ALL ".join(f"SELECT {subject} AS s, '{p}' AS p, CAST({o} AS VARCHAR) AS o, '{k}' AS o_kind FROM {source}" for p, o, k in facts)
    return f"SELECT DISTINCT s, p, o, o_kind FROM ({rows}{' UNION ALL ' + nodes if nodes else ''}) WHERE o IS NOT NULL AND o <> ''"


def term_sql(words: str) -> str:
    """SQL for the IRIs of a list of labels."""
    case = " ".join(f"WHEN '{w}' THEN '{EDAM}{e}'" for w, e in _TERMS)
    return f"unnest(list_transform({words}, lambda w: CASE w {case} END))"


def documents(df: DataFrame, **fields: Column) -> DataFrame:
    """(doc VARIANT) of the given fields, nulls kept as nulls."""
    return spread(df).select(F.to_variant_object(F.struct(*(c.alias(n) for n, c in fields.items()))).alias("doc"))


def terms(t: Tables) -> DataFrame:
    return t._spark.createDataFrame([(w, f"http://edamontology.org/{e}") for w, e in _TERMS], "label string, entity string")


def mapped(flat: DataFrame, prefix: str, key: str, table: dict, type_: str = "SoftwareApplication") -> DataFrame:
    return triples.facts(flat, F.concat(F.lit(prefix), key), list(triples.mapper(table, type_).values()))


def cat(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


_SUITE = triples.PREFIXES["galaxytool"]
_SERVERS = [("eu", "https://usegalaxy.eu"), ("org", "https://usegalaxy.org")]


@query(fact_sql("part", f"'{_SUITE}suite' || p_partkey", [
    (TYPE, f"'{SC}SoftwareApplication'", "iri"), (SC + "name", "'suite' || p_partkey", "literal"), (SC + "description", "p_name", "literal"),
    (SC + "url", "CASE WHEN p_partkey % 3 <> 0 THEN 'https://src.example/' || p_partkey END", "iri"), (SC + "applicationSubCategory", term_sql("string_split(p_name, ' ')"), "iri"),
    (SC + "featureList", term_sql("[lower(p_type), 'large']"), "iri"), (SC + "softwareVersion", "p_size", "literal"), (SC + "codeRepository", "'https://home.example/' || p_brand", "iri"),
    (SC + "dateCreated", "'2020-01-0' || (p_partkey % 9 + 1)", "literal"), (SC + "encodingFormat", "unnest(['tabular', lower(p_type)])", "literal"), (BSC + "output", "unnest(['tabular', lower(p_type)])", "literal"),
    (SC + "identifier", f"CASE WHEN p_partkey % 2 = 0 THEN '{triples.PREFIXES['biotools']}Tool' || p_partkey END", "iri"), (SC + "identifier", f"CASE WHEN p_partkey % 5 = 0 THEN '{triples.PREFIXES['bioconda']}conda' || p_partkey END", "iri"),
    (SC + "isPartOf", "'https://wf.example/' || (p_partkey % 10)", "iri"), (SC + "isPartOf", "CASE WHEN p_size % 3 > 0 THEN 'https://usegalaxy.eu' END", "iri"),
    (SC + "isPartOf", "CASE WHEN p_partkey % 2 > 0 THEN 'https://usegalaxy.org' END", "iri"), (SC + "keywords", "p_brand", "literal"),
], f"SELECT 'https://usegalaxy.eu', '{TYPE}', '{SC}WebSite', 'iri' FROM part WHERE p_size % 3 > 0 UNION ALL SELECT 'https://usegalaxy.org', '{TYPE}', '{SC}WebSite', 'iri' FROM part WHERE p_partkey % 2 > 0"))
def suite_triples(t):
    k = F.col("p_partkey")
    raw = documents(
        t.part, Suite_ID=cat("suite", k), Description=F.col("p_name"), Suite_source=F.when(k % 3 != 0, cat("https://src.example/", k)), EDAM_topics=F.split("p_name", " "),
        EDAM_operations=F.array(F.lower("p_type"), F.lit("large")), Suite_version=F.col("p_size"), Homepage=cat("https://home.example/", F.col("p_brand")), Suite_first_commit_date=cat("2020-01-0", k % 9 + 1),
        Tool_output_formats=F.array(F.lit("tabular"), F.lower("p_type")), Suite_conda_package=F.when(k % 5 == 0, cat(" conda", k, " ")), Related_Workflows=F.array(F.struct(cat("https://wf.example/", k % 10).alias("link"))),
        ToolShed_categories=F.array("p_brand"), Number_of_tools_on_eu=F.col("p_size") % 3, Number_of_tools_on_org=k % 2, Number_of_tools_on_gone=F.lit(5), **{"bio.tool_ID": F.when(k % 2 == 0, cat("Tool", k)).otherwise("")},
    )
    flat = mappers.flatten_suites(raw, terms(t), t._spark.createDataFrame(_SERVERS, "name string, url string"))
    return triples.union_graph(mapped(flat, _SUITE, "Suite_ID", triples.SUITE), mappers.sites(flat, "servers"))


_DEBIAN, _P = triples.PREFIXES["debianmed"], triples.PREFIXES


@query(fact_sql("supplier", f"'{_DEBIAN}pkg' || s_suppkey", [
    (TYPE, f"'{SC}SoftwareApplication'", "iri"), (SC + "name", "'pkg' || s_suppkey", "literal"), (SC + "url", "'https://h.example/' || s_suppkey", "iri"),
    (SC + "applicationSubCategory", term_sql("['red', CASE WHEN s_nationkey % 2 = 0 THEN 'blue' ELSE 'unknown' END]"), "iri"), (SC + "citation", "unnest(['doi:10.1/' || s_suppkey, 'pmid:' || s_nationkey])", "literal"),
    (SC + "license", "'GPL-' || (s_suppkey % 3 + 1)", "literal"), (SC + "softwareVersion", "s_nationkey || '.1'", "literal"),
    (SC + "identifier", f"unnest(['{_P['biotools']}tool' || s_suppkey, '{_P['scicrunch']}SCR_' || s_suppkey, '{_P['guix']}g' || s_suppkey])", "iri"),
    (SC + "identifier", f"unnest(CASE WHEN s_suppkey % 4 = 0 THEN ['{_P['bioconda']}atac', '{_P['bioconda']}meryl'] ELSE ['{_P['bioconda']}pkg' || s_suppkey] END)", "iri"), (SC + "identifier", "'omictools:OMICS_' || s_suppkey", "literal"),
    (SC + "featureList", term_sql("['steel']"), "iri"), (SC + "encodingFormat", term_sql("['red', 'green', 'none']"), "iri"), (SC + "additionalType", term_sql("['small', 'large']"), "iri"),
    (BSC + "input", term_sql("['small', 'red']"), "iri"), (BSC + "output", term_sql("['large', 'green']"), "iri"), (SC + "keywords", "'field::' || s_nationkey", "literal"),
]))
def debian_triples(t):
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    pair = lambda a, b, x, y: F.struct((F.lit(x) if isinstance(x, str) else x).alias(a), (F.lit(y) if isinstance(y, str) else y).alias(b))
    registry = lambda name, entry: pair("name", "entry", name, entry)
    scope = F.struct(
        F.array(F.lit("steel")).alias("function"), F.array(F.struct(F.lit("small").alias("data"), F.array(F.lit("red")).alias("format"))).alias("input"),
        F.array(F.struct(F.lit("large").alias("data"), F.array(F.lit("green"), F.lit("none")).alias("format"))).alias("output"),
    )
    raw = documents(
        t.supplier, package=cat("pkg", k), homepage=cat("https://h.example/", k), topics=F.array(F.lit("red"), F.when(n % 2 == 0, "blue").otherwise("unknown")),
        bib=F.array(pair("key", "value", "doi", cat("10.1/", k)), pair("key", "value", "pmid", n.cast("string"))), license=cat("GPL-", k % 3 + 1), version=cat(n, ".1"),
        registries=F.array(registry("bio.tools", cat("Tool", k)), registry("conda:bioconda", F.when(k % 4 == 0, "atac, meryl").otherwise(cat("pkg", k))), registry("SciCrunch", cat("SCR_", k)), registry("OMICtools", cat("OMICS_", k)), registry("guix", cat("g", k))),
        edam_scopes=F.array(scope), tags=F.array(F.struct(cat("field::", n).alias("tag"))),
    )
    return triples.union_graph(mapped(mappers.flatten_debian(raw, terms(t)), _DEBIAN, "package", triples.DEBIAN))


@query(fact_sql("customer", f"'{_P['bioconductor']}' || c_name", [
    (TYPE, f"'{SC}SoftwareApplication'", "iri"), (SC + "name", "c_name", "literal"), (SC + "description", "'About \"' || c_name || '\"'", "literal"), (SC + "url", "CASE WHEN c_custkey % 3 = 0 THEN 'https://u.example/' || c_custkey END", "iri"),
    (SC + "license", "'Artistic-2.0'", "literal"), (SC + "softwareVersion", "c_nationkey || '.0'", "literal"), (SC + "dateModified", "'2024-01-02'", "literal"), (SC + "maintainer", "c_mktsegment", "literal"),
    (SC + "alternateName", "lower(c_name)", "literal"), (SC + "codeRepository", "'https://git.example/' || c_custkey", "iri"), (SC + "author", "c_name || ' [aut]'", "literal"),
    (SC + "hasPart", "unnest(['R', 'pkg' || c_nationkey])", "literal"), (SC + "keywords", "unnest(['Software', c_mktsegment])", "literal"),
]))
def bioconductor_triples(t):
    k = F.col("c_custkey")
    raw = documents(
        t.customer, Package=F.col("c_name"), Description=cat('About "', F.col("c_name"), '"'), URL=F.when(k % 3 == 0, cat("https://u.example/", k)), License=F.lit("Artistic-2.0"), Version=cat(F.col("c_nationkey"), ".0"),
        Maintainer=F.col("c_mktsegment"), Title=F.lower("c_name"), git_url=cat("https://git.example/", k), Author=cat(F.col("c_name"), " [aut]"), Depends=F.array(F.lit("R"), cat("pkg", F.col("c_nationkey"))),
        biocViews=F.array(F.lit("Software"), F.col("c_mktsegment")), **{"Date/Publication": F.lit("2024-01-02")},
    )
    return triples.union_graph(mapped(mappers.flatten_bioconductor(raw), _P["bioconductor"], "Package", triples.BIOCONDUCTOR))


@query(fact_sql("part", f"'{_P['biocontainers']}box' || p_partkey", [
    (TYPE, f"'{SC}SoftwareApplication'", "iri"), (SC + "name", "'box' || p_partkey", "literal"), (SC + "description", "'a ' || chr(10) || p_name", "literal"), (SC + "license", "p_type", "literal"),
    (SC + "identifier", f"CASE WHEN p_partkey % 3 = 0 THEN '{_P['biotools']}tool' || p_partkey END", "iri"), (SC + "url", "CASE WHEN p_partkey % 2 = 0 THEN 'https://h.example/' || p_partkey END", "iri"),
    (SC + "keywords", "unnest(string_split(p_name, ' '))", "literal"), (SC + "citation", "CASE WHEN p_partkey % 2 = 0 THEN unnest(['doi:10.1/' || p_partkey, 'DOI:10.2/' || p_partkey]) END", "literal"),
]))
def container_triples(t):
    k = F.col("p_partkey")
    even = cat('["biotools:Tool', k, '", {"doi": "10.1/', k, '"}, "DOI:10.2/', k, '", {"doi": null}, "other:1"]')
    odd = cat('[{"biotools": "Tool', k, '"}]')
    fields = F.to_json(F.struct(cat("box", k).alias("name"), cat("a \n", F.col("p_name")).alias("description"), F.col("p_type").alias("license"), cat("https://h.example/", k).alias("home_url"), F.split("p_name", " ").alias("keywords")))
    raw = spread(t.part).select(F.parse_json(F.concat(F.substring(fields, F.lit(1), F.length(fields) - 1), F.lit(', "identifiers": '), F.when(k % 2 == 0, even).otherwise(odd), F.lit("}"))).alias("doc"))
    answers = t.part.select(cat(_P["biotools"], "tool", k).alias("url"), (k % 3 == 0).alias("ok")).unionAll(t.part.select(cat("https://h.example/", k), k % 2 == 0))
    return triples.union_graph(mapped(mappers.flatten_containers(raw, answers), _P["biocontainers"], "name", triples.CONTAINER))


@query(fact_sql("orders", "'https://wf.example/' || o_orderkey", [
    (TYPE, f"'{SC}ComputationalWorkflow'", "iri"), (SC + "url", "'https://wf.example/' || o_orderkey", "literal"), (SC + "name", "o_orderpriority", "literal"), (SC + "citation", "CASE WHEN o_orderkey % 2 = 0 THEN '10.5/' || o_orderkey END", "literal"),
    (SC + "softwareVersion", "o_orderkey % 5", "literal"), (SC + "author", "unnest(['c' || o_custkey, 'x'])", "literal"), (SC + "featureList", term_sql("['steel', o_orderstatus]"), "iri"), (SC + "applicationSubCategory", term_sql("['red']"), "iri"),
    (SC + "dateCreated", "'2020-05-06'", "literal"), (SC + "isPartOf", "CASE o_orderkey % 3 WHEN 0 THEN 'https://workflowhub.eu' WHEN 1 THEN 'https://usegalaxy.eu' END", "iri"), (SC + "keywords", "o_orderpriority", "literal"),
], f"SELECT unnest(['https://workflowhub.eu', 'https://usegalaxy.eu']), '{TYPE}', '{SC}WebSite', 'iri'"))
def workflow_triples(t):
    k = F.col("o_orderkey")
    raw = documents(
        t.orders, link=cat("https://wf.example/", k), name=F.col("o_orderpriority"), doi=F.when(k % 2 == 0, cat("10.5/", k)), latest_version=k % 5, creators=F.array(cat("c", F.col("o_custkey")), F.lit("x")),
        edam_operation=F.array(F.lit("steel"), F.col("o_orderstatus")), edam_topic=F.array(F.lit("red")), create_time=F.lit("2020-05-06"), tags=F.array("o_orderpriority"),
        source=F.when(k % 3 == 0, "WorkflowHub").when(k % 3 == 1, "https://usegalaxy.eu").otherwise("elsewhere"),
    )
    flat = mappers.flatten_workflows(raw, terms(t))
    return triples.union_graph(mapped(flat, "", "link", triples.WORKFLOW, "ComputationalWorkflow"), mappers.sites(flat, "part_of"))


_IO = "{{\"data\":{{\"term\":\"{0}' || s_nationkey || '\",\"uri\":\"http://e.example/{0}\"}},\"format\":[{{\"term\":\"f\",\"uri\":\"http://e.example/f\"}}]}}"
_PARAMETER = lambda side: f"'urn:parameter:' || sha256('{_IO.format(side)}')"
_ORCID = "'https://orcid.org/0000-0000-0000-' || s_suppkey"


@query(fact_sql("supplier", "'https://bio.tools/t' || s_suppkey", [
    (TYPE, f"'{SC}SoftwareApplication'", "iri"), (triples.DCT + "conformsTo", "'https://bioschemas.org/profiles/ComputationalTool/1.0-RELEASE'", "literal"), (SC + "name", "s_name", "literal"), (SC + "description", "'d' || s_suppkey", "literal"),
    (SC + "url", "'https://h.example/' || s_suppkey", "literal"), (SC + "additionalType", "unnest(['Library', 'Workflow'])", "literal"), (SC + "license", "CASE WHEN s_suppkey % 2 = 0 THEN 'MIT' END", "literal"), (SC + "softwareVersion", "s_nationkey", "literal"),
    (SC + "operatingSystem", "'Linux'", "literal"), (SC + "author", _ORCID, "iri"), (SC + "provider", "'Org' || s_nationkey", "literal"), (SC + "contributor", "'NoKind'", "literal"), (SC + "funder", "'Fund' || s_nationkey", "literal"),
    (SC + "citation", "'pubmed:' || s_suppkey", "literal"), (SC + "citation", "CASE WHEN s_suppkey % 3 = 0 THEN 'https://doi.org/10.1/%5B' || s_suppkey || '%5D' END", "iri"), (SC + "featureList", "'http://edamontology.org/operation_' || s_nationkey", "iri"),
    (BSC + "input", _PARAMETER("in"), "iri"), (BSC + "output", _PARAMETER("out"), "iri"), (SC + "applicationSubCategory", "'http://edamontology.org/topic_' || s_nationkey", "iri"), (SC + "isAccessibleForFree", "s_suppkey % 2 = 0", "literal"),
    (SC + "softwareHelp", "'https://help.example/a%7C' || s_suppkey", "iri"), (SC + "termsOfService", "'https://terms.example'", "iri"),
], " UNION ALL ".join([
    f"SELECT {_ORCID}, '{TYPE}', '{SC}Person', 'iri' FROM supplier", f"SELECT {_ORCID}, '{SC}name', s_name, 'literal' FROM supplier", f"SELECT 'https://doi.org/10.1/%5B' || s_suppkey || '%5D', '{TYPE}', '{SC}CreativeWork', 'iri' FROM supplier WHERE s_suppkey % 3 = 0",
    *(f"SELECT {_PARAMETER(x)}, '{p}', {o}, '{k}' FROM supplier" for x in ("in", "out") for p, o, k in (
        (TYPE, f"'{BSC}FormalParameter'", "iri"), (SC + "name", f"'{x}' || s_nationkey", "literal"), (SC + "additionalType", f"'http://e.example/{x}'", "iri"), (SC + "encodingFormat", "'http://e.example/f'", "iri"))),
])))
def tool_triples(t):
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    none, texts = F.lit(None).cast("string"), lambda *x: F.array(*map(F.lit, x))
    credit = lambda name, kind, orcid, *roles: F.struct(name.alias("name"), (F.lit(kind) if kind else none).alias("typeEntity"), orcid.alias("orcidid"), texts(*roles).alias("typeRole"))
    side = lambda x: F.array(F.struct(F.struct(cat(x, n).alias("term"), F.lit(f"http://e.example/{x}").alias("uri")).alias("data"), F.array(F.struct(F.lit("f").alias("term"), F.lit("http://e.example/f").alias("uri"))).alias("format")))
    page = lambda kind, url: F.struct(texts(kind).alias("type"), url.alias("url"))
    docs = spread(t.supplier).select(
        cat("t", k).alias("biotoolsID"), F.col("s_name").alias("name"), cat("d", k).alias("description"), cat("https://h.example/", k).alias("homepage"), texts("Library", "Workflow").alias("toolType"),
        F.when(k % 2 == 0, "MIT").alias("license"), F.array(n.cast("string")).alias("version"), texts("Linux").alias("operatingSystem"),
        F.array(credit(F.col("s_name"), "Person", cat("https://orcid.org/0000-0000-0000-", k), "Developer"), credit(cat("Org", n), "Institute", none, "Provider"), credit(F.lit("NoKind"), None, F.lit("https://orcid.org/9"), "Contributor"), credit(cat("Fund", n), "Funding agency", none, "Documentor")).alias("credit"),
        F.array(F.struct(F.when(k % 3 == 0, cat("10.1/[", k, "]")).otherwise("10.1/<x>").alias("doi"), k.cast("string").alias("pmid"), none.alias("pmcid"))).alias("publication"),
        F.array(F.struct(F.array(F.struct(cat("http://edamontology.org/operation_", n).alias("uri"))).alias("operation"), side("in").alias("input"), side("out").alias("output"))).alias("function"),
        F.array(F.struct(cat("http://edamontology.org/topic_", n).alias("uri"))).alias("topic"), F.when(k % 2 == 0, "Free of charge").otherwise("Commercial").alias("cost"),
        F.array(page("General", cat("https://help.example/a|", k)), page("Terms of use", F.lit("https://terms.example")), page("General", F.lit("https://app.gitter.im/x"))).alias("documentation"),
    )
    return triples.union_graph(triples.facts(docs, cat("https://bio.tools/", F.col("biotoolsID")), list(triples.tool_rules().values())), triples.tool_node_triples(docs))


@query(fact_sql("part", f"'{_P['bioconda']}rec' || p_partkey", [
    (TYPE, f"'{SC}SoftwareApplication'", "iri"), (SC + "name", "'rec' || p_partkey", "literal"), (SC + "description", "p_name", "literal"), (SC + "url", "'https://h.example'", "literal"), (SC + "citation", "'doi:10.1/' || p_partkey", "literal"),
    (SC + "identifier", "'usegalaxy-eu:x'", "literal"), (SC + "identifier", f"'{_P['biotools']}tool' || p_partkey", "iri"), (SC + "license", "p_type", "literal"), (SC + "softwareVersion", "p_size", "literal"), (SC + "alternateName", "p_name", "literal"),
    (SC + "downloadUrl", "unnest(['https://a.example', 'https://b.example/' || p_partkey])", "literal"), (SC + "maintainer", "p_brand", "literal"),
]))
def recipe_triples(t):
    k, name = F.col("p_partkey"), lambda c, n: c.alias(n)
    raw = documents(
        t.part, package=F.struct(name(cat("rec", k), "name"), name(F.col("p_size"), "version")), about=F.struct(name(F.col("p_name"), "summary"), name(F.lit("https://h.example"), "home"), name(F.col("p_type"), "license")),
        source=F.struct(name(F.array(F.lit("https://a.example"), cat("https://b.example/", k)), "url")),
        extra=F.struct(name(F.array(cat("biotools:Tool", k), cat("doi:10.1/", k), F.lit("usegalaxy-eu:x")), "identifiers"), name(F.array("p_brand"), "recipe-maintainers")),
    )
    return triples.union_graph(mapped(triples.flatten_recipes(raw), _P["bioconda"], "name", triples.RECIPE))


def nodes(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    one = lambda name, c: F.array(F.struct(c.alias(name)))
    return spread(t.part).select(
        one("alias", F.when(k % 2 == 0, cat("/n", k)).otherwise(F.lit(""))).alias("path"), one("target_id", F.when(k % 5 == 0, "training").otherwise("software")).alias("type"), one("value", F.col("p_name")).alias("title"),
        one("value", cat("<p>x &amp; ", k, "</p>")).alias("body"), one("target_uuid", cat("f-", F.col("p_size"))).alias("field_has_function"), F.array(F.struct(cat(" https://p.example/", k, " ").alias("uri"), F.col("p_type").alias("title"))).alias("field_has_reference_publication"),
        one("value", F.col("p_brand")).alias("field_has_license"), one("target_id", k.cast("int")).alias("field_is_dependent_of"), one("value", F.lit("2021-02-03T04:05:06+00:00")).alias("changed"),
    )


@query(fact_sql("part", "'http://biii.eu/' || CASE WHEN p_partkey % 2 = 0 THEN 'n' || p_partkey ELSE replace(lower(p_name), ' ', '-') END", [
    (TYPE, f"'{SC}SoftwareApplication'", "iri"), (SC + "name", "p_name", "literal"), (SC + "description", "'x & ' || p_partkey", "literal"), (SC + "featureList", "'http://biii.eu/f-' || p_size", "iri"), (SC + "citation", "'https://p.example/' || p_partkey", "iri"),
    (SC + "citation", "p_type", "literal"), (SC + "license", "p_brand", "literal"), (SC + "softwareRequirements", "'http://biii.eu/node/' || p_partkey", "iri"), (SC + "dateModified", "'2021-02-03T04:05:06+00:00'", "literal"),
]).replace(" FROM part", " FROM (SELECT * FROM part WHERE p_partkey % 5 <> 0)"))
def node_triples(t):
    return triples.triples(triples.flatten_nodes(nodes(t)), F.col("node"), list(triples.mapper(triples.NODE).values()))


_OLD = triples.LEGACY


@query(fact_sql("part", "'http://biii.eu/n' || p_partkey", [
    (TYPE, "CASE WHEN p_partkey % 5 = 0 THEN 'http://biii.eu/training' ELSE 'http://biii.eu/software' END", "iri"), (triples.DC + "title", "p_name", "literal"), ("http://www.w3.org/2000/01/rdf-schema#comment", "'x & ' || p_partkey", "literal"),
    (_OLD + "hasFunction", "'http://biii.eu/f-' || p_size", "iri"), (_OLD + "hasReferencePublication", "'http://biii.eu/%20https://p.example/' || p_partkey || '%20'", "iri"), (_OLD + "hasReferencePublication", "p_type", "literal"),
    (_OLD + "hasLicense", "p_brand", "literal"), (_OLD + "requires", "'http://biii.eu/node/' || p_partkey", "iri"), (triples.DC + "modified", "'1970-01-02T03:46:40'", "literal"),
]).replace(" FROM part", " FROM (SELECT * FROM part WHERE p_partkey % 2 = 0)"))
def legacy_node_triples(t):
    raw = nodes(t).where(F.get("path", F.lit(0))["alias"] != "").withColumn("changed", F.array(F.struct(F.lit(0).cast("long").alias("value")), F.struct(F.lit(100_000).cast("long").alias("value"))))
    return triples.legacy_node_triples(raw)


@query(fact_sql("supplier", "'urn:supplier:' || s_suppkey", [(TYPE, f"'{SC}Organization'", "iri"), (SC + "name", "s_name || ' \"' || s_suppkey || '\" \\ '", "literal"), (SC + "location", "'urn:nation:' || s_nationkey", "iri")]))
def jsonld_round_trip(t):
    name = F.concat("s_name", F.lit(' "'), "s_suppkey", F.lit('" \\ '))
    g = triples.triples(t.supplier, cat("urn:supplier:", F.col("s_suppkey")), [triples.Rule(TYPE, F.lit(SC + "Organization"), True), triples.Rule(SC + "name", name), triples.Rule(SC + "location", cat("urn:nation:", F.col("s_nationkey")), True)])
    return triples.from_jsonld(triples.jsonld(g).select(F.try_parse_json("value").alias("doc")))


@query("""SELECT '<urn:a%20' || s_suppkey || '%3C%22> <http://schema.org/url> <https://e.example/%7B' || s_name || '%7D> .' AS value FROM supplier""")
def ntriples_iris(t):
    g = triples.triples(t.supplier, cat("urn:a ", F.col("s_suppkey"), '<"'), [triples.Rule(SC + "url", cat("https://e.example/{", F.col("s_name"), "}"), True)])
    return triples.ntriples(g)


@query("SELECT 3 * count(*) AS n FROM supplier")
def triple_total(t):
    g = triples.triples(t.supplier, F.col("s_suppkey"), [triples.Rule(SC + x, F.col(c)) for x, c in (("name", "s_name"), ("size", "s_nationkey"), ("key", "s_suppkey"))])
    return triples.triple_count(triples.union_graph(g, g))


@query("SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://bio.tools/x' || page_id WHEN 1 THEN 'http://edamontology.org/topic_1' WHEN 2 THEN 'https://e.org/a:b' ELSE 'unknown:x' END AS iri FROM pages")
def curie_expand(t):
    k = F.col("page_id")
    curie = F.when(k % 4 == 0, cat("biotools:x", k)).when(k % 4 == 1, "edam:topic_1").when(k % 4 == 2, "https://e.org/a:b").otherwise("unknown:x")
    return t.pages.select("page_id", triples.expand(curie).alias("iri"))


_RAW_LICENSE = "CASE c_custkey % 5 WHEN 0 THEN 'MIT + file LICENSE' WHEN 1 THEN 'GPL (>= 3)' WHEN 2 THEN 'Artistic-2.0' WHEN 3 THEN 'Ápache' ELSE 'unknown' END"
_SPDX = "CASE c_custkey % 5 WHEN 0 THEN 'MIT' WHEN 1 THEN 'GPL-3.0-or-later' WHEN 2 THEN 'Artistic-2.0' WHEN 3 THEN 'Apache-2.0' END"


def package_rows(t: Tables) -> DataFrame:
    return spread(t.customer).select(
        cat("Pkg", F.col("c_custkey")).alias("Package"), cat(F.col("c_name"), " [aut, cre], Fund ", F.col("c_nationkey"), " [fnd]").alias("Author"), F.col("c_mktsegment").alias("Description"),
        F.lit(None).cast("string").alias("URL"), F.expr(_RAW_LICENSE).alias("License"), cat("1.", F.col("c_nationkey")).alias("Version"), "c_custkey",
    )


def existing_rows(t: Tables) -> DataFrame:
    """Documents of two thirds of the packages, some under another name."""
    c = spread(t.customer).where("c_custkey % 3 <> 0")
    return c.select(
        cat("bioconductor-pkg", F.col("c_custkey")).alias("biotoolsID"), F.when(F.col("c_custkey") % 3 == 1, cat("Pkg", F.col("c_custkey"))).otherwise(cat("Old", F.col("c_custkey"))).alias("name"), F.lit("old").alias("description"),
        F.lit("Zlib").alias("license"), F.array(F.lit("0.1")).alias("version"), F.lit("2019-01-01").alias("additionDate"), F.array(F.lit("Zoo")).alias("collectionID"), F.array(F.struct(F.lit("10.9/z").alias("doi"))).alias("publication"), F.lit("kept").alias("owner"),
    )


def citation_pages(t: Tables) -> DataFrame:
    html = cat('<link href="https://doi.org/10.0/no"><A class="x" HREF=\' https://doi.org/10.1/p', F.col("c_custkey"), ' \'>a</A><a href="https://e.org">b</a><a href="http://dx.doi.org/10.2/q?a=1&amp;b=2">c</a>')
    return spread(t.customer).where("c_custkey % 2 = 0").select(cat("Pkg", F.col("c_custkey")).alias("package"), html.alias("html"))


@query(f"""SELECT 'bioconductor-pkg' || c_custkey AS id, 'biotools:bioconductor-pkg' || c_custkey AS curie, 'Pkg' || c_custkey AS name, c_mktsegment AS description, '' AS download, 'https://bioconductor.org/packages/Pkg' || c_custkey AS homepage,
'https://bioconductor.org/packages/Pkg' || c_custkey AS manual, {_SPDX} AS license, '1.' || c_nationkey AS version, c_name || '/Developer,Maintainer;Fund ' || c_nationkey || '/Contributor' AS credit,
CASE WHEN c_custkey % 2 = 0 THEN '10.1/p' || c_custkey || ' 10.2/q?a=1&b=2' END AS dois, CASE WHEN c_custkey % 3 <> 0 THEN '2019-01-01' END AS added, CASE WHEN c_custkey % 3 <> 0 THEN 'Zoo' ELSE 'BioConductor' END AS collection,
'R|Linux,Mac,Windows|bioconductor_import|Command-line tool,Library' AS constants FROM customer""")
def convert_packages(t):
    out = converter.convert(package_rows(t), citation_pages(t), existing_rows(t))
    join = lambda c: F.array_join(c, ",")
    return out.select(
        F.col("biotoolsID").alias("id"), F.col("biotoolsCURIE").alias("curie"), "name", "description", F.col("download")[0]["url"].alias("download"), "homepage", F.col("documentation")[0]["url"].alias("manual"), "license", F.col("version")[0].alias("version"),
        F.array_join(F.transform("credit", lambda c: F.concat_ws("/", c["name"], F.array_join(c["typeRole"], ","))), ";").alias("credit"), F.array_join(F.transform("publication", lambda p: p["doi"]), " ").alias("dois"),
        F.col("additionDate").alias("added"), join("collectionID").alias("collection"), F.concat_ws("|", join("language"), join("operatingSystem"), "owner", join("toolType")).alias("constants"),
    )


def synced(t: Tables) -> dict[str, DataFrame]:
    return converter.sync(package_rows(t).drop("c_custkey"), existing_rows(t), ["name"], citation_pages(t))


@query(f"""SELECT 'bioconductor-pkg' || c_custkey AS id, CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment ELSE 'old' END AS description, CASE WHEN c_custkey % 3 = 1 THEN {_SPDX} ELSE 'Zlib' END AS license, CASE WHEN c_custkey % 3 = 1 THEN '1.' || c_nationkey ELSE '0.1' END AS version,
CASE WHEN c_custkey % 3 = 1 THEN 'BioConductor,Zoo' ELSE 'Zoo' END AS collection, CASE WHEN c_custkey % 6 = 4 THEN '10.1/p' || c_custkey || ' 10.2/q?a=1&b=2' ELSE '10.9/z' END AS dois, 'kept' AS owner FROM customer WHERE c_custkey % 3 <> 0""")
def update_catalogue(t):
    out = synced(t)["updated"]
    return out.select(F.col("biotoolsID").alias("id"), "description", "license", F.col("version")[0].alias("version"), F.array_join("collectionID", ",").alias("collection"), F.array_join(F.transform("publication", lambda p: p["doi"]), " ").alias("dois"), "owner")


@query("SELECT 'created' AS action, count(*) AS n FROM customer WHERE c_custkey % 3 <> 1 UNION ALL SELECT 'updated', count(*) FROM customer WHERE c_custkey % 3 = 1 UNION ALL SELECT 'only_existing', count(*) FROM customer WHERE c_custkey % 3 = 2")
def sync_summary(t):
    return synced(t)["summary"]


@query("SELECT 'bioconductor-pkg' || c_custkey AS id, 'old' AS description, '0.1' AS version FROM customer WHERE c_custkey % 3 = 1")
def backups_before_update(t):
    return synced(t)["backups"].select(F.col("biotoolsID").alias("id"), "description", F.col("version")[0].alias("version"))


@query("SELECT 'bioconductor-pkg' || c_custkey AS id, 'bioconductor' AS source, 'Pkg' || c_custkey AS package, c_mktsegment AS description FROM customer")
def source_copies(t):
    got = synced(t)["sources"].select(F.col("biotoolsID").alias("id"), "source", F.parse_json("document").alias("d"))
    return got.select("id", "source", F.variant_get("d", "$.Package", "string").alias("package"), F.variant_get("d", "$.Description", "string").alias("description"))


_DATE = "strftime(make_date(2000 + o_orderkey % 20, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 12 + 1 ELSE 1 END, CASE WHEN o_orderkey % 3 > 1 THEN o_orderkey % 28 + 1 ELSE 1 END), '%Y-%m-%d')"


@query(f"""SELECT '10.1/' || o_orderkey AS doi, CASE o_orderkey % 4 WHEN 0 THEN 'A b' ELSE '' END AS abstract, CASE WHEN o_orderkey % 4 = 2 THEN 'Full ' || o_custkey ELSE 'Given Fam' || o_custkey || CASE WHEN o_orderkey % 4 = 0 THEN '|Group' ELSE '' END END AS authors,
CASE WHEN o_orderkey % 4 IN (1, 2) THEN o_custkey::VARCHAR END AS citations, CASE WHEN o_orderkey % 4 = 2 THEN '2011-03-04' ELSE {_DATE} END AS date, CASE WHEN o_orderkey % 4 = 1 THEN 'Short J' ELSE 'J' || o_orderstatus END AS journal,
'T' || o_orderkey AS title FROM orders WHERE o_orderkey % 4 <> 3""")
def publication_records(t):
    k = F.col("o_orderkey")
    parts = F.slice(F.array(k % 20 + 2000, k % 12 + 1, k % 28 + 1), 1, (k % 3 + 1).cast("int"))
    dated = F.struct(F.array(parts).alias("date-parts"))
    person = F.struct(F.lit("Given").alias("given"), cat("Fam", F.col("o_custkey")).alias("family"), F.lit(None).cast("string").alias("literal"))
    group = F.struct(F.lit(None).cast("string").alias("given"), F.lit(None).cast("string").alias("family"), F.lit("Group").alias("literal"))
    doi = cat("10.1/", k).alias("doi")

    def answers(remainder: int, **fields: Column) -> DataFrame:
        return t.orders.where(k % 4 == remainder).select(doi, F.to_variant_object(F.struct(*(c.alias(n) for n, c in fields.items()))).alias("doc"))

    journal = cat("J", F.col("o_orderstatus"))
    csl = answers(0, title=cat("T", k), abstract=F.lit("<jats:p>Abstract A <i>b</i></jats:p>"), author=F.array(person, group), **{"container-title": journal, "published-online": dated})
    crossref = answers(1, title=F.array(cat("T", k)), author=F.array(person), **{"container-title": F.array().cast("array<string>"), "short-container-title": F.array(F.lit("Short J")), "published": dated, "is-referenced-by-count": F.col("o_custkey")})
    article = F.struct(
        cat("T", k).alias("title"), F.struct(F.struct(journal.alias("title")).alias("journal"), F.lit("2011-03-04").alias("printPublicationDate")).alias("journalInfo"),
        F.struct(F.array(F.struct(cat("Full ", F.col("o_custkey")).alias("fullName"))).alias("author")).alias("authorList"), F.col("o_custkey").alias("citedByCount"),
    )
    archive = answers(2, resultList=F.struct(F.array(article).alias("result")))
    # the same record of a provider that is asked later doesn't count
    later = csl.withColumn("doc", F.parse_json(F.lit('{"title": ["other"]}')))
    found = publications.best(publications.from_csl(csl), publications.from_crossref(crossref), publications.from_europepmc(archive), publications.from_crossref(later))
    return found.select("doi", "abstract", F.array_join(F.transform("authors", lambda a: a["name"]), "|").alias("authors"), F.col("citationCount").cast("string").alias("citations"), F.col("date").cast("string").alias("date"), "journal", "title")


@query("""WITH links AS (SELECT DISTINCT p_partkey, unnest(['w' || (p_partkey % 40), 'w' || (p_partkey % 7), 'none']) AS link FROM part),
found AS (SELECT p_partkey, string_agg(o_orderpriority || ':' || o_orderkey, ',' ORDER BY o_orderkey) AS workflows FROM links JOIN orders ON link = 'w' || o_orderkey GROUP BY 1) SELECT part.p_partkey, coalesce(workflows, '') AS workflows FROM part LEFT JOIN found USING (p_partkey)""")
def workflows_of_tools(t):
    k = F.col("p_partkey")
    tools = t.part.select("p_partkey", F.array(cat("w", k % 40), cat("w", k % 7), F.lit("none")).alias("links"))
    w = t.orders.select(F.col("o_orderkey").alias("position"), cat("w", F.col("o_orderkey")).alias("link"), F.col("o_orderkey").cast("string").alias("latest_version"), F.col("o_orderpriority").alias("name"), F.lit("2020").alias("create_time"))
    out = mappers.related_workflows(tools, w, "p_partkey", "links")
    return out.select("p_partkey", F.array_join(F.transform("workflows", lambda x: F.concat_ws(":", x["name"], x["latest_version"])), ",").alias("workflows"))


@query("SELECT o_custkey AS tool, count(*) AS n, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS entries FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY 1")
def metrics_by_tool(t):
    m = mappers.metrics_of_tools(t.orders.withColumnRenamed("o_custkey", "tool"), t.customer.where("c_mktsegment <> 'BUILDING'").withColumnRenamed("c_custkey", "tool"), "tool", "o_orderkey")
    return m.select("tool", "n", F.array_join(F.transform("entries", lambda x: x.cast("string")), ",").alias("entries"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'object' WHEN 1 THEN 'list' ELSE 'other' END AS kind FROM events")
def variant_kinds(t):
    v = F.parse_json(F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, "[1]").otherwise('"x"'))
    return t.events.select("event_id", v.alias("v")).select("event_id", F.when(predicates.is_object(F.col("v")), "object").when(predicates.is_list(F.col("v")), "list").otherwise("other").alias("kind"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'a,b' ELSE '' END AS items FROM events")
def scalar_or_list(t):
    k = F.col("event_id") % 3
    doc = F.parse_json(F.when(k == 0, '{"url": "a"}').when(k == 1, '{"url": ["a", "b"]}').otherwise('{"url": {"x": 1}}'))
    return t.events.select("event_id", doc.alias("doc")).select("event_id", F.array_join(text.as_list(F.col("doc"), "$.url"), ",").alias("items"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS description, CASE WHEN p_partkey % 3 = 0 THEN 'p' || p_partkey ELSE '' END AS primary_doi, CASE WHEN p_partkey % 3 = 0 THEN 'r' ELSE 'r,p' || p_partkey END AS other FROM part")
def selected_entries(t):
    k = F.col("p_partkey")
    d = F.array(F.struct(F.lit("de").alias("language"), F.lit("x").alias("description")), F.struct(F.when(k % 2 == 0, "en").otherwise("fr").alias("language"), F.col("p_name").alias("description")))
    p = F.array(F.struct(F.lit("r").alias("doi"), F.lit(None).cast("string").alias("type")), F.struct(cat("p", k).alias("doi"), F.when(k % 3 == 0, "Primary").otherwise("Review").alias("type")))
    dois = lambda c: F.array_join(F.transform(c, lambda x: x["doi"]), ",")
    rows = t.part.select("p_partkey", d.alias("d"), p.alias("p"))
    return rows.select("p_partkey", predicates.english(F.col("d")).alias("description"), dois(predicates.primary(F.col("p"))).alias("primary_doi"), dois(predicates.primary(F.col("p"), others=True)).alias("other"))


@query("SELECT p_partkey, p_partkey % 4 = 0 AS self_named, p_partkey % 3 = 1 AS shaped, p_partkey % 3 = 0 AS single FROM part WHERE p_partkey % 5 <> 0")
def name_tests(t):
    k = F.col("p_partkey")
    path = F.when(k % 3 == 1, cat("data/t", k, "/t", k, ".bioconda.jsonld")).when(k % 3 == 0, cat("data/icy/t", k, ".x.bioconda.jsonld")).otherwise(cat("data/t", k, "/t", k, ".bioconda.json"))
    rows = t.part.select("p_partkey", F.when(k % 5 != 0, cat("p", k)).otherwise("").alias("id"), cat("p", k).alias("package"), cat("p", F.when(k % 4 == 0, k).otherwise(-1)).alias("source"), path.alias("path")).where(predicates.has_text(F.col("id")))
    return rows.select("p_partkey", predicates.self_named().alias("self_named"), predicates.file_shape(F.col("path"), "jsonld").alias("shaped"), predicates.selected(F.col("path"), "icy", exact=True).alias("single"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 200")
def head_sample(t):
    return predicates.head(t.orders.select("o_orderkey", "o_totalprice"), 200, "o_totalprice")


@query("SELECT event_id FROM events ORDER BY event_id LIMIT 11")
def limited_run(t):
    return predicates.head(t.events.select("event_id"), 11, "event_id")


@query("SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS iso, strftime(make_timestamp((event_id * 3600)::BIGINT * 1000000), '%Y-%m-%dT%H:%M:%S') AS epoch FROM events")
def iso_times(t):
    return t.events.select("event_id", text.iso_time(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))).alias("iso"), text.epoch_time(F.col("event_id") * 3600).alias("epoch"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE (event_id % 3)::VARCHAR END AS score, round(value / 3, 2) AS share FROM events")
def score_casts(t):
    return t.events.select("event_id", text.score_of(F.when(F.col("event_id") % 4 == 0, "n/a").otherwise((F.col("event_id") % 3).cast("string"))).cast("string").alias("score"), F.round(F.col("value") / 3, 2).alias("share"))


@query("SELECT c_custkey, c_name AS name, c_nationkey AS inner_nation FROM customer")
def dropped_paths(t):
    c = t.customer.select("c_custkey", F.struct(F.col("c_name").alias("name"), F.lit(1).alias("term"), F.struct(F.col("c_nationkey").alias("nation"), F.lit(2).alias("last_check"), F.lit(3).alias("term")).alias("website")).alias("project"), F.lit(0).alias("@timestamp"))
    c = canon.drop_paths(c, ["@timestamp", "project.website.last_check", "project.absent", "absent.x"])
    c = c.withColumn("project", canon.drop_keys(F.col("project"), c.schema["project"].dataType, {"term"}))
    assert c.columns == ["c_custkey", "project"] and c.schema["project"].dataType["website"].dataType.names == ["nation"]
    return c.select("c_custkey", "project.name", F.col("project.website.nation").alias("inner_nation"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE '' END AS status, 'a=1,b=' || o_orderkey || ',c=3' AS merged, lower(o_orderpriority) AS id FROM orders")
def defaults_and_merges(t):
    k = F.col("o_orderkey")
    m = canon.merge_maps(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("b"), k.cast("string"), F.lit("c"), F.lit("3")))
    doc = t.orders.select("o_orderkey", canon.sub_document(["o_orderstatus", "o_orderpriority"]).alias("doc"), m.alias("m"))
    merged = F.array_join(F.transform(F.sort_array(F.map_entries("m")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return doc.select("o_orderkey", canon.or_default(F.when(k % 2 == 0, F.col("doc.o_orderstatus"))).alias("status"), merged.alias("merged"), F.lower("doc.o_orderpriority").alias("id"))


@query("""SELECT p_partkey, 'https://t.example/a' || p_partkey || '/tutorials/b/tutorial.html,https://t.example/full' AS urls, '10.1/' || p_partkey AS doi, CASE p_partkey % 3 WHEN 0 THEN 'G F' WHEN 1 THEN 'Lit' ELSE 'Nam' END AS person,
'http://a.b/' || replace(replace(p_name, ' ', '%20'), 'é', '%C3%A9') || '%2A~' AS quoted, 'x & ' || p_name AS plain, CASE WHEN p_partkey % 2 = 0 THEN 'Tool' || p_partkey END AS tool FROM part""")
def text_functions(t):
    k = F.col("p_partkey")
    none = F.lit(None).cast("string")
    person = F.struct(F.when(k % 3 == 0, "G").alias("given"), F.when(k % 3 == 0, "F").alias("family"), F.when(k % 3 == 1, "Lit").alias("literal"), F.when(k % 3 == 2, "Nam").alias("name"))
    registries = F.array(F.struct(F.lit("OMICtools").alias("name"), F.lit("O").alias("entry")), F.struct(F.when(k % 2 == 0, "bio.tools").otherwise("x").alias("name"), cat("Tool", k).alias("entry")), F.struct(F.lit("bio.tools").alias("name"), F.when(k % 2 == 0, "second").otherwise(none).alias("entry")))
    rows = t.part.select("p_partkey", "p_name", F.array(cat("a", k, "/b"), F.lit("https://t.example/full")).alias("tutorials"), person.alias("person"), registries.alias("registries"))
    return rows.select(
        "p_partkey", F.array_join(text.training_urls(F.col("tutorials"), "https://t.example/"), ",").alias("urls"), text.clean_doi(cat(" doi:10.1/", k, " ")).alias("doi"), text.person_name(F.col("person")).alias("person"),
        text.url_quote(cat("http://a.b/", F.col("p_name"), "*~")).alias("quoted"), text.html_text(cat("<p>x &amp; <b>", F.col("p_name"), "</b></p>")).alias("plain"), mappers.tool_of(F.col("registries")).alias("tool"),
    )


@query("SELECT p_partkey, 'Ada ' || p_partkey AS name, CASE WHEN p_partkey % 2 = 0 THEN 'Person' ELSE 'Funding agency' END AS kind, CASE WHEN p_partkey % 2 = 0 THEN 'https://orcid.org/0000-0001-2345-678' || CASE WHEN p_partkey % 4 = 0 THEN 'X' ELSE '9' END END AS orcid, CASE WHEN p_partkey % 2 = 0 THEN 'Developer,Maintainer' ELSE 'Contributor' END AS roles FROM part UNION ALL SELECT p_partkey, p_name, NULL, NULL, NULL FROM part")
def author_parse(t):
    k = F.col("p_partkey")
    lead = F.when(k % 2 == 0, cat("Ada ", k, " [cre, aut] (<https://orcid.org/0000-0001-2345-678", F.when(k % 4 == 0, "X").otherwise("9"), ">)")).otherwise(cat("Ada ", k, " [fnd]"))
    rows = t.part.select("p_partkey", F.explode(authors.credits(cat(lead, ", ", F.col("p_name"), ", [ctb]"))).alias("c"))
    return rows.select("p_partkey", "c.name", F.col("c.typeEntity").alias("kind"), F.col("c.orcidid").alias("orcid"), F.array_join("c.typeRole", ",").alias("roles"))


@query("SELECT method, value, count(*) AS n, string_agg(file::VARCHAR, ',' ORDER BY file) AS files FROM (SELECT 'name' AS method, c_nationkey || '-' || c_mktsegment AS value, c_custkey AS file FROM customer UNION ALL SELECT 'homepage', 'h.example/' || c_nationkey, c_custkey FROM customer) GROUP BY ALL")
def inverted_index_lists(t):
    c = t.customer.select(F.col("c_custkey").alias("file"), F.concat_ws("-", "c_nationkey", "c_mktsegment").alias("name"), cat("https://h.example/", F.col("c_nationkey")).alias("homepage"))
    return matching.inverted_index(matching.keys(c, ["name", "homepage"])).select("method", "value", "n", F.array_join(F.transform("files", lambda x: x.cast("string")), ",").alias("files"))


@query("SELECT event_id FROM events WHERE event_id % 7 = 0")
def invalid_records(t):
    e = t.events.withColumn("props", F.when(F.col("event_id") % 7 == 0, F.substring("props", 1, 3)).otherwise(F.col("props")))
    return quality.validity(e, "event_id", F.try_parse_json("props").isNull())[1]


@query("""WITH held AS (SELECT DISTINCT l_orderkey AS tool, l_partkey AS doi, l_returnflag AS source FROM lineitem),
missing AS (SELECT DISTINCT a.tool, a.doi, b.source FROM (SELECT DISTINCT tool, doi FROM held) a JOIN (SELECT DISTINCT tool, source FROM held) b ON a.tool = b.tool EXCEPT SELECT * FROM held)
SELECT tool, doi, source FROM missing m WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = tool AND l_partkey = doi AND l_linestatus = 'F')""")
def publications_to_write(t):
    held = t.lineitem.select(F.col("l_orderkey").alias("tool"), F.col("l_partkey").alias("doi"), F.col("l_returnflag").alias("source"))
    known = t.lineitem.select(F.col("l_orderkey").alias("tool"), F.col("l_partkey").alias("doi"), F.when(F.col("l_linestatus") == "F", "Review").otherwise("Primary").alias("type"))
    return quality.publications_to_write(quality.gaps(held, "tool", "doi", "source"), known, "tool", "doi").select("tool", "doi", "source")


@query("SELECT DISTINCT l_orderkey AS tool, l_partkey AS doi FROM lineitem")
def union_of_publications(t):
    return quality.union_of_values(t.lineitem.select(F.col("l_orderkey").alias("tool"), F.col("l_partkey").alias("doi")), "tool", "doi")


PAGE_SCHEMA = {
    "type": "object", "required": ["page_id", "url", "title"],
    "properties": {
        "url": {"type": "string", "format": "uri", "pattern": "^https://", "maxLength": 60}, "title": {"type": "string", "minLength": 12}, "kind": {"enum": ["even", "odd"]}, "size": {"type": "integer", "minimum": 100},
        "links": {"type": "array", "maxItems": 3, "uniqueItems": True, "items": {"$ref": "#/$defs/link"}}, "owner": {"oneOf": [{"required": ["orcid"]}, {"required": ["mail"]}], "properties": {"mail": {"format": "email"}}},
    },
    "$defs": {"link": {"required": ["href"], "properties": {"href": {"pattern": "^[a-z]"}, "n": {"maximum": 5}}}},
}
_PAGES = "SELECT page_id, url, CASE WHEN page_id % 11 <> 0 THEN 'title ' || page_id || repeat('x', page_id % 7) END AS title, CASE page_id % 5 WHEN 0 THEN 'zero' WHEN 1 THEN 'odd' ELSE 'even' END AS kind, length(html) AS size FROM pages"
_VIOLATIONS = f"""WITH d AS ({_PAGES})
SELECT page_id, 'title' AS path, 'required' AS rule FROM d WHERE title IS NULL UNION ALL SELECT page_id, 'url', 'pattern' FROM d WHERE NOT starts_with(url, 'https://') UNION ALL SELECT page_id, 'url', 'maxLength' FROM d WHERE length(url) > 60
UNION ALL SELECT page_id, 'url', 'format' FROM d WHERE NOT regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*:[^\\s<>"{{}}|\\\\^`]*$') UNION ALL SELECT page_id, 'title', 'minLength' FROM d WHERE length(title) < 12
UNION ALL SELECT page_id, 'kind', 'enum' FROM d WHERE kind = 'zero' UNION ALL SELECT page_id, 'size', 'minimum' FROM d WHERE size < 100
UNION ALL SELECT page_id, 'links', 'maxItems' FROM d WHERE page_id % 4 = 3 UNION ALL SELECT page_id, 'links', 'uniqueItems' FROM d WHERE page_id % 6 = 5 UNION ALL SELECT page_id, 'links[1].href', 'required' FROM d WHERE page_id % 9 = 0
UNION ALL SELECT page_id, 'links[0].n', 'maximum' FROM d WHERE page_id % 10 > 5 UNION ALL SELECT page_id, 'links[2].n', 'maximum' FROM d WHERE page_id % 10 > 5 AND page_id % 6 = 5 UNION ALL SELECT page_id, 'owner', 'oneOf' FROM d WHERE page_id % 3 <> 1 UNION ALL SELECT page_id, 'owner.mail', 'format' FROM d WHERE page_id % 3 = 2"""


def page_documents(t: Tables) -> DataFrame:
    """Documents of the pages with faults of every kind."""
    k = F.col("page_id")
    link = lambda href, n: F.struct(href.alias("href"), n.cast("long").alias("n"))
    none = F.lit(None).cast("string")
    links = F.concat(
        F.array(link(F.lit("a"), k % 10), link(F.when(k % 9 != 0, cat("b", k)), F.lit(1))), F.when(k % 6 == 5, F.array(link(F.lit("a"), k % 10))).otherwise(F.array(link(F.lit("c"), F.lit(None)))),
        F.when(k % 4 == 3, F.array(link(F.lit("d"), F.lit(2)))).otherwise(F.array().cast("array<struct<href:string,n:bigint>>")),
    )
    owner = F.struct(F.when(k % 3 != 0, cat("0000-", k)).alias("orcid"), F.when(k % 3 == 2, "no mail").otherwise(none).alias("mail"))
    return t.pages.select(
        "page_id", "url", F.when(k % 11 != 0, cat("title ", k, F.repeat(F.lit("x"), (k % 7).cast("int")))).alias("title"), F.when(k % 5 == 0, "zero").when(k % 5 == 1, "odd").otherwise("even").alias("kind"), F.length("html").alias("size"), links.alias("links"), owner.alias("owner"),
    )


@query(_VIOLATIONS)
def schema_violations(t):
    return validation.violations(page_documents(t), PAGE_SCHEMA, "page_id")


@query(f"""WITH bad AS (SELECT DISTINCT page_id FROM ({_VIOLATIONS})), s AS (SELECT page_id % 10 AS k, page_id IN (SELECT page_id FROM bad) AS bad FROM pages)
SELECT CASE WHEN k = 1 THEN 'unchanged' WHEN bad THEN 'failed_validation' WHEN k = 2 THEN 'updated' WHEN k = 3 THEN 'failed_update' WHEN k = 4 THEN 'uploaded' ELSE 'failed_upload' END AS status, count(*) AS n FROM s GROUP BY 1""")
def upload_states(t):
    """The states after an upload of documents that a schema has judged."""
    judged = validation.verdicts(page_documents(t), PAGE_SCHEMA, "page_id")
    k = F.col("page_id") % 10
    state = upsert.upload_status(k.isin(1, 2, 3), k == 1, F.col("valid"), k.isin(2, 4))
    return judged.select(state.alias("status")).groupBy("status").agg(F.count("*").alias("n"))


@query("""WITH i AS (SELECT DISTINCT 'all' AS k, l_partkey AS item FROM lineitem UNION ALL SELECT DISTINCT l_returnflag || l_linenumber, l_partkey FROM lineitem)
SELECT k, count(*) AS n, sum(item)::BIGINT AS total, true AS in_bounds, true AS ordered FROM i GROUP BY k""")
def chunked_lists(t):
    """Lists of values of which one is shared by all rows: sums over their chunks, whether all are within 100 items, and in order over the chunks."""
    rows = t.lineitem.select(F.explode(F.array(F.lit("all"), F.concat("l_returnflag", "l_linenumber"))).alias("k"), F.col("l_partkey").alias("item"))
    c = quality.chunked(rows, "k", "item", 100)
    before = F.max(F.array_max("items")).over(Window.partitionBy("k").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    marked = c.withColumn("ok", F.coalesce(before < F.array_min("items"), F.col("chunk") == 0) & (F.col("items") == F.array_sort("items")))
    total = F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + x)
    return marked.groupBy("k").agg(F.max("n").alias("n"), F.sum(total).alias("total"), (F.max(F.size("items")) <= 100).alias("in_bounds"), F.bool_and("ok").alias("ordered"))


@query("SELECT c_custkey, 'new' AS a, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'fresh' END AS b FROM customer")
def preserved_fields(t):
    new = t.customer.select("c_custkey", F.lit("new").alias("a"), F.lit("fresh").alias("b"))
    old = t.customer.select("c_custkey", F.lit("old").alias("a"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("b"))
    return upsert.preserve(new, old, "c_custkey", ["b"])


@query("""WITH r AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 2 ELSE length(url) % 3 END AS f1, CASE WHEN page_id % 3 = 0 THEN 0 ELSE page_id % 2 END AS r1 FROM pages WHERE page_id % 7 <> 0)
SELECT f1 > 0 AS "F1", r1 > 0 AS "R1", count(*) AS n, round(count(*) / (SELECT count(*) FROM r), 6) AS share FROM r GROUP BY 1, 2""")
def fair_resumed(t):
    """Scores of the addresses: a third is known from before, the rest is evaluated; then how many have which metrics."""
    prior = t.pages.where("page_id % 3 = 0").select("page_id", F.lit(2).cast("long").alias("f1"), F.lit(0).cast("long").alias("r1"))
    score = lambda work: work.select("page_id", (F.length("url") % 3).cast("long").alias("f1"), (F.col("page_id") % 2).alias("r1"))
    results = quality.resumed(t.pages.where("page_id % 7 <> 0").select("page_id", "url"), prior, "page_id", score)
    return quality.intersections(results, {"F1": F.col("f1") > 0, "R1": F.col("r1") > 0})


@query("SELECT url, false AS ok FROM pages WHERE page_id % 3 = 0")
def smoke_failures(t):
    return quality.smoke(t.pages.select("url", F.when(F.col("page_id") % 3 != 0, 200).when(F.col("page_id") % 2 == 0, 404).alias("status")))


@query("SELECT c_custkey AS file, 'segment' AS method, lower(c_mktsegment) || '/' || c_nationkey AS value FROM customer UNION ALL SELECT c_custkey, 'name', c_name FROM customer")
def own_identity(t):
    """Keys by an identity of the caller's own beside one of the fixed ones."""
    matching.register_identity("segment", lambda: F.array(F.concat_ws("/", F.lower("segment"), "nation")))
    try:
        rows = t.customer.select(F.col("c_custkey").alias("file"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
        return matching.keys(rows, ["segment", "name"])
    finally:
        del matching.IDENTITIES["segment"]


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'house terms ' || (p_partkey % 3) WHEN 1 THEN 'MIT + file LICENSE' WHEN 2 THEN 'own-9' END AS raw, CASE p_partkey % 4 WHEN 0 THEN CASE WHEN p_partkey % 3 = 1 THEN 'House-1.0' END WHEN 1 THEN 'MIT' WHEN 2 THEN 'OWN-9' END AS spdx FROM part")
def own_licenses(t):
    """An alias and an id of the caller's own."""
    k = F.col("p_partkey")
    raw = F.when(k % 4 == 0, cat("house terms ", k % 3)).when(k % 4 == 1, "MIT + file LICENSE").when(k % 4 == 2, "own-9")
    return licenses.normalise(t.part.select("p_partkey", raw.alias("raw")), "raw", aliases={"house-terms-1": "House-1.0"}, spdx=[*licenses.SPDX, "OWN-9"], cutoff=0.99)


@query("SELECT a.o_orderkey AS f1, min(b.o_orderkey) AS f2 FROM orders a JOIN orders b ON a.o_orderkey = b.o_orderkey + 1 WHERE a.o_orderkey % 2 = 0 AND b.o_orderkey % 2 = 1 GROUP BY 1")
def public_names(t):
    """Matching by the package's public names only: pairs of neighbouring orders."""
    import toolgraph

    side = lambda odd, name: t.orders.where(F.col("o_orderkey") % 2 == odd).select(F.col("o_orderkey").alias("file"), name.cast("string").alias("name"))
    return toolgraph.assign(toolgraph.keys(side(0, F.col("o_orderkey")), ["name"]), toolgraph.keys(side(1, F.col("o_orderkey") + 1), ["name"]))


@query('SELECT p_partkey AS part_key, p_name AS name_of_part, p_brand AS brand FROM part')
def renamed_keys(t):
    return canon.rename_spaces(t.part.select(F.col("p_partkey").alias("part key"), F.col("p_name").alias("name of part"), F.col("p_brand").alias("brand")))
