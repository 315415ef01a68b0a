"""Raw documents of the registries (doc VARIANT) to the flat columns that the mapper tables in triples.py name.

Each is one projection; labels become ontology terms by one join for all label columns, addresses are kept or left out by a table of their statuses. Fields that a
document lacks are null or empty lists and give no triples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import is_object
from ..functions.text import as_list, first_entry
from . import triples
from .triples import PREFIXES

def _none() -> Column:
    return F.array().cast("array<string>")


def text(path: str, doc: str = "doc") -> Column:
    """The text (or number, as text) at a path; null for objects and lists."""
    return F.try_variant_get(doc, path, "string")


def rows_at(path: str, fields: str, doc: str = "doc") -> Column:
    """The list of objects at a path, with the fields named (a struct's DDL); empty without."""
    return F.coalesce(F.try_variant_get(doc, path, f"array<struct<{fields}>>"), F.array().cast(f"array<struct<{fields}>>"))


def with_terms(flat: DataFrame, key: str, labels: dict[str, str], terms: DataFrame) -> DataFrame:
    """For each column of labels a column of the ontology's IRIs for them, in order of IRI; labels that it doesn't know go. terms: (label, entity)."""
    def marked(c: str, to: str) -> Column:
        return F.transform(F.coalesce(c, _none()), lambda x: F.struct(F.lit(to).alias("to"), x.alias("label")))

    pairs = F.flatten(F.array(*(marked(c, to) for c, to in labels.items())))
    found = flat.select(key, F.explode(pairs).alias("x")).select(key, "x.to", "x.label").distinct().join(terms.select("label", "entity").distinct(), "label")
    iri = F.concat(F.lit(PREFIXES["edam"]), F.substring_index("entity", "/", -1))
    by = found.groupBy(key).agg(*(F.sort_array(F.collect_set(F.when(F.col("to") == to, iri))).alias(to) for to in labels.values()))
    return flat.drop(*labels).join(by, key, "left")


def resolving(flat: DataFrame, column: str, statuses: DataFrame) -> DataFrame:
    """The column where its address is known to answer, else null. statuses: (url, ok)."""
    ok = statuses.where("ok").select(F.col("url").alias("_url")).distinct()
    return flat.join(ok, F.col(column) == F.col("_url"), "left").withColumn(column, F.col("_url")).drop("_url")


def servers_of(doc: Column, prefix: str = "Number_of_tools_on_") -> Column:
    """Names of the servers whose dynamic key ``prefix + name`` counts more than nothing."""
    entries = F.map_entries(F.try_variant_get(doc, "$", "map<string,variant>"))
    held = F.filter(entries, lambda e: F.startswith(e["key"], F.lit(prefix)) & (F.coalesce(F.try_variant_get(e["value"], "$", "double"), F.lit(0.0)) > 0))
    return F.transform(held, lambda e: F.substring(e["key"], len(prefix) + 1, 1 << 20))


def server_urls(flat: DataFrame, key: str, names: str, servers: DataFrame) -> DataFrame:
    """(key, servers): the addresses of the named servers; names that the table (name, url) lacks go."""
    found = flat.select(key, F.explode(names).alias("name")).distinct().join(servers.select("name", "url").distinct(), "name")
    return found.groupBy(key).agg(F.sort_array(F.collect_set("url")).alias("servers"))


def flatten_suites(suites: DataFrame, terms: DataFrame, servers: DataFrame) -> DataFrame:
    """The columns that SUITE names; suites without an id go."""
    tool = lambda path, prefix, f=lambda x: x: F.concat(F.lit(PREFIXES[prefix]), F.nullif(f(text(path)), F.lit("")))
    same = ("Suite_ID", "Description", "Suite_source", "Suite_version", "Homepage", "Suite_first_commit_date")
    formats = as_list(F.col("doc"), "$.Tool_output_formats")
    flat = suites.select(
        *(text(f"$.{c}").alias(c) for c in same), as_list(F.col("doc"), "$.EDAM_topics").alias("topic_labels"), as_list(F.col("doc"), "$.EDAM_operations").alias("operation_labels"),
        formats.alias("Tool_output_formats"), formats.alias("outputs"), F.array_compact(F.array(tool("$['bio.tool_ID']", "biotools"), tool("$.Suite_conda_package", "bioconda", F.trim), tool("$.biii_ID", "biii"))).alias("identifiers"),
        F.filter(F.transform(rows_at("$.Related_Workflows", "link:string"), lambda w: w["link"]), lambda x: x.isNotNull()).alias("workflows"), as_list(F.col("doc"), "$.ToolShed_categories").alias("ToolShed_categories"),
        servers_of(F.col("doc")).alias("server_names"),
    ).where("Suite_ID <> ''")
    named = with_terms(flat, "Suite_ID", {"topic_labels": "topics", "operation_labels": "operations"}, terms)
    return named.join(server_urls(named, "Suite_ID", "server_names", servers), "Suite_ID", "left").drop("server_names")


def flatten_debian(packages: DataFrame, terms: DataFrame) -> DataFrame:
    """The columns that DEBIAN names. Registry entries of known registries are IRIs, a list of packages in one entry counts as several; others are texts ``name:entry``."""
    plain = "name:string,entry:string"
    entries = F.filter(rows_at("$.registries", plain), lambda r: r["name"].isNotNull() & r["entry"].isNotNull())
    several = F.flatten(F.transform(entries, lambda r: F.transform(F.when(r["name"] == "conda:bioconda", F.split(r["entry"], ", ")).otherwise(F.array(r["entry"])), lambda e: triples.debian_identifiers(r["name"], e))))
    iri = lambda x: F.rlike(x, F.lit("^https?://"))
    scopes = rows_at("$.edam_scopes", "function:array<string>,input:array<struct<data:string,format:array<string>>>,output:array<struct<data:string,format:array<string>>>")
    bib = F.filter(rows_at("$.bib", "key:string,value:string"), lambda b: b["key"].isNotNull() & b["value"].isNotNull())
    parts = lambda side, f: F.filter(F.flatten(F.transform(scopes, lambda s: F.coalesce(F.flatten(F.transform(s[side], f)), _none()))), lambda x: x.isNotNull())
    data = lambda side: parts(side, lambda i: F.array(i["data"]))
    form = lambda side: parts(side, lambda i: F.coalesce(i["format"], _none()))
    flat = packages.select(
        *(text(f"$.{c}").alias(c) for c in ("package", "homepage", "license", "version")), as_list(F.col("doc"), "$.topics").alias("topic_labels"),
        F.transform(bib, lambda b: F.concat_ws(":", b["key"], b["value"])).alias("citations"), F.filter(several, iri).alias("identifiers"), F.filter(several, lambda x: ~iri(x)).alias("other_identifiers"),
        F.filter(F.flatten(F.transform(scopes, lambda s: F.coalesce(s["function"], _none()))), lambda x: x.isNotNull()).alias("function_labels"),
        F.concat(form("input"), form("output")).alias("format_labels"), F.concat(data("input"), data("output")).alias("data_labels"),
        F.concat(data("input"), form("input")).alias("input_labels"), F.concat(data("output"), form("output")).alias("output_labels"),
        F.filter(F.transform(rows_at("$.tags", "tag:string"), lambda t: t["tag"]), lambda x: x.isNotNull()).alias("tags"),
    ).where("package <> ''")
    to = {"topic_labels": "topics", "function_labels": "functions", "format_labels": "formats", "data_labels": "data", "input_labels": "inputs", "output_labels": "outputs"}
    return with_terms(flat, "package", to, terms)


def flatten_bioconductor(packages: DataFrame, strict: bool = False) -> DataFrame:
    """The columns that BIOCONDUCTOR names; with ``strict`` only packages that have all the fields but URL."""
    many = ("Depends", "biocViews")
    flat = packages.select(*(as_list(F.col("doc"), f"$.{c}").alias(c) if c in many else text(f"$['{c}']").alias(c) for c in triples.BIOCONDUCTOR)).where("Package <> ''")
    if strict:
        have = packages.where(" and ".join(f"variant_get(doc, \"$['{c}']\", 'variant') is not null" for c in triples.BIOCONDUCTOR if c != "URL"))
        return flatten_bioconductor(have)
    return flat


def identifiers_of(doc: Column, kind: str, path: str = "$.identifiers") -> Column:
    """``kind:id`` of the identifiers of a kind, given as texts ``kind:id`` in either case or as mappings kind -> id."""
    entries = F.coalesce(F.try_variant_get(doc, path, "array<variant>"), F.array().cast("array<variant>"))
    mapped = lambda v: F.concat(F.lit(f"{kind}:"), F.try_variant_get(v, f"$.{kind}", "string"))
    named = F.transform(entries, lambda v: F.when(is_object(v), mapped(v)).otherwise(F.try_variant_get(v, "$", "string")))
    return F.filter(named, lambda x: F.coalesce(F.startswith(F.lower(x), F.lit(f"{kind}:")), F.lit(False)))


def flatten_containers(annotations: DataFrame, statuses: DataFrame) -> DataFrame:
    """The columns that CONTAINER names; the tool's IRI and the home page only if they answer (statuses: url, ok)."""
    tool = F.get(identifiers_of(F.col("doc"), "biotools"), F.lit(0))
    flat = annotations.select(
        *(text(f"$.{c}").alias(c) for c in ("name", "description", "license", "home_url")), F.concat(F.lit(PREFIXES["biotools"]), F.lower(F.substring(tool, 10, 1 << 20))).alias("biotools"),
        as_list(F.col("doc"), "$.keywords").alias("keywords"), identifiers_of(F.col("doc"), "doi").alias("dois"),
    ).where("name <> ''")
    return resolving(resolving(flat, "biotools", statuses), "home_url", statuses)


def flatten_workflows(workflows: DataFrame, terms: DataFrame) -> DataFrame:
    """The columns that WORKFLOW names; workflows without a link go. Every field is taken by itself."""
    origin = text("$.source")
    same = ("link", "name", "description", "doi", "latest_version", "license", "create_time", "update_time")
    flat = workflows.select(
        *(text(f"$.{c}").alias(c) for c in same), as_list(F.col("doc"), "$.creators").alias("creators"), as_list(F.col("doc"), "$.edam_operation").alias("operation_labels"),
        as_list(F.col("doc"), "$.edam_topic").alias("topic_labels"), as_list(F.col("doc"), "$.tags").alias("tags"),
        F.when(origin == "WorkflowHub", "https://workflowhub.eu").when(F.startswith(origin, F.lit("https://")), origin).alias("part_of"),
    ).where("link <> ''")
    return with_terms(flat, "link", {"operation_labels": "operations", "topic_labels": "topics"}, terms)


def sites(flat: DataFrame, column: str) -> DataFrame:
    """(s, p, o, o_kind): the servers of a column (an address or a list of them) as web sites."""
    many = flat.schema[column].dataType.typeName() == "array"
    s = flat.select((F.explode(column) if many else F.col(column)).alias("s")).where("s is not null").distinct()
    return s.select("s", F.lit(triples.TYPE).alias("p"), F.lit(triples.SC + "WebSite").alias("o"), F.lit("iri").alias("o_kind"))


def tool_of(registries: Column) -> Column:
    """The id of a package's first cross-reference to the tool registry."""
    return first_entry(registries, "bio.tools")


def related_workflows(tools: DataFrame, workflows: DataFrame, key: str, links: str) -> DataFrame:
    """The tools with the workflows that they link: (link, latest_version, name, create_time) in order of ``position`` of the workflows, each once; an empty list without."""
    fields = ("link", "latest_version", "name", "create_time")
    wanted = tools.select(key, F.explode(links).alias("link")).distinct()
    found = wanted.join(workflows.select("position", *fields), "link").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("position", *fields))).alias("_found"))
    picked = F.transform("_found", lambda x: F.struct(*(x[f].alias(f) for f in fields)))
    return tools.join(found, key, "left").withColumn("workflows", F.when(F.col(links).isNotNull(), F.coalesce(picked, F.array().cast("array<struct<link:string,latest_version:string,name:string,create_time:string>>")))).drop("_found")


def metrics_of_tools(metrics: DataFrame, tools: DataFrame, key: str, value: str) -> DataFrame:
    """(key, n, list of metric entries) for the tools that the catalogue has."""
    return metrics.join(tools.select(key).distinct(), key, "left_semi").groupBy(key).agg(F.count("*").alias("n"), F.sort_array(F.collect_list(value)).alias("entries"))
