"""Documents to subject-predicate-object triples. A mapper is a list of rules (data); one executor serves them all in a single scan."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import html_text, iri_escape, ntriples_escape, percent_escape_doi, percent_escape_url, slug, url_quote

TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
SC, BSC, DCT = "http://schema.org/", "http://bioschemas.org/", "http://purl.org/dc/terms/"
# Namespaces.
PREFIXES = {
    "schema": SC, "bioschemas": BSC, "biotools": "https://bio.tools/", "bioconda": "https://github.com/bioconda/bioconda-recipes/tree/master/recipes/",
    "debianmed": "https://salsa.debian.org/med-team/", "galaxytool": "https://github.com/galaxyproject/tools-iuc/tree/master/tools/",
    "bioconductor": "https://git.bioconductor.org/packages/", "biocontainers": "https://biocontainers.pro/tools/", "scicrunch": "https://scicrunch.org/resolver/",
    "guix": "https://packages.guix.gnu.org/packages/", "biii": "https://biii.eu/", "edam": "http://edamontology.org/",
}


@dataclass(frozen=True)
class Rule:
    """predicate and an expression for the object (a text, or an array if many); iri tells the kind."""

    predicate: str
    value: Column
    iri: bool = False
    many: bool = False


def facts(docs: DataFrame, subject: Column, rules: list[Rule]) -> DataFrame:
    """(s, p, o, o_kind) of all rules, with repeats: one explode over one array, nulls left out, no shuffle. For union_graph, which drops repeats once."""

    def of(r: Rule) -> Column:
        kind = F.lit("iri" if r.iri else "literal")
        fact = lambda v: F.struct(F.lit(r.predicate).alias("p"), v.cast("string").alias("o"), kind.alias("o_kind"))
        return F.transform(F.coalesce(r.value, F.array().cast("array<string>")), fact) if r.many else F.array(fact(r.value))

    every = F.filter(F.flatten(F.array(*map(of, rules))), lambda t: t["o"].isNotNull() & (t["o"] != ""))
    return docs.select(subject.alias("s"), F.explode(every).alias("t")).select("s", "t.p", "t.o", "t.o_kind")


def triples(docs: DataFrame, subject: Column, rules: list[Rule]) -> DataFrame:
    """Distinct facts."""
    return facts(docs, subject, rules).distinct()


def col(name: str) -> Column:
    return F.col(name)


def fits(df: DataFrame, rules: dict[str, Rule]) -> list[Rule]:
    """The rules whose top-level column the documents have."""
    return [r for name, r in rules.items() if name.split("#")[0] in df.columns or not name[0].isalpha()]


ROLES = (("Developer", SC + "author"), ("Provider", SC + "provider"), ("Contributor", SC + "contributor"), ("Primary contact", "https://bio.tools/primaryContact"))


def _credit(role: str | None, iri: bool) -> Column:
    """IRIs, or names, of the credits that have the role (None: funding agencies): an IRI is given for those with a kind of entity and an ORCID."""
    has = (lambda c: F.array_contains(c["typeRole"], role)) if role else (lambda c: c["typeEntity"] == "Funding agency")
    named = lambda c: c["typeEntity"].isNotNull() & c["orcidid"].isNotNull()
    found = F.filter("credit", lambda c: F.coalesce(has(c), F.lit(False)) & (named(c) if iri else ~named(c)))
    return F.transform(found, lambda c: c["orcidid"] if iri else c["name"])


def tool_rules() -> dict[str, Rule]:
    pubs = lambda field, prefix: F.transform("publication", lambda p: F.concat(F.lit(prefix), p[field]))
    dois = F.transform(F.filter("publication", lambda p: p["doi"].isNotNull() & ~F.rlike(p["doi"], F.lit("[<>]"))), lambda p: F.concat(F.lit("https://doi.org/"), percent_escape_doi(p["doi"])))
    help_ = F.filter("documentation", lambda d: (F.size(d["type"]) > 0) & ~F.contains(d["url"], F.lit("app.gitter.im")))
    terms = lambda d: F.exists(d["type"], lambda t: F.contains(t, F.lit("Terms")))
    io = lambda side: F.flatten(F.transform("function", lambda f: F.transform(f[side], parameter_iri)))
    return {
        "*type": Rule(TYPE, F.lit(SC + "SoftwareApplication"), True), "*profile": Rule(DCT + "conformsTo", F.lit("https://bioschemas.org/profiles/ComputationalTool/1.0-RELEASE")),
        "name": Rule(SC + "name", col("name")), "description": Rule(SC + "description", col("description")), "homepage": Rule(SC + "url", col("homepage")),
        "toolType": Rule(SC + "additionalType", col("toolType"), many=True), "license": Rule(SC + "license", col("license")), "version": Rule(SC + "softwareVersion", col("version"), many=True),
        "operatingSystem": Rule(SC + "operatingSystem", col("operatingSystem"), many=True), 
        **{f"credit#{r}#{i}": Rule(p, _credit(r, i), i, True) for r, p in (*ROLES, (None, SC + "funder")) for i in (True, False)},
        "publication#pmid": Rule(SC + "citation", pubs("pmid", "pubmed:"), many=True), "publication#pmcid": Rule(SC + "citation", pubs("pmcid", "pmcid:"), many=True), "publication#doi": Rule(SC + "citation", dois, True, True),
        "function#op": Rule(SC + "featureList", F.flatten(F.transform("function", lambda f: F.transform(f["operation"], lambda o: o["uri"]))), True, True),
        "function#in": Rule(BSC + "input", io("input"), True, True), "function#out": Rule(BSC + "output", io("output"), True, True),
        "topic": Rule(SC + "applicationSubCategory", F.transform("topic", lambda t: t["uri"]), True, True), "cost": Rule(SC + "isAccessibleForFree", F.contains("cost", F.lit("Free"))),
        "documentation#help": Rule(SC + "softwareHelp", F.transform(F.filter(help_, lambda d: ~terms(d)), lambda d: percent_escape_url(d["url"])), True, True),
        "documentation#terms": Rule(SC + "termsOfService", F.transform(F.filter(help_, terms), lambda d: percent_escape_url(d["url"])), True, True),
    }


def tool_node_triples(docs: DataFrame) -> DataFrame:
    """Facts of the nodes that tool documents point to: people and organisations by ORCID, publications by DOI, and the parameters of their functions."""
    def rows(found: Column, subject, rules) -> DataFrame:
        return facts(docs.select(F.explode(found).alias("x")), subject(F.col("x")), rules(F.col("x")))

    out = []
    if "credit" in docs.columns:
        person = lambda x: F.when(F.contains(x["typeEntity"], F.lit("Person")), SC + "Person").otherwise(SC + "Organization")
        known = F.filter("credit", lambda c: c["typeEntity"].isNotNull() & c["orcidid"].isNotNull())
        out.append(rows(known, lambda x: x["orcidid"], lambda x: [Rule(TYPE, person(x), True), Rule(SC + "name", x["name"])]))
    if "publication" in docs.columns:
        safe = F.filter("publication", lambda p: p["doi"].isNotNull() & ~F.rlike(p["doi"], F.lit("[<>]")))
        out.append(rows(F.transform(safe, lambda p: percent_escape_doi(p["doi"])), lambda x: F.concat(F.lit("https://doi.org/"), x), lambda x: [Rule(TYPE, F.lit(SC + "CreativeWork"), True)]))
    if "function" in docs.columns:
        both = F.flatten(F.transform("function", lambda f: F.flatten(F.array_compact(F.array(f["input"], f["output"])))))
        described = lambda x: [Rule(TYPE, F.lit(BSC + "FormalParameter"), True), Rule(SC + "name", x["data"]["term"]), Rule(SC + "additionalType", x["data"]["uri"], True), Rule(SC + "encodingFormat", F.transform(x["format"], lambda f: f["uri"]), True, True)]
        out.append(rows(both, parameter_iri, described))
    return reduce(DataFrame.unionByName, out)


def parameter_iri(x: Column) -> Column:
    return F.concat(F.lit("urn:parameter:"), F.sha2(F.to_json(x), 256))


def _plain(fields: dict[str, tuple[str, str]]) -> dict[str, Rule]:
    """Rules from column -> (predicate, kind): L literal, I iri, and a * for each element."""
    at = lambda p: BSC + p.removeprefix("bioschemas:") if p.startswith("bioschemas:") else SC + p
    return {c: Rule(at(p), F.col(f"`{c}`"), "I" in k, "*" in k) for c, (p, k) in fields.items()} | {"*type": Rule(TYPE, F.lit(SC + "SoftwareApplication"), True)}


# Which column of each kind of flattened record becomes which property.
RECIPE = {
    "name": ("name", "L"), "description": ("description", "L"), "home": ("url", "L"), "dois": ("citation", "L*"), "identifiers": ("identifier", "L*"), "biotools": ("identifier", "I"), "license": ("license", "L"),
    "version": ("softwareVersion", "L"), "summary": ("alternateName", "L"), "source_urls": ("downloadUrl", "L*"), "software_help": ("softwareHelp", "L"), "maintainers": ("maintainer", "L*"),
}
SUITE = {
    "Suite_ID": ("name", "L"), "Description": ("description", "L"), "Suite_source": ("url", "I"), "topics": ("applicationSubCategory", "I*"), "operations": ("featureList", "I*"), "Suite_version": ("softwareVersion", "L"),
    "Homepage": ("codeRepository", "I"), "Suite_first_commit_date": ("dateCreated", "L"), "Tool_output_formats": ("encodingFormat", "L*"), "identifiers": ("identifier", "I*"), "workflows": ("isPartOf", "I*"),
    "servers": ("isPartOf", "I*"), "ToolShed_categories": ("keywords", "L*"), "outputs": ("bioschemas:output", "L*"),
}
DEBIAN = {
    "package": ("name", "L"), "homepage": ("url", "I"), "topics": ("applicationSubCategory", "I*"), "citations": ("citation", "L*"), "license": ("license", "L"), "version": ("softwareVersion", "L"),
    "identifiers": ("identifier", "I*"), "other_identifiers": ("identifier", "L*"), "functions": ("featureList", "I*"), "formats": ("encodingFormat", "I*"), "tags": ("keywords", "L*"),
    "data": ("additionalType", "I*"), "inputs": ("bioschemas:input", "I*"), "outputs": ("bioschemas:output", "I*"),
}
BIOCONDUCTOR = {
    "Package": ("name", "L"), "Description": ("description", "L"), "URL": ("url", "I"), "License": ("license", "L"), "Version": ("softwareVersion", "L"), "Date/Publication": ("dateModified", "L"),
    "Maintainer": ("maintainer", "L"), "Title": ("alternateName", "L"), "git_url": ("codeRepository", "I"), "Author": ("author", "L"), "Depends": ("hasPart", "L*"), "biocViews": ("keywords", "L*"),
}
CONTAINER = {
    "name": ("name", "L"), "description": ("description", "L"), "license": ("license", "L"), "biotools": ("identifier", "I"), "home_url": ("url", "I"), "keywords": ("keywords", "L*"), "dois": ("citation", "L*"),
}
WORKFLOW = {
    "link": ("url", "L"), "name": ("name", "L"), "description": ("description", "L"), "doi": ("citation", "L"), "latest_version": ("softwareVersion", "L"), "license": ("license", "L"), "creators": ("author", "L*"),
    "operations": ("featureList", "I*"), "topics": ("applicationSubCategory", "I*"), "create_time": ("dateCreated", "L"), "update_time": ("dateModified", "L"), "part_of": ("isPartOf", "I"), "tags": ("keywords", "L*"),
}
NODE = {
    "body": ("description", "L"), "title": ("name", "L"), "functions": ("featureList", "I*"), "topics": ("applicationSubCategory", "I*"), "citations": ("citation", "I*"), "citation_titles": ("citation", "L*"),
    "license": ("license", "L*"), "authors": ("publisher", "L*"), "created": ("dateCreated", "L"), "changed": ("dateModified", "L"), "requires": ("softwareRequirements", "I*"),
}


def mapper(fields: dict[str, tuple[str, str]], type_: str = "SoftwareApplication") -> dict[str, Rule]:
    return _plain(fields) | {"*type": Rule(TYPE, F.lit(SC + type_), True)}


def flatten_recipes(recipes: DataFrame) -> DataFrame:
    """The columns that RECIPE names, from recipes (doc VARIANT). Absent or empty parts are null or empty lists; a source that isn't one object gives no urls, a recipe without name no row.

    ``biotools`` is the IRI of the first such identifier; whether it and the help page resolve is for a join with url statuses to say.
    """
    text = lambda path: F.try_variant_get("doc", f"$.{path}", "string")
    many = lambda path: F.filter(F.coalesce(F.try_variant_get("doc", path, "array<string>"), F.array().cast("array<string>")), lambda x: x.isNotNull())
    starts = lambda x, prefix: F.startswith(F.lower(x), F.lit(prefix))
    ids = many("$.extra.identifiers")
    tool = F.get(F.filter(ids, lambda x: starts(x, "biotools:")), F.lit(0))
    urls = many("$.source.url")
    return recipes.select(
        text("package.name").alias("name"), F.coalesce(text("about.description"), text("about.summary")).alias("description"), text("about.home").alias("home"),
        F.filter(ids, lambda x: starts(x, "doi:")).alias("dois"), F.filter(ids, lambda x: ~starts(x, "doi:") & ~starts(x, "biotools:")).alias("identifiers"),
        F.concat(F.lit(PREFIXES["biotools"]), F.lower(F.substring(tool, 10, 1 << 20))).alias("biotools"), text("about.license").alias("license"), text("package.version").alias("version"),
        text("about.summary").alias("summary"), F.when(F.size(urls) > 0, urls).otherwise(F.array_compact(F.array(text("source.url")))).alias("source_urls"), text("about.software_help").alias("software_help"),
        many("$.extra['recipe-maintainers']").alias("maintainers"),
    ).where("name <> ''")


LEGACY, NODES, DC = "http://bise-eu.info/core-ontology#", "http://biii.eu/", "http://dcterms/"
# List column of a raw node -> (property, form). A link has a uri and a title, a term or node a target_id.
LEGACY_NODE = {
    "field_image": ("hasIllustration", "url"), "field_has_author": ("hasAuthor", "value"), "field_has_function": ("hasFunction", "target_uuid"), "field_has_topic": ("hasTopic", "target_uuid"),
    "field_is_dependent_of": ("requires", "node"), "field_has_reference_publication": ("hasReferencePublication", "link"), "field_has_location": ("hasLocation", "link"), "field_has_license": ("hasLicense", "value"),
    "field_license_openness": ("openess", "term"), "field_has_implementation": ("hasImplementation", "term"), "field_type": ("hasType", "term"), "field_has_programming_language": ("hasProgrammingLanguage", "term"),
    "field_platform": ("hasPlatform", "term"), "field_supported_image_dimension": ("hasSupportedImageDimension", "term"), "field_is_covered_by_training_mat": ("hasTrainingMaterial", "node"),
    "field_has_documentation": ("hasDocumentation", "link"), "field_has_comparison": ("hasComparison", "link"), "field_has_usage_example": ("hasUsageExample", "link"), "field_has_doi": ("hasDOI", "link"),
}


def _node_iri(v: Column) -> Column:
    """An absolute IRI as it is, else one below the nodes' base."""
    return F.when(F.rlike(v, F.lit("^[A-Za-z][A-Za-z0-9+.-]*:")), v).otherwise(F.concat(F.lit(NODES), F.regexp_replace(v, "^/", "")))


def _legacy(column: str, property_: str, form: str) -> list[Rule]:
    each = lambda f: F.transform(column, f)
    at = LEGACY + property_
    if form == "link":
        return [Rule(at, each(lambda x: F.when(x["uri"] != "", _node_iri(url_quote(x["uri"])))), True, True), Rule(at, each(lambda x: x["title"]), many=True)]
    if form in ("term", "node"):
        below = NODES + {"term": "taxonomy/term/", "node": "node/"}[form]
        return [Rule(at, each(lambda x: F.concat(F.lit(below), x["target_id"].cast("string"))), True, True)]
    if form == "target_uuid":
        return [Rule(at, each(lambda x: _node_iri(x["target_uuid"])), True, True)]
    return [Rule(at, each(lambda x: x[form]), many=True)]


def flatten_nodes(nodes: DataFrame) -> DataFrame:
    """The columns that NODE names, and ``node`` (the subject: alias, else the title's slug), of raw nodes of the software type. Lists that nodes lack are empty; of several dates the last counts."""
    have = set(nodes.columns)
    none = F.array().cast("array<string>")
    each = lambda c, f: F.coalesce(F.transform(c, f), none) if c in have else none
    first = lambda c, f: F.nullif(F.get(F.col(c), F.lit(0))[f], F.lit("")) if c in have else F.lit(None).cast("string")
    last = lambda c: F.try_element_at(F.filter(each(c, lambda x: x["value"]), lambda x: x != ""), F.lit(-1))
    title = first("title", "value")
    return nodes.where(first("type", "target_id") == "software").select(
        _node_iri(F.coalesce(first("path", "alias"), slug(title))).alias("node"), html_text(first("body", "value")).alias("body"), title.alias("title"),
        each("field_has_function", lambda x: _node_iri(x["target_uuid"])).alias("functions"), each("field_has_topic", lambda x: _node_iri(x["target_uuid"])).alias("topics"),
        each("field_has_reference_publication", lambda x: F.trim(x["uri"])).alias("citations"), each("field_has_reference_publication", lambda x: x["title"]).alias("citation_titles"),
        each("field_has_license", lambda x: x["value"]).alias("license"), each("field_has_author", lambda x: x["value"]).alias("authors"), last("created").alias("created"), last("changed").alias("changed"),
        each("field_is_dependent_of", lambda x: F.concat(F.lit(NODES + "node/"), F.trim(x["target_id"].cast("string")))).alias("requires"),
    )


def legacy_node_triples(nodes: DataFrame) -> DataFrame:
    """Raw nodes in the older ontology; columns that they lack give no triples, every link of a list counts, and of several dates the last does (in the session's time zone)."""
    first = lambda c, f: F.get(F.col(c), F.lit(0))[f]
    date = lambda c: F.date_format(F.timestamp_seconds(F.try_element_at(F.filter(c, lambda x: x["value"] != 0), F.lit(-1))["value"]), "yyyy-MM-dd'T'HH:mm:ss")
    have = set(nodes.columns)
    rules = [r for c, (p, form) in LEGACY_NODE.items() if c in have for r in _legacy(c, p, form)]
    rules += [Rule(DC + p, date(c)) for c, p in (("created", "created"), ("changed", "modified")) if c in have]
    if "type" in have:
        rules.append(Rule(TYPE, _node_iri(first("type", "target_id")), True))
    if "title" in have:
        rules.append(Rule(DC + "title", first("title", "value")))
    if "body" in have:
        nodes = nodes.withColumn("_body", html_text(first("body", "value")))
        rules.append(Rule("http://www.w3.org/2000/01/rdf-schema#comment", F.col("_body")))
    return triples(nodes, _node_iri(first("path", "alias")), rules)


def debian_identifiers(name: Column, entry: Column) -> Column:
    """The identifier of one registry entry: an IRI for known registries, else ``name:entry``."""
    at = lambda p: F.concat(F.lit(PREFIXES[p]), entry)
    return F.when(name == "bio.tools", F.concat(F.lit(PREFIXES["biotools"]), F.lower(entry))).when(name == "conda:bioconda", at("bioconda")).when(name == "SciCrunch", at("scicrunch")).when(name == "guix", at("guix")).otherwise(F.concat_ws(":", F.lower(name), entry))


def labels_to_terms(docs: DataFrame, key: str, labels: str, terms: DataFrame) -> DataFrame:
    """(key, entity) for each label an ontology knows; the ontology (label, entity) is broadcast by Spark's own size check."""
    return docs.select(key, F.explode(labels).alias("label")).join(terms, "label").select(key, F.substring_index("entity", "/", -1).alias("entity")).distinct()


def union_graph(*parts: DataFrame) -> DataFrame:
    """The distinct triples of all parts, which may have repeats of their own."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def class_counts(graph: DataFrame) -> DataFrame:
    return graph.where(F.col("p") == TYPE).groupBy(F.col("o").alias("class")).agg(F.count("*").alias("n"))


def property_counts(graph: DataFrame) -> DataFrame:
    return graph.groupBy(F.col("p").alias("property")).agg(F.count("*").alias("n"))


def ntriples(graph: DataFrame) -> DataFrame:
    iri = lambda c: F.concat(F.lit("<"), iri_escape(F.col(c)), F.lit(">"))
    o = F.when(F.col("o_kind") == "iri", iri("o")).otherwise(F.concat(F.lit('"'), ntriples_escape(F.col("o")), F.lit('"')))
    return graph.select(F.concat_ws(" ", iri("s"), iri("p"), o, F.lit(".")).alias("value"))


def jsonld(graph: DataFrame) -> DataFrame:
    """One JSON-LD document a subject: predicate -> sorted objects."""
    iri = F.col("o_kind") == "iri"
    o = F.struct(F.when(iri, F.col("o")).alias("@id"), F.when(~iri, F.col("o")).alias("@value"))
    by = graph.groupBy("s", "p").agg(F.sort_array(F.collect_set(o)).alias("objects"))
    fields = by.groupBy("s").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("p", "objects")))).alias("fields"))
    name = F.to_json(F.array("s"))
    return fields.select("s", F.concat(F.lit('{"@id":'), F.substring(name, F.lit(2), F.length(name) - 2), F.lit(","), F.substring(F.to_json("fields"), 2, 1 << 30)).alias("value"))


def expand(curie: Column, prefixes: dict[str, str] | None = None) -> Column:
    """``prefix:rest`` as an IRI, for the prefixes known; anything else as it is."""
    out = curie
    for prefix, base in (PREFIXES if prefixes is None else prefixes).items():
        out = F.when(F.startswith(curie, F.lit(prefix + ":")) & ~F.startswith(curie, F.lit(prefix + "://")), F.concat(F.lit(base), F.substring(curie, len(prefix) + 2, 1 << 30))).otherwise(out)
    return out


TAGGED = "s string, p string, o string, o_kind string, lang string, datatype string"


def distinct_graph(rows: DataFrame, tagged: bool) -> DataFrame:
    """Distinct triples of rows of TAGGED; tagged: with the language and the datatype of literals."""
    return (rows if tagged else rows.select("s", "p", "o", "o_kind")).where("o is not null").distinct()


def parser(read):
    """A function for mapInArrow that gives read(text) of each row's first column, a text, as rows of TAGGED."""

    def rows(batches):
        import pyarrow as pa

        names = [f.split(" ")[0] for f in TAGGED.split(", ")]
        columns = lambda found: pa.RecordBatch.from_arrays([pa.array([t[i] for t in found], pa.string()) for i in range(len(names))], names)
        for batch in batches:
            found, held = [], 0
            for text in batch.column(0):
                for t in read(text.as_py()) if text.is_valid else ():
                    found.append(t)
                    held += len(t[0]) + len(t[2] or "")
                    if len(found) == 10_000 or held > 4 << 20:  # of a large document some triples at once
                        yield columns(found)
                        found, held = [], 0
            yield columns(found)

    return rows


def _parsed(texts: DataFrame, read) -> DataFrame:
    """read(text) of each row of a table with one text column, as rows of TAGGED."""
    return texts.mapInArrow(parser(read), TAGGED)


def from_jsonld(docs: DataFrame, prefixes: dict[str, str] | None = None, vocabulary: str | None = SC, contexts: dict[str, dict] | None = None, tagged: bool = False) -> DataFrame:
    """(s, p, o, o_kind), tagged: and (lang, datatype), of JSON-LD documents (doc VARIANT), expanded or compact, with their contexts.

    Contexts: terms, prefixes, @vocab, @base, @language, types (@id, @vocab or a datatype) and containers (@list, @set, @language, @index), in the document, in a nested node, in lists, or by the address of one in ``contexts``; before any of
    these, ``prefixes`` and names in ``vocabulary`` hold (None: a name without meaning gives nothing). Nested nodes are followed. Nodes without @id are named by a hash of what they say, so equal ones are one; labels of blank nodes hold within their
    document; lists are chains of first and rest. Null values give nothing; documents that aren't JSON, none.
    """
    from ..functions.jsonld import triples_of

    known, named = PREFIXES if prefixes is None else prefixes, contexts or {}
    return distinct_graph(_parsed(docs.where("doc is not null").select(F.to_json("doc")), lambda text: triples_of(text, known, vocabulary, named)), tagged)


def from_turtle(texts: DataFrame, tagged: bool = False) -> DataFrame:
    """(s, p, o, o_kind), tagged: and (lang, datatype), of Turtle documents, one a row of the table's only column. One that isn't Turtle fails the job."""
    from ..functions.jsonld import turtle_triples

    return distinct_graph(_parsed(texts, turtle_triples), tagged)


def _quoted(c: Column) -> Column:
    """A text as JSON."""
    text = F.to_json(F.array(c))
    return F.substring(text, F.lit(2), F.length(text) - 2)


def _with_tags(graph: DataFrame) -> DataFrame:
    for c in ("lang", "datatype"):
        if c not in graph.columns:
            graph = graph.withColumn(c, F.lit(None).cast("string"))
    return graph


def _shortest(iri: Column, bases: dict[str, str], made, otherwise: Column) -> Column:
    """made(name, rest) for the longest base that the IRI starts with (of equal ones the first name), else what is given."""
    out = otherwise
    for name, base in sorted(bases.items(), key=lambda x: (len(x[1]), [-ord(c) for c in x[0]])):
        out = F.when(F.startswith(iri, F.lit(base)), made(name, F.substring(iri, len(base) + 1, 1 << 30))).otherwise(out)
    return out


def compact(graph: DataFrame, context: dict) -> DataFrame:
    """(s, value): one JSON-LD document a subject, compacted by a context: terms (texts, or {"@id", "@type"}), prefixes (terms whose IRI ends in / or #) and @vocab.

    A predicate's links take a term of type @id, its literals of a datatype a term of that type, others a term without type; where there is none, the name in @vocab, prefix:rest or the whole IRI, with links as {"@id"} and typed or tagged
    literals as {"@value"}. A key holds its only value or the sorted list of them; keys are sorted. No name that the context gives another meaning is used. Read back with the context, the graph is the same.
    """
    given = {t: ({"@id": d} if isinstance(d, str) else d) for t, d in context.items() if not t.startswith("@")}
    bases = {t: d["@id"] for t, d in given.items() if d["@id"].endswith(("/", "#"))}
    full = lambda iri: next((bases[p] + r for p, c, r in [iri.partition(":")] if c and p in bases and not r.startswith("//")), iri)
    terms = {}
    for t, d in sorted(given.items(), reverse=True):  # of several the first name
        terms[full(d["@id"]), d.get("@type") if str(d.get("@type")).startswith("@") else full(d["@type"]) if "@type" in d else ""] = t
    lookup = F.create_map(*(F.lit(x) for (iri, kind), t in terms.items() for x in (f"{kind} {iri}", t))) if terms else F.create_map().cast("map<string,string>")
    vocab = context.get("@vocab")
    relative = lambda iri: F.substring(iri, len(vocab) + 1, 1 << 30)
    free = lambda name: ~F.contains(name, F.lit(":")) & ~F.startswith(name, F.lit("@")) & (name != "") & ~name.isin(list(given))

    def prefixed(iri: Column) -> Column:
        return _shortest(iri, bases, lambda p, rest: F.when(F.startswith(rest, F.lit("//")), iri).otherwise(F.concat(F.lit(p + ":"), rest)), iri)

    def named(iri: Column) -> Column:
        short = prefixed(iri)
        if vocab:
            short = F.when(F.startswith(iri, F.lit(vocab)) & free(relative(iri)), relative(iri)).otherwise(short)
        return short

    g = _with_tags(graph)
    iri, wanted = F.col("o_kind") == "iri", F.coalesce("datatype", F.when(F.col("o_kind") == "iri", "@id").otherwise(""))
    plain = F.try_element_at(lookup, F.concat(F.lit(" "), "p"))
    term = F.when(F.col("lang").isNotNull(), F.lit(None).cast("string")).otherwise(F.try_element_at(lookup, F.concat_ws(" ", wanted, "p")))
    type_ = F.col("p") == TYPE
    key = F.when(type_ & iri, "@type").when(term.isNotNull(), term).otherwise(F.coalesce(plain, named(F.col("p"))))
    fields = lambda **x: F.concat(F.lit("{"), F.concat_ws(",", *(F.concat(F.lit(f'"@{k}":'), v) for k, v in x.items())), F.lit("}"))
    text = _quoted(F.col("o"))
    literal = F.when(F.col("lang").isNotNull(), fields(language=_quoted(F.col("lang")), value=text)).when(F.col("datatype").isNotNull() & term.isNull(), fields(type=_quoted(named(F.col("datatype"))), value=text)).otherwise(text)
    value = F.when(type_ & iri, _quoted(named(F.col("o")))).when(iri & term.isNotNull(), _quoted(prefixed(F.col("o")))).when(iri, fields(id=_quoted(prefixed(F.col("o"))))).otherwise(literal)
    by = g.where("o is not null").select("s", key.alias("key"), value.alias("v")).groupBy("s", "key").agg(F.sort_array(F.collect_set("v")).alias("v"))
    entry = F.concat(_quoted(F.col("key")), F.lit(":"), F.when(F.size("v") == 1, F.col("v")[0]).otherwise(F.concat(F.lit("["), F.array_join("v", ","), F.lit("]"))))
    body = by.select("s", F.struct("key", entry.alias("entry")).alias("e")).groupBy("s").agg(F.array_join(F.transform(F.sort_array(F.collect_list("e")), lambda e: e["entry"]), ",").alias("body"))
    import json

    head = F.lit(f'{{"@context":{json.dumps(context, sort_keys=True, ensure_ascii=False)},"@id":')
    return body.select("s", F.concat(head, _quoted(prefixed(F.col("s"))), F.lit(","), "body", F.lit("}")).alias("value"))


def turtle(graph: DataFrame, prefixes: dict[str, str] | None = None) -> DataFrame:
    """(s, value): one Turtle statement a subject, its predicates and objects grouped and sorted, ``a`` first, on one line; for the prefixes see turtle_head.

    What may not stand in an IRI is percent-encoded, local names with other characters than letters, digits, _, - and inner points stay whole IRIs.
    """
    known = PREFIXES if prefixes is None else prefixes
    whole = lambda iri: F.concat(F.lit("<"), iri_escape(iri), F.lit(">"))

    def name(iri: Column) -> Column:
        return _shortest(iri, known, lambda p, rest: F.when(F.rlike(rest, F.lit(r"^[A-Za-z0-9_]([A-Za-z0-9_.-]*[A-Za-z0-9_-])?$")), F.concat(F.lit(p + ":"), rest)).otherwise(whole(iri)), whole(iri))

    g = _with_tags(graph).where("o is not null")
    tag = F.when(F.col("lang").isNotNull(), F.concat(F.lit("@"), "lang")).when(F.col("datatype").isNotNull(), F.concat(F.lit("^^"), name(F.col("datatype")))).otherwise("")
    o = F.when(F.col("o_kind") == "iri", name(F.col("o"))).otherwise(F.concat(F.lit('"'), ntriples_escape(F.col("o")), F.lit('"'), tag))
    by = g.select("s", (F.col("p") != TYPE).alias("later"), F.when(F.col("p") == TYPE, "a").otherwise(name(F.col("p"))).alias("p"), o.alias("o")).groupBy("s", "later", "p").agg(F.sort_array(F.collect_set("o")).alias("o"))
    facts = by.select("s", F.struct("later", F.concat_ws(" ", "p", F.array_join("o", ", ")).alias("text")).alias("f")).groupBy("s").agg(F.sort_array(F.collect_list("f")).alias("f"))
    return facts.select("s", F.concat(name(F.col("s")), F.lit(" "), F.array_join(F.transform("f", lambda f: f["text"]), " ; "), F.lit(" .")).alias("value"))


def turtle_head(prefixes: dict[str, str] | None = None) -> list[str]:
    """The prefix lines that a file of turtle() begins with."""
    return [f"@prefix {p}: <{base}> ." for p, base in sorted((PREFIXES if prefixes is None else prefixes).items())]


def triple_count(graph: DataFrame) -> DataFrame:
    return graph.distinct().agg(F.count("*").alias("n"))
