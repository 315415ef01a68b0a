"""Column functions over text, urls, identifiers and dates. All of them are built-in expressions, so they stay in the JVM."""

from __future__ import annotations

import html.parser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clean_version(v: Column) -> Column:
    """Upstream part of a packaged version: drops the revision and the dfsg, lgpl and biolinux marks."""
    for pattern in (r"-[.\d]+$", r"\+dfsg.*$", r"\+lgpl.*$", r"-\d*biolinux\d*$"):
        v = F.regexp_replace(v, pattern, "")
    return v


def strip_binary_upload(v: Column) -> Column:
    return F.regexp_replace(v, r"\+b[0-9]+$", "")


def remove_protocol(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(url)


def normalise_package_url(url: Column) -> Column:
    """The stable address of a package page, whatever the release it was linked in."""
    return F.regexp_replace(url, r"^(https?://bioconductor\.org/packages/)(?:release|[^/]+/bioc)/html/([^/]+)\.html(?:\?.*)?$", "$1$2")


def slug(title: Column) -> Column:
    return F.replace(F.replace(F.lower(title), F.lit("/"), F.lit("")), F.lit(" "), F.lit("-"))


def percent_escape_doi(doi: Column) -> Column:
    return F.replace(F.replace(doi, F.lit("["), F.lit("%5B")), F.lit("]"), F.lit("%5D"))


def percent_escape_url(url: Column) -> Column:
    return F.replace(url, F.lit("|"), F.lit("%7C"))


def url_quote(text: Column) -> Column:
    """Percent-encoding that leaves ``:`` and ``/`` alone."""
    out = F.url_encode(text)
    for a, b in (("+", "%20"), ("%3A", ":"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def clean_abstract(text: Column) -> Column:
    """Markup out, white space collapsed, and a leading ``Abstract`` dropped."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(text, "<[^>]+>", " "), r"\s+", " "))
    return F.regexp_replace(plain, "^Abstract ", "")


#: The address of an ``a`` element, in quotes of either kind or none.
HREF = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""


def hrefs(html: Column) -> Column:
    """Addresses of all links, in order: trimmed, entities of marks resolved."""

    def bare(x: Column) -> Column:
        x = F.regexp_replace(x, "^[\"']|[\"']$", "")
        for entity, mark in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
            x = F.replace(x, F.lit(entity), F.lit(mark))
        return F.trim(x)

    return F.transform(F.regexp_extract_all(html, F.lit(HREF), F.lit(1)), bare)


def doi_links(html: Column, host: str = "doi.org") -> Column:
    """DOIs of all links to the resolver, in order, repeats kept."""
    return F.transform(F.filter(hrefs(html), lambda u: F.contains(u, F.lit(host))), lambda u: F.substring_index(u, f"{host}/", -1))


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]*>", "")


@F.pandas_udf(T.StringType())
def html_text(s: pd.Series) -> pd.Series:
    """Text of an HTML fragment with entities resolved (needs a real parser, so an Arrow function)."""

    class Parser(html.parser.HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.parts: list[str] = []

        def handle_data(self, data):
            self.parts.append(data)

    def one(x):
        if x is None:
            return None
        p = Parser()
        p.feed(x)
        p.close()
        return "".join(p.parts)

    return s.map(one)


def clean_doi(doi: Column) -> Column:
    return F.trim(F.replace(doi, F.lit("doi:"), F.lit("")))


def id_from_uri(uri: Column, endpoint: str) -> Column:
    """The second part of ``source:id:version`` (the first if there is one part) of the path segment after the endpoint."""
    parts = F.split(F.split(F.replace(uri, F.lit(endpoint), F.lit("")), "/")[0], ":")
    return F.when(F.size(parts) > 1, parts[1]).otherwise(parts[0])


def cross_refs(identifiers: Column, prefix: str = "biotools:") -> Column:
    """Lower-cased ids of the identifiers that have the (case-sensitive) prefix."""
    return F.transform(F.filter(identifiers, lambda x: F.startswith(x, F.lit(prefix))), lambda x: F.lower(F.split(x, ":")[1]))


def first_entry(entries: Column, name: str) -> Column:
    """``entry`` of the first struct (name, entry) of that name, or null."""
    return F.get(F.filter(entries, lambda x: x["name"] == name), F.lit(0))["entry"]


def training_urls(tutorials: Column, base: str, strict: bool = False) -> Column:
    """``topic/name`` becomes a full address; entries that are addresses already stay (strict: go)."""
    full = lambda x: F.startswith(x, F.lit("http"))
    made = F.transform(tutorials, lambda x: F.when(full(x), x).otherwise(F.concat(F.lit(base), F.split(x, "/")[0], F.lit("/tutorials/"), F.split(x, "/")[1], F.lit("/tutorial.html"))))
    return F.filter(made, lambda x: F.startswith(x, F.lit(base))) if strict else made


def person_name(p: Column) -> Column:
    """``given family``, else literal, else name."""
    joined = F.concat_ws(" ", p["given"], p["family"])
    return F.coalesce(F.nullif(joined, F.lit("")), p["literal"], p["name"])


def people(names: Column) -> Column:
    """array<struct<name>> of an author list; entries without any name are left out."""
    return F.filter(F.transform(names, lambda p: F.struct(F.nullif(F.trim(person_name(p)), F.lit("")).alias("name"))), lambda x: x["name"].isNotNull())


def first_of(*candidates: Column) -> Column:
    """The first text that isn't null or empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in candidates))


def iso_time(t: Column) -> Column:
    """An ISO timestamp in the session's time zone, of one with or without offset; null if it can't be read."""
    return F.date_format(F.try_to_timestamp(t), "yyyy-MM-dd'T'HH:mm:ss")


def epoch_time(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss")


def score_of(text: Column) -> Column:
    """A score as a whole number; null for what is none."""
    return F.try_cast(text, "int") if hasattr(F, "try_cast") else text.try_cast("int")


def as_list(doc: Column, path: str) -> Column:
    """The texts at a path of a VARIANT that holds one text or a list of them; empty where there are none."""
    several = F.try_variant_get(doc, path, "array<string>")
    one = F.array_compact(F.array(F.try_variant_get(doc, path, "string")))
    return F.filter(F.coalesce(several, F.when(F.try_variant_get(doc, path, "map<string,variant>").isNull(), one), F.array().cast("array<string>")), lambda x: x.isNotNull())


def first_date(*choices: Column) -> Column:
    """The date of the first choice of [year, month?, day?] that is there."""
    return partial_date(F.coalesce(*choices))


def partial_date(parts: Column) -> Column:
    """A date of [year, month?, day?], missing parts being 1."""
    return F.make_date(F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.lit(1)), F.coalesce(F.get(parts, F.lit(2)), F.lit(1)))


def debian_sort_key(v: Column) -> Column:
    """A text whose byte order is the order of package versions, equal for equal versions: epoch (0 if there is none), upstream version, and revision after the last hyphen (0 if there is none).

    A part is pairs of a run of other characters, which may be empty, and a number (0 if there is none). Of characters ~ comes before the end of a run, the end before letters, letters before other marks;
    a number is led by how many digits it has. The end of a part counts as the end of a run.
    """

    def number(x: Column) -> Column:
        digits = F.regexp_replace(x, "^0+", "")
        return F.concat(F.lpad(F.length(digits).cast("string"), 6, "0"), digits)

    def part(x: Column) -> Column:
        pairs = F.regexp_extract_all(x, F.lit("([^0-9]*[0-9]+|[^0-9]+)"), F.lit(1))
        run = lambda p: F.regexp_replace(F.replace(F.regexp_replace(p, "[0-9]+$", ""), F.lit("~"), F.lit("\u0001")), r"([^A-Za-z\u0001])", "\u007f$1")
        keyed = F.transform(F.when(F.size(pairs) > 0, pairs).otherwise(F.array(F.lit("0"))), lambda p: F.concat(run(p), F.lit("\u0002"), number(F.regexp_extract(p, "([0-9]*)$", 1))))
        return F.concat(F.array_join(keyed, ""), F.lit("\u0002"))

    at = F.instr(v, ":")
    rest = F.when(at > 0, F.substring(v, at + 1, F.length(v))).otherwise(v)
    hyphen = F.instr(F.reverse(rest), "-")  # from the end
    upstream = F.when(hyphen > 0, F.substring(rest, F.lit(1), F.length(rest) - hyphen)).otherwise(rest)
    revision = F.when(hyphen > 0, F.substring(rest, F.length(rest) - hyphen + 2, hyphen)).otherwise("")
    return F.concat(number(F.when(at > 0, F.substring(v, F.lit(1), at - 1)).otherwise("0")), F.lit("|"), part(upstream), part(revision))


def iri_escape(iri: Column) -> Column:
    """Percent-encodes what may not stand in an IRI."""
    for mark in "<>\"{}|^`\\ \t\n\r":
        iri = F.replace(iri, F.lit(mark), F.lit(f"%{ord(mark):02X}"))
    return iri


def ntriples_escape(text: Column) -> Column:
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text
