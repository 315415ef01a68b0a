"""Packages to tool documents, and what that does to a catalogue: create, update with selected fields, keep the source and the previous version beside.

Documents are rows with nested columns. Every step is a join on the tool's id, so a whole catalogue is converted and updated in one plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.authors import credits
from ..functions.licenses import normalise
from ..functions.text import doi_links
from . import upsert
from .storage import stored, workspace

# The constants of a converted document, the fields that an existing one keeps, and those that an update takes over.
COLLECTION, LANGUAGES, SYSTEMS, OWNER, TYPES = "BioConductor", ["R"], ["Linux", "Mac", "Windows"], "bioconductor_import", ["Command-line tool", "Library"]
SITE = "https://bioconductor.org/packages/"
PRESERVED = ("additionDate", "biotoolsCURIE", "biotoolsID", "collectionID", "editPermission", "function")
UPDATED = ("credit", "description", "documentation", "download", "homepage", "license", "publication", "version")
#: Of these a null in the new document counts: it always has them.
NULLABLE = ("license",)
FIELDS = ("Package", "Author", "Description", "URL", "License", "Version")


def tool_id(package: Column) -> Column:
    return F.concat(F.lit("bioconductor-"), F.lower(package))


def _texts(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def publications(html: Column) -> Column:
    """array<struct<doi>> of the links to the resolver; null without a page."""
    return F.when(html != "", F.transform(doi_links(html), lambda d: F.struct(d.alias("doi"))))


def convert(packages: DataFrame, citations: DataFrame | None = None, existing: DataFrame | None = None) -> DataFrame:
    """One tool document for each package (Package, Author, Description, URL, License, Version; a field that is missing is the empty text).

    citations: (package, html), joined by the package's name (of several pages of a package the greatest); existing: documents whose PRESERVED fields (those that the table has) win where they aren't null.
    """
    have = packages.select(*((F.coalesce(F.col(c), F.lit("")) if c in packages.columns else F.lit("")).alias(c) for c in FIELDS))
    page = F.concat(F.lit(SITE), "Package")
    if citations is not None:
        pages = citations.groupBy(F.col("package").alias("_package")).agg(F.max("html").alias("_html"))
        have = have.join(pages, F.col("Package") == F.col("_package"), "left").drop("_package")
    else:
        have = have.withColumn("_html", F.lit(None).cast("string"))
    out = normalise(have, "License", "_spdx").select(
        F.concat(F.lit("biotools:"), tool_id(F.col("Package"))).alias("biotoolsCURIE"), tool_id(F.col("Package")).alias("biotoolsID"), _texts([COLLECTION]).alias("collectionID"),
        credits(F.col("Author")).alias("credit"), F.col("Description").alias("description"), F.array(F.struct(_texts(["User manual"]).alias("type"), page.alias("url"))).alias("documentation"),
        F.array(F.struct(F.lit("Source code").alias("type"), F.col("URL").alias("url"))).alias("download"), page.alias("homepage"), _texts(LANGUAGES).alias("language"), F.col("_spdx").alias("license"),
        F.col("Package").alias("name"), _texts(SYSTEMS).alias("operatingSystem"), F.lit(OWNER).alias("owner"), _texts(TYPES).alias("toolType"), F.array("Version").alias("version"), publications(F.col("_html")).alias("publication"),
    )
    if existing is None:
        return out
    kept = [c for c in PRESERVED if c in existing.columns and c != "biotoolsID"]
    for c in kept:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(existing.schema[c].dataType))
    return upsert.preserve(out, existing.dropDuplicates(["biotoolsID"]), "biotoolsID", kept)


def update(existing: DataFrame, converted: DataFrame, pairs: DataFrame) -> DataFrame:
    """The existing documents, those that a pair (old, new: biotoolsIDs) links with the UPDATED fields of the new one and its collection; all other fields as they were.

    A converted document without a publication page leaves the publications alone; a null licence overwrites. Of several new ones for an old document the last by id counts.
    """
    one = pairs.groupBy("old").agg(F.max("new").alias("new"))
    fresh = converted.select(F.col("biotoolsID").alias("new"), *(c for c in UPDATED if c in converted.columns)).join(one, "new").drop("new").withColumnRenamed("old", "biotoolsID")
    columns = [c for c in UPDATED if c in existing.columns and c in fresh.columns]
    merged = upsert.overwrite(existing, fresh, "biotoolsID", columns, nullable=tuple(c for c in NULLABLE if c in columns))
    linked = one.select(F.col("old").alias("biotoolsID"), F.lit(True).alias("_linked"))
    collections = F.when(F.col("_linked"), upsert.add_collection(F.col("collectionID"), COLLECTION)).otherwise(F.col("collectionID"))
    return merged.join(linked, "biotoolsID", "left").withColumn("collectionID", collections).select(*existing.columns)


def create(converted: DataFrame, pairs: DataFrame) -> DataFrame:
    """The converted documents that no pair links: new entries."""
    return converted.join(pairs.select(F.col("new").alias("biotoolsID")).distinct(), "biotoolsID", "left_anti")


def backups(existing: DataFrame, pairs: DataFrame) -> DataFrame:
    """The previous version of each document that an update changes."""
    return existing.join(pairs.select(F.col("old").alias("biotoolsID")).distinct(), "biotoolsID", "left_semi")


def sources(tools: DataFrame, packages: DataFrame) -> DataFrame:
    """(biotoolsID, source, document): the package's own record as JSON, kept beside each created or updated tool; found by the id without its prefix, in lower case on both sides."""
    own = packages.select(F.lower("Package").alias("_package"), F.to_json(F.struct(*packages.columns)).alias("document"))
    wanted = tools.select("biotoolsID", F.lower(F.regexp_replace("biotoolsID", "^bioconductor-", "")).alias("_package")).distinct()
    return wanted.join(own, "_package").select("biotoolsID", F.lit("bioconductor").alias("source"), "document")


def summary(existing: DataFrame, converted: DataFrame, pairs: DataFrame) -> DataFrame:
    """(action, n): created, updated and only_existing documents."""
    new = converted.select("biotoolsID").join(pairs.select(F.col("new").alias("biotoolsID")).distinct(), "biotoolsID", "left_anti")
    old = existing.select("biotoolsID").join(pairs.select(F.col("old").alias("biotoolsID")).distinct(), "biotoolsID", "left_anti")
    counted = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("action"), "n")
    return counted(new, "created").unionAll(counted(pairs.select("old").distinct(), "updated")).unionAll(counted(old, "only_existing"))


def sync(packages: DataFrame, existing: DataFrame, methods: list[str], citations: DataFrame | None = None) -> dict[str, DataFrame]:
    """Convert, match by the identity methods, and apply: created, updated, backups, sources, pairs and summary.

    The converted documents, which five of these need, are written once, as are the pairs, below spark.checkpoint.dir.
    """
    from . import matching

    folder = workspace(packages.sparkSession, "sync")
    converted = stored(convert(packages, citations, existing), f"{folder}/converted")
    left, right = (matching.keys(df, methods, "biotoolsID") for df in (existing, converted))
    pairs = stored(matching.assign(left, right).select(F.col("f1").alias("old"), F.col("f2").alias("new")), f"{folder}/pairs")
    created, updated = create(converted, pairs), update(existing, converted, pairs)
    touched = created.select("biotoolsID").unionByName(pairs.select(F.col("old").alias("biotoolsID")))
    return {"created": created, "updated": updated, "backups": backups(existing, pairs), "sources": sources(touched, packages), "pairs": pairs, "summary": summary(existing, converted, pairs)}
