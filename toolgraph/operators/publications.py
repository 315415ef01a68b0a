"""Publication metadata out of the answers of three providers (doc VARIANT), and links that documents give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_list, clean_abstract, first_date, first_of, people

_PERSON = "struct<given:string,family:string,literal:string,name:string>"


def _at(path: str) -> Column:
    return F.try_variant_get("doc", path, "string")


def _parts(*names: str) -> list[Column]:
    return [F.get(F.try_variant_get("doc", f"$['{n}']['date-parts']", "array<array<int>>"), F.lit(0)) for n in names]


def _authors() -> Column:
    found = F.try_variant_get("doc", "$.author", f"array<{_PERSON}>")
    return F.coalesce(people(found), F.array().cast("array<struct<name:string>>"))


def _record(doi: Column, abstract: Column, authors: Column, citations: Column, date: Column, journal: Column, title: Column) -> list[Column]:
    none = lambda c: F.coalesce(c, F.lit(""))
    return [doi.alias("doi"), none(abstract).alias("abstract"), authors.alias("authors"), citations.cast("long").alias("citationCount"), date.alias("date"), none(journal).alias("journal"), none(title).alias("title")]


def from_csl(answers: DataFrame) -> DataFrame:
    """Of a resolver's citation JSON (doi, doc): the first date of print, online, any, issue; no citation count."""
    dates = first_date(*_parts("published-print", "published-online", "published", "issued"))
    journal = first_of(F.get(as_list(F.col("doc"), "$['container-title']"), F.lit(0)), F.get(as_list(F.col("doc"), "$['container-title-short']"), F.lit(0)))
    return answers.select(*_record(F.col("doi"), clean_abstract(_at("$.abstract")), _authors(), F.lit(None), dates, journal, _at("$.title")))


def from_crossref(answers: DataFrame) -> DataFrame:
    """Of the registration agency's message (doi, doc): titles are lists; parts that a date lacks are 1."""
    first = lambda path: F.get(as_list(F.col("doc"), path), F.lit(0))
    dates = first_date(*_parts("published-print", "published-online", "published"))
    count = F.try_variant_get("doc", "$['is-referenced-by-count']", "long")
    return answers.select(*_record(F.col("doi"), _at("$.abstract"), _authors(), count, dates, first_of(first("$['container-title']"), first("$['short-container-title']")), first("$.title")))


def from_europepmc(answers: DataFrame) -> DataFrame:
    """Of a literature archive's search result (doi, doc: the result list, of which the first counts)."""
    top = answers.select("doi", F.try_variant_get("doc", "$.resultList.result[0]", "variant").alias("doc")).where("doc is not null")
    names = F.transform(F.try_variant_get("doc", "$.authorList.author", "array<struct<fullName:string>>"), lambda a: F.struct(a["fullName"].alias("name")))
    authors = F.coalesce(F.filter(names, lambda a: a["name"].isNotNull()), F.array().cast("array<struct<name:string>>"))
    date = F.try_to_date(_at("$.journalInfo.printPublicationDate"))
    return top.select(*_record(F.col("doi"), _at("$.abstractText"), authors, F.try_variant_get("doc", "$.citedByCount", "long"), date, _at("$.journalInfo.journal.title"), _at("$.title")))


def best(*providers: DataFrame) -> DataFrame:
    """One record for each doi, from the first provider that knows it."""
    rows = None
    for rank, df in enumerate(providers):
        own = df.withColumn("_rank", F.lit(rank))
        rows = own if rows is None else rows.unionByName(own)
    fields = [c for c in providers[0].columns if c != "doi"]
    picked = rows.groupBy("doi").agg(F.min_by(F.struct(*fields), F.col("_rank")).alias("x"))
    return picked.select("doi", *(F.col(f"x.{c}").alias(c) for c in fields))
