"""Commands: convert packages to tool documents, compare two sets of documents, update a catalogue, or all three (sync).

    python -m toolgraph.cli sync PACKAGES EXISTING --out FOLDER [--methods name_homepage doi] [--citations FILES] [--dry-run]

Inputs are JSON files (glob patterns) in any store that Spark reads; outputs are Parquet tables below the folder.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import converter, matching
from .operators.storage import stored, workspace
from .sources import readers

# The identity methods that are used if none are named.
DEFAULT_METHODS = ["name_homepage", "doi"]
DOCUMENT = (
    "biotoolsCURIE string, biotoolsID string, additionDate string, collectionID array<string>, credit array<struct<name:string,typeEntity:string,orcidid:string,typeRole:array<string>>>, description string,"
    "documentation array<struct<type:array<string>,url:string>>, download array<struct<type:string,url:string>>, editPermission struct<type:string,authors:array<string>>,"
    "function array<struct<operation:array<struct<term:string,uri:string>>>>, homepage string, language array<string>, license string, name string, operatingSystem array<string>, owner string,"
    "toolType array<string>, version array<string>, publication array<struct<doi:string>>"
)
PACKAGE = "Package string, Author string, Description string, URL string, License string, Version string"


def _documents(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """The documents, stored: several steps need them, and each file is opened once."""
    docs, _ = readers.json_documents(spark, pattern)
    return stored(docs.select(F.from_json(F.to_json("doc"), schema).alias("d")).select("d.*"), workspace(spark, "documents"))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="toolgraph", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *names: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        for n in names:
            p.add_argument(n)
        p.add_argument("--out", required=True, help="folder for the resulting tables")
        p.add_argument("--dry-run", action="store_true", help="report what would be done, write nothing")
        return p

    for name, inputs in (("convert", ("packages",)), ("sync", ("packages", "existing"))):
        p = command(name, *inputs)
        p.add_argument("--citations", help="pattern of citation pages PACKAGE.bioconductor.citation.html")
        if name == "sync":
            p.add_argument("--methods", nargs="+", default=DEFAULT_METHODS)
            p.add_argument("--no-backup", action="store_true")
            p.add_argument("--no-copy-source", action="store_true")
        else:
            p.add_argument("--existing", help="documents whose own fields are kept")
    p = command("compare", "left", "right")
    p.add_argument("--methods", nargs="+", default=DEFAULT_METHODS)
    p = command("update", "pairs", "converted", "existing")
    p.add_argument("--no-backup", action="store_true")
    return parser


def run(spark: SparkSession, argv: list[str]) -> int:
    """Runs one command; 1 if a method is unknown."""
    args = _parser().parse_args(argv)
    unknown = [m for m in getattr(args, "methods", []) if m not in matching.IDENTITIES]
    if unknown:
        print(f"unknown identity methods: {unknown}; known: {sorted(matching.IDENTITIES)}", file=sys.stderr)
        return 1
    pages = readers.side_files(spark, args.citations, ".bioconductor.citation.html") if getattr(args, "citations", None) else None
    if args.command == "convert":
        existing = _documents(spark, args.existing, DOCUMENT) if args.existing else None
        tables = {"converted": converter.convert(_documents(spark, args.packages, PACKAGE), pages, existing)}
    elif args.command == "compare":
        left, right = (_documents(spark, x, DOCUMENT) for x in (args.left, args.right))
        a, b = (matching.keys(x, args.methods, "biotoolsID") for x in (left, right))
        found = matching.matched(a, b)
        files = [x.select(F.col("biotoolsID").alias("file")) for x in (left, right)]
        tables = {"matches": found, "only_left": matching.unmatched(files[0], found, "f1"), "only_right": matching.unmatched(files[1], found, "f2"), "method_counts": matching.method_counts(found)}
    elif args.command == "update":
        pairs = spark.read.parquet(args.pairs).select(F.col("f1").alias("old"), F.col("f2").alias("new"))
        existing, converted = _documents(spark, args.existing, DOCUMENT), spark.read.parquet(args.converted)
        tables = {"created": converter.create(converted, pairs), "updated": converter.update(existing, converted, pairs), "summary": converter.summary(existing, converted, pairs)}
        if not args.no_backup:
            tables["backups"] = converter.backups(existing, pairs)
    else:
        tables = converter.sync(_documents(spark, args.packages, PACKAGE), _documents(spark, args.existing, DOCUMENT), args.methods, pages)
        for flag, name in ((args.no_backup, "backups"), (args.no_copy_source, "sources")):
            if flag:
                del tables[name]
    for name, table in tables.items():
        if args.dry_run:
            print(f"{name}: {table.count()} rows")
        else:
            table.write.mode("overwrite").parquet(f"{args.out}/{name}")
    return 0


def main() -> int:
    spark = SparkSession.builder.appName("toolgraph").getOrCreate()
    try:
        return run(spark, sys.argv[1:])
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
