"""Licence texts to SPDX identifiers: exact aliases, then family and version, then a close match."""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The SPDX ids, aliases and families that results must agree with.
SPDX = [
    "0BSD", "AFL-1.1", "AFL-1.2", "AFL-2.0", "AFL-2.1", "AFL-3.0", "AGPL-1.0-only", "AGPL-1.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later",
    "Apache-2.0", "Artistic-1.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "CC0-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0",
    "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-SA-4.0", "CDDL-1.0", "CDDL-1.1", "CECT-1.0", "CPL-1.0", "EPL-1.0", "EPL-2.0", "GPL-1.0-only", "GPL-1.0-or-later",
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later",
    "LGPL-3.0-only", "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
]
#: Keys are in cleaned form (letters, digits and hyphens), as only those can be looked up.
ALIASES = {
    "gpl": "GPL-1.0-or-later", "gpl-1": "GPL-1.0-only", "gpl-2": "GPL-2.0-only", "gpl-3": "GPL-3.0-only",
    "lgpl": "LGPL-2.0-or-later", "lgpl-2": "LGPL-2.0-only", "lgpl-3": "LGPL-3.0-only", "apache": "Apache-2.0", "apache-2": "Apache-2.0",
    "mit": "MIT", "mit-license": "MIT", "bsd-2-clause": "BSD-2-Clause", "bsd-3-clause": "BSD-3-Clause", "agpl-3": "AGPL-3.0-only",
    "cc0": "CC0-1.0", "epl": "EPL-1.0", "cpl": "CPL-1.0", "unlimited": "Unlicense",
}
# The families in the order in which they are looked for, and the ids of those whose version doesn't matter.
FAMILIES = ["gpl", "lgpl", "apache", "bsd", "mit", "artistic", "agpl", "cc0", "cc-by-nc-nd", "cc-by-nc", "cc-by-sa", "cc-by", "epl", "cpl"]
FAMILY_SPDX = {
    "apache": "Apache-2.0", "mit": "MIT", "agpl": "AGPL-3.0-only", "epl": "EPL-1.0", "cpl": "CPL-1.0", "cc0": "CC0-1.0", "cc-by": "CC-BY-4.0",
    "cc-by-nc": "CC-BY-NC-4.0", "cc-by-nc-nd": "CC-BY-NC-ND-4.0", "cc-by-sa": "CC-BY-SA-4.0",
}
CUTOFF = 0.92
# What a raw text loses, and how it says which version.
NOISE = (r"(?d)\+.*$", r"(?d)file.*$")  # within a line: (?d) counts \n only as its end
VERSION, LATER = r"[^0-9]*([0-9]+(?:\.[0-9]+)?)", r">|or[-\s]*later"


def _bare(raw: Column) -> Column:
    """Lower case without what follows ``+`` or ``file``."""
    s = F.lower(raw)
    for pattern in NOISE:
        s = F.regexp_replace(s, pattern, "")
    return F.trim(s)


def _key(folded: Column) -> Column:
    """Spaces as hyphens, marks gone."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(folded, r"[\s_]+", "-"), "[^a-z0-9-]", ""), F.lit("-")))


@F.pandas_udf(T.StringType())
def ascii_fold(s: pd.Series) -> pd.Series:
    """Accents off, compatible forms (full width, ligatures) as plain letters, all else that isn't ASCII dropped."""
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())


def cleaned(raw: Column) -> Column:
    return _key(ascii_fold(_bare(raw)))


def _lookup(key: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), key)


def by_family(raw: Column) -> Column:
    """From the first family (in fixed order) the text names, its first number, and whether later versions are allowed."""
    low = F.lower(raw)
    family = F.get(F.filter(F.array(*map(F.lit, FAMILIES)), lambda f: F.rlike(low, F.concat(F.lit(r"\b"), f, F.lit(r"\b")))), F.lit(0))
    # one pattern for the family that was found
    version = F.nullif(F.call_function("regexp_extract", low, F.concat(family, F.lit(VERSION)), F.lit(1)), F.lit(""))
    major, later = F.split(version, r"\.")[0], F.rlike(low, F.lit(LATER))
    starts = lambda n: F.startswith(version, F.lit(n))
    allowed = F.when(later, "or-later").otherwise("only")
    return (
        F.when(family == "bsd", F.when(starts("2"), "BSD-2-Clause").when(starts("3"), "BSD-3-Clause"))
        .when(family == "artistic", F.when(starts("1"), "Artistic-1.0").when(starts("2"), "Artistic-2.0"))
        .when(family == "gpl", F.concat(F.lit("GPL-"), major, F.lit(".0-"), allowed))
        .when(family == "lgpl", F.when((major == "2") & ~starts("2.1") & ~later, "LGPL-2.0-only").otherwise(F.concat(F.lit("LGPL-"), version, F.lit("-"), allowed)))
        .otherwise(_lookup(family, FAMILY_SPDX))
    )


def close_match(key: Column, spdx: list[str] | None = None, cutoff: float = CUTOFF) -> Column:
    """The most similar SPDX id, if its ratio is ``cutoff`` or more."""
    ids = {x.lower(): x for x in (SPDX if spdx is None else spdx)}

    @F.pandas_udf(T.StringType())
    def nearest(keys: pd.Series) -> pd.Series:
        near = {x: difflib.get_close_matches(x, list(ids), 1, cutoff) for x in set(keys) if x}
        return keys.map(lambda x: ids[near[x][0]] if near.get(x) else None)

    return nearest(key)


def normalise(df: DataFrame, column: str, to: str = "spdx", aliases: dict[str, str] | None = None, spdx: list[str] | None = None, cutoff: float = CUTOFF) -> DataFrame:
    """Adds the SPDX id. Each distinct text is worked out once, the close match only for those that the exact stages leave, and joined back. Extra aliases go before the fixed ones."""
    known, ids = ALIASES | (aliases or {}), SPDX if spdx is None else spdx
    raw = F.col("_raw")
    # the texts depend on their counts, or the filters below would be worked out for every row, before rows with one text are brought together
    texts = df.select(F.col(column).alias("_raw")).where(raw.isNotNull()).groupBy("_raw").agg(F.count("*").alias("_n")).select("_raw", F.when(F.col("_n") > 0, raw).alias("_text"))
    texts = texts.withColumn("_key", cleaned(F.col("_text")))
    key = F.col("_key")
    exact = F.coalesce(_lookup(key, known), F.when(F.upper(key).isin([x for x in ids if x == x.upper()]), F.upper(key)), by_family(F.col("_text")))
    texts = texts.withColumn("_exact", exact)
    found = texts.where("_exact is not null or _key = ''").select("_raw", F.col("_exact").alias("_found"))
    rest = texts.where("_exact is null and _key <> ''").select("_raw", close_match(key, spdx, cutoff).alias("_found"))
    return df.join(found.unionByName(rest), F.col(column) == raw, "left").withColumn(to, F.col("_found")).drop("_raw", "_found")
