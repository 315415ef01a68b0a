"""Author fields of package descriptions: ``Name [roles] (<https://orcid.org/...>), ...`` to credits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERSON_ROLES, FUNDER = ("aut", "cre", "ctb"), "fnd"


def credits(author: Column) -> Column:
    """array<struct<name, typeEntity, orcidid, typeRole>>: entries parted by commas outside brackets; those without a name are dropped."""
    entries = F.split(author, r",(?![^\[]*\])")

    def credit(e: Column) -> Column:
        inside = F.regexp_extract_all(e, F.lit(r"\[([^\]]*)\]"), F.lit(1))
        roles = F.transform(F.flatten(F.transform(inside, lambda x: F.split(x, ","))), lambda r: F.trim(r))
        has = lambda r: F.array_contains(roles, r)
        orcid = F.regexp_extract(e, r"\(<(https://orcid\.org/\d{4}-\d{4}-\d{4}-\d{3}[\dX])>\)", 1)
        kind = F.when(has("aut") | has("cre") | has("ctb"), "Person").when(has(FUNDER), "Funding agency")
        role = F.array_compact(F.array(F.when(has("ctb") | has(FUNDER), "Contributor"), F.when(has("aut"), "Developer"), F.when(has("cre"), "Maintainer")))
        name = F.trim(F.regexp_extract(F.trim(e), r"^([^\[(<]+)", 1))
        return F.struct(name.alias("name"), kind.alias("typeEntity"), F.nullif(orcid, F.lit("")).alias("orcidid"), F.when(F.size(role) > 0, role).alias("typeRole"))

    return F.filter(F.transform(entries, credit), lambda c: c["name"] != "")
