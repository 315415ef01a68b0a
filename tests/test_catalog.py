"""Every registered query against its SQL under DuckDB, on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

from toolgraph.plans import catalog, documents, files  # noqa: F401  they register their queries beside those of catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages labels".split()


def plain(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    return f"{v:.6g}" if isinstance(v, float) else str(pd.Timestamp(v)) if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_matches_sql(spark, db, name):
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), db.sql(catalog.ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda f: sorted((tuple(map(plain, r)) for r in f[columns].itertuples(index=False)), key=repr)
    assert rows(got) == rows(want)


def test_greedy_match_is_the_ordered_assignment(spark):
    pairs = catalog.identity_edges(catalog.Tables(spark, SF)).select("f1", "f2").distinct().collect()
    taken, want = set(), {}
    for f1 in sorted({p.f1 for p in pairs}):
        free = sorted(p.f2 for p in pairs if p.f1 == f1 and p.f2 not in taken)
        if free:
            want[f1] = free[0]
            taken.add(free[0])
    got = {r.f1: r.f2 for r in catalog.QUERIES["greedy_match"](spark, SF).collect()}
    assert got == want
