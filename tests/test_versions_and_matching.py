"""Package version order against a plain comparison, and one-to-one matching against the ordered loop, on chains, hot values and small blocks."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from toolgraph.functions import text
from toolgraph.operators import components, matching, storage


def marks(c):
    return -1 if c == "~" else 0 if c == "" else ord(c) if c.isalpha() else ord(c) + 256


def compare_parts(a, b):
    while a or b:
        x, y = re.match("[^0-9]*", a)[0], re.match("[^0-9]*", b)[0]
        a, b = a[len(x) :], b[len(y) :]
        for i in range(max(len(x), len(y))):
            p, q = marks(x[i : i + 1]), marks(y[i : i + 1])
            if p != q:
                return p - q
        x, y = re.match("[0-9]*", a)[0], re.match("[0-9]*", b)[0]
        a, b = a[len(x) :], b[len(y) :]
        if int(x or 0) != int(y or 0):
            return int(x or 0) - int(y or 0)
    return 0


def compare(a, b):
    def parts(v):
        epoch, _, rest = v.rpartition(":") if ":" not in v else (v.split(":", 1)[0], ":", v.split(":", 1)[1])
        upstream, hyphen, revision = rest.rpartition("-")
        return int(epoch or 0), upstream if hyphen else rest, revision if hyphen else ""

    x, y = parts(a), parts(b)
    return x[0] - y[0] or compare_parts(x[1], y[1]) or compare_parts(x[2], y[2])


def test_versions_compare_as_packages_do(spark):
    rng = random.Random(1)
    pieces = ["0", "1", "10", "01", "a", "rc", "~", "+", "dfsg", ".", "-", "-1", "+b1", "~~", "A", "z"]
    versions = sorted({rng.choice(["", "", "1:", "0:", "12:"]) + "".join(rng.choice(pieces) for _ in range(rng.randint(1, 5))) for _ in range(400)} | {"1.0", "1.0-1", "1.0+dfsg-1", "1.0-0", "1.0~", "1.0-1~"})
    keys = {r.v: r.k for r in spark.createDataFrame([(v,) for v in versions], "v string").select("v", text.debian_sort_key(F.col("v")).alias("k")).collect()}

    @settings(max_examples=3000, deadline=None)
    @given(st.sampled_from(versions), st.sampled_from(versions))
    def holds(a, b):
        c = compare(a, b)
        assert (keys[a] < keys[b], keys[a] == keys[b]) == (c < 0, c == 0), (a, b)

    holds()
    assert keys["1.0+dfsg-1"] > keys["1.0-1"]


def loop(left, right):
    out, taken = {}, set()
    for f1 in sorted({f for f, _, _ in left if f is not None}):
        values = {(m, v) for f, m, v in left if f == f1 and v is not None}
        free = sorted({f for f, m, v in right if f is not None and (m, v) in values and f not in taken})
        if free:
            out[f1] = free[0]
            taken.add(free[0])
    return out


def table(spark, rows, kind="long"):
    return spark.createDataFrame(rows, f"file {kind}, method string, value string")


def chain(n):
    left = [(i, "m", f"v{i}") for i in range(n)] + [(i, "m", f"v{i + 1}") for i in range(n)]
    return left, [(i, "m", f"v{i}") for i in range(n + 1)]


@pytest.mark.parametrize("block", [40, 300, 10**6])
def test_matching_is_the_ordered_loop(spark, block):
    rng = random.Random(block)
    value = lambda: f"v{int(rng.paretovariate(0.6))}"  # noqa: E731  few values are very common
    left = [(rng.randint(0, 150), rng.choice("ab"), value()) for _ in range(300)] + [(None, "a", "v1"), (7, "a", None), (7, "a", "v1"), (7, "a", "v1")]
    right = [(rng.randint(0, 150), rng.choice("ab"), value()) for _ in range(300)] + [(None, "a", "v1"), (3, "b", None)]
    got = matching.assign(table(spark, left), table(spark, right), block).collect()
    assert {r.f1: r.f2 for r in got} == loop(left, right) and len(got) == len(loop(left, right))
    texts = lambda rows: [(None if f is None else f"é{f}", m, v) for f, m, v in rows]
    got = matching.assign(table(spark, texts(left), "string"), table(spark, texts(right), "string"), block).collect()
    assert {r.f1: r.f2 for r in got} == loop(texts(left), texts(right))


def test_small_components_are_solved_side_by_side(spark):
    left, right = [], []
    for g in range(60):
        a, b = chain(g % 7 + 1)
        left += [(1000 * g + f, m, f"{g}{v}") for f, m, v in a]
        right += [(1000 * g + f, m, f"{g}{v}") for f, m, v in b]
    got = matching.assign(table(spark, left), table(spark, right), 50).collect()
    assert {r.f1: r.f2 for r in got} == loop(left, right)


def test_matching_without_files(spark):
    none = table(spark, [])
    assert matching.assign(none, table(spark, [(1, "m", "v")])).collect() == [] and matching.assign(none, none, 0).collect() == []
    assert matching.assign(table(spark, [(1, "m", "v")]), table(spark, [(1, "m", "w")]), 0).collect() == []


def test_chains_take_few_rounds(spark, monkeypatch):
    counts = {}

    def counted(df, path):
        counts[now] = counts.get(now, 0) + 1
        return storage.stored(df, path)

    monkeypatch.setattr(matching, "stored", counted)
    monkeypatch.setattr(components, "stored", counted)
    for now in (60, 1000):
        # many files beside the chain, so that the whole is beyond a block and the chain isn't
        left, right = chain(now)
        left += [(10**6 + i, "m", f"alone{i}") for i in range(3 * now)]
        right += [(10**6 + i, "m", f"alone{i}") for i in range(3 * now)]
        got = {r.f1: r.f2 for r in matching.assign(table(spark, left), table(spark, right), 4 * now).collect()}
        assert got == loop(left, right)
    assert counts[1000] <= counts[60] + 10 and counts[1000] <= 22, counts


def test_components_of_paths_stars_and_nothing(spark, tmp_path):
    path = [(i, i + 1) for i in range(200)]
    star = [(10**4, 10**4 + i) for i in range(1, 100)]
    rows = [*path, *star, (5, 5), (None, 3), (2, 1), (2, 1), (7 * 10**4, 7 * 10**4 + 1)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(rows, "u long, v long"), str(tmp_path / "a")).collect()}
    assert got == {i: 0 for i in range(201)} | {10**4 + i: 10**4 for i in range(100)} | {7 * 10**4: 7 * 10**4, 7 * 10**4 + 1: 7 * 10**4}
    assert components.components(spark.createDataFrame([], "u long, v long"), str(tmp_path / "b")).collect() == []
