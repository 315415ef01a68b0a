"""Centroid clustering, robust outliers and whitening against brute force, on nulls, ties, repeats, empty tables and extra columns."""

import hashlib
import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from toolgraph.llm import centroids, outliers, queries, whitening

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, x string, cluster int, n long"


def vector_rows(n=300, dims=64, seed=1):
    r = np.random.default_rng(seed)
    mix = r.normal(size=(dims, dims)) * np.geomspace(1, 0.05, dims)
    m = (r.normal(size=(n, dims)) @ mix * 0.2).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(m)]
    rows += [rows[3], rows[3], (900, rows[3][1]), (None, rows[5][1]), (901, None), (902, []), (903, rows[4][1][:-1]), (904, [*rows[4][1][:-1], None]), (905, [*rows[4][1][:-1], float("nan")]), (906, [*rows[4][1][:-1], float("-inf")])]
    return [(*row, "x", 7, 1) for row in rows]


def sound(rows, dims=64):
    return [(i, np.floor(np.array(v, np.float64) * 256).astype(np.int64)) for i, v, *_ in rows if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]


def plain_lloyd(rows, k, rounds):
    kept = sound(rows)
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1].tolist()))
    c = [v.tolist() for _, v in first[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v.tolist(), m, strict=True)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        of = {}
        for _, v in kept:
            of.setdefault(nearest(v)[1], []).append(v.tolist())
        for j, vs in of.items():
            c[j] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    out = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in out:
        inertia[j] += d
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, d, j in out), key=repr)


@pytest.mark.parametrize("k", [1, 12, 1000])
def test_lloyd_is_the_plain_one(spark, k):
    rows = vector_rows(120)
    table = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = sorted(map(tuple, centroids.clustered(table, k=k, rounds=3).collect()), key=repr)
    assert got == plain_lloyd(rows, k, 3) and len(got) == 124


def test_lloyd_edges(spark):
    assert centroids.clustered(spark.createDataFrame([], VECTORS)).collect() == []
    same = spark.createDataFrame([(i, [0.5] * 64, "x", 1, 1) for i in range(50)], VECTORS)
    assert {(r.cluster, r.distance, r.inertia) for r in centroids.clustered(same).collect()} == {(0, 0, 0)}  # the lowest of equal centroids; the others stay empty
    with pytest.raises(Exception, match="don't fit a long"):
        centroids.clustered(spark.createDataFrame([(1, [1e9] * 64, "x", 1, 1)], VECTORS)).collect()


def test_clustering_matches_sql(spark):
    c = duckdb.connect()
    c.sql(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = c.sql(queries.ORACLE_SQL["op11_centroid_clustering"]).df()
    got = queries.op11_centroid_clustering(spark, SF).toPandas()
    key = lambda f: sorted(map(tuple, f[sorted(want.columns)].itertuples(index=False)))
    assert key(got) == key(want)


def plain_whitening(rows, k):
    kept = sound(rows)
    fit = np.array(sorted({tuple(v.tolist()) for _, v in kept}), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    centred = (fit * n - s).astype(float) / n
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    rows = [(i, sum(int(d) ** 2 for d in v.astype(object) * n - s), ((v.astype(object) * n - s).astype(float) / n) @ (u / np.sqrt(e))) for i, v in kept]
    return n, e / np.trace(cov), rows


def test_whitening_is_the_dense_one(spark):
    rows = vector_rows(400)
    got = whitening.whitened(spark.createDataFrame(rows, VECTORS).repartition(5)).collect()
    n, shares, want = plain_whitening(rows, 4)
    assert len(got) == 4 * len(want) and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    for c in range(4):
        mine = sorted(((r.vec_id, int(r.deviation), r.whitened) for r in got if r.component == c + 1), key=repr)
        theirs = sorted(((i, d, w[c]) for i, d, w in want), key=repr)
        assert [x[:2] for x in mine] == [x[:2] for x in theirs]
        sign = np.sign(mine[0][2] * theirs[0][2])
        assert np.allclose([x[2] for x in mine], [sign * x[2] for x in theirs], atol=1e-9)
        assert [r.explained for r in got if r.component == c + 1] == pytest.approx([shares[c]] * len(want), rel=1e-10)


def test_whitening_edges(spark):
    assert whitening.whitened(spark.createDataFrame([], VECTORS)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(i, [0.5] * 64, "x", 1, 1) for i in range(9)], VECTORS)).collect() == []  # no variance
    three = [(i, [0.25 * (i == j) for j in range(64)], "x", 1, 1) for i in range(3)]  # two dimensions at most
    assert {r.component for r in whitening.whitened(spark.createDataFrame(three, VECTORS)).collect()} == {1, 2}
    far = [(i, [float(2**40 * (i == j)) for j in range(64)], "x", 1, 1) for i in range(3)]  # beyond 63 bits
    got = whitening.whitened(spark.createDataFrame(far, VECTORS)).collect()
    assert {int(r.deviation) for r in got} == {6 * 2**96}


@pytest.mark.parametrize("dims,rank,block,basis", [(64, 64, 8, 128), (200, 200, 4, 24), (200, 9, 8, 40), (30, 30, 3, 12), (5, 5, 8, 128)])
def test_block_lanczos_restarts_and_breakdowns(dims, rank, block, basis):
    r = np.random.default_rng(dims + rank)
    q = np.linalg.qr(r.normal(size=(dims, dims)))[0]
    e = np.concatenate([np.geomspace(1, 1e-4, rank), np.zeros(dims - rank)])
    e[1:3] = e[1]  # equal ones
    v, passes = (q * e) @ q.T, []
    got, u, residual = whitening.block_lanczos(lambda b: passes.append(b.shape[1]) or v @ b, dims, 4, block=block, basis=basis)
    assert np.allclose(got, np.sort(e)[::-1][:4], rtol=1e-10)
    assert np.abs(u.T @ u - np.eye(4)).max() < 1e-12 and np.abs(v @ u - u * got).max() < 1e-12
    assert sum(passes) <= 20 * dims


SPACES = r"[^\x20\x09-\x0D]+"


def plain_counts(text):
    t = text or ""
    w = re.findall(SPACES, t)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(SPACES, line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


def plain_kept(rows):
    """The estimate without Spark: rows of (id, pool, features)."""
    out = {}
    by = {}
    for i, pool, x in rows:
        by.setdefault(pool, []).append((i, np.array(x)))
    for members in by.values():
        x = np.array([v for _, v in members])
        lower = lambda a: np.sort(a, axis=0)[(len(a) - 1) // 2]
        mid = lower(x)
        scale = np.maximum(lower(np.abs(x - mid)) * 1.4826, np.array(outliers.FLOOR) * outliers.UNIT)
        z = (x - mid) / scale
        t, s = np.tanh(z), z / np.sqrt((z**2).sum(axis=1, keepdims=True) + 1e-9)
        whole = lambda a: np.rint(4096 * a[:, :, None] * a[:, None, :]).sum(axis=0)
        a, b = whole(t), whole(s)
        d = np.sqrt(np.maximum(np.diag(a), 1e-9))
        a = a / np.outer(d, d)
        np.fill_diagonal(a, 1.0)
        ridged = lambda m: (1 - outliers.RIDGE) * m + outliers.RIDGE * np.eye(outliers.P)
        distance = lambda mean, k: np.einsum("ij,jk,ik->i", z - mean, np.linalg.inv(k), z - mean)
        best = None
        for start in (a, b * outliers.P / max(np.trace(b), 1e-9), np.eye(outliers.P)):
            mean, k, old = np.zeros(outliers.P), ridged(start), None
            while True:
                piece = np.floor(np.log2(distance(mean, k) + 2.0**-20) * outliers.SLICES)
                chosen = piece <= np.sort(piece)[math.ceil(len(z) * outliers.SHARE) - 1]
                new = z[chosen].mean(axis=0), ridged(np.cov(z[chosen].T, bias=True) * outliers.consistency(outliers.SHARE))
                value = np.linalg.slogdet(new[1])[1]
                if old is None or value < old:
                    mean, k = new
                if old is not None and value > old - outliers.GAIN:
                    break
                old = value
            if best is None or np.linalg.slogdet(k)[1] < best[0] - 1e-12:
                best = np.linalg.slogdet(k)[1], mean, k
        chosen = distance(*best[1:]) <= outliers.chi2_quantile(outliers.REWEIGHT, outliers.P)
        mean, k = z[chosen].mean(axis=0), ridged(np.cov(z[chosen].T, bias=True) * outliers.consistency(outliers.REWEIGHT))
        for (i, _), v in zip(members, distance(mean, k), strict=True):
            out[i] = v
    return out


def test_counts_are_the_plain_ones(spark):
    r = np.random.default_rng(5)
    vocabulary = ["a", "b", "Öl", "c#", "|", "d<>", "E!!"]
    texts = ["".join(str(r.choice(vocabulary)) + str(r.choice([" ", " ", "\n", "\t ", "\n\n", "\r\n", "\x0b"])) for _ in range(int(r.integers(1, 90)))) for _ in range(60)]
    texts += [None, "", " \n ", "x", "\n".join(["one two three"] * 9), "one\none \none", ("a b c d e f g h " * 2).strip(), "w " * 50_000, "A a " * 30, "x" * 1000]
    docs = spark.createDataFrame([(i, t, None, "s", 1, True) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_words long, kept boolean").repartition(3)
    got = {row.doc_id: row for row in outliers.judged(docs).collect()}
    for i, t in enumerate(texts):
        row, want = got[i], plain_counts(t)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want, (i, t)
        assert row.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (row.base_failed and row.kept)


def test_outliers_are_those_of_the_plain_estimate(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").unionByName(docs.withColumn("doc_id", F.col("doc_id") + 10**6))
    rows = rows.withColumn("source", F.expr("case when lang = 'en' then concat('src', doc_id % 5) else source end"))
    got = outliers.judged(rows).collect()
    assert len(got) == rows.count()
    want = plain_kept([((r.doc_id, r.source, r.lang), r.pool, [r[f] for f in outliers.FEATURES]) for r in got if not r.base_failed])
    cut = outliers.chi2_quantile(outliers.CUT, outliers.P)
    assert len({r.pool for r in got}) > 3 and any(len(r.pool) > 10 for r in got)
    for r in got:
        if not r.base_failed:
            assert r.distance == pytest.approx(want[r.doc_id, r.source, r.lang], rel=1e-6, abs=1e-9)
            assert r.kept == (r.distance <= cut)


def test_outliers_leave_clean_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = outliers.judged(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed")
    n = {(r.quality, r.kept): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.995
    assert n[0, False] / (n[0, False] + n.get((0, True), 0)) > 0.95


def test_outlier_edges(spark):
    schema = "doc_id long, text string, lang string, source string, distance double, w long"
    assert outliers.judged(spark.createDataFrame([], schema)).collect() == []
    same = " ".join(f"word{i}" for i in range(30))
    rows = [(i, same, "en", "s", 0.0, 1) for i in range(80)] + [(5, same, "en", "s", 0.0, 1), (None, same, None, None, 0.0, 1), (200, "# $ % & " * 2 + same.replace("word", "#"), "en", "s", 0.0, 1)]
    got = outliers.judged(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows) and [r.doc_id for r in got if not r.kept] == [200]
    assert outliers.chi2_quantile(0.95, 6) == pytest.approx(12.5916, abs=1e-3) and outliers.chi2_quantile(0.9999, 6) == pytest.approx(27.856, abs=1e-2)
