"""Quality rules: plain counts with fixed limits, and robust multivariate outliers among the texts that pass them.

``statistics`` counts words, code points in words, symbols, capitals, other punctuation, lines, lines that equal an earlier one and words in repeated 8-word windows over whole texts. A text fails the base rule if it has fewer than 20
words or over 30 % of its words in repeated windows. For the others six statistics are transformed (log of the mean word length, arcsine of the root of five shares) and kept as integers of 1/256. The texts of one
language and source are a pool, and each pool has a minimum-covariance-determinant estimate of location and scatter; a text is rejected if its Mahalanobis distance squared is beyond the ``CUT`` quantile of chi-square.

The estimate: medians and median absolute deviations scale each dimension; three starting scatters (of hyperbolic tangents, of spatial signs, of the scaled vectors themselves, as in deterministic MCD) are improved by concentration steps: of each
pool the ``SHARE`` of texts with the least distance gives the next mean and scatter, until a step lowers the log determinant by less than ``GAIN`` (then the lower one stays), each pool and start on its own. The start with the least determinant wins, and one
reweighting step follows. The scatter gets
a share ``RIDGE`` of the scaled identity, so dimensions that are constant within a pool don't make it singular. The order statistic is taken to 1/64 of an octave of the distance: all texts in the last slice count.

Pools of fewer than ``LEAST`` texts are too small for an estimate: they are judged together with the other small ones of their language, and if these are too few too, with all such.

Every step is one aggregation over distinct vectors with their counts: a step sends a row for each (pool, start, slice of distance), at most a few thousand a pool however large the pool, and all sums are exact integers, so no result depends on how rows
are dealt or on a task being run again. No pool is ever gathered in one task; parameters are joined as a table (broadcast by Spark below its size limit, else skew-split by AQE).

Edge cases: null and empty texts have no words: base_failed. Null lang and source count as empty ones. Repeated rows count and come out each; ties in distance are all in or all out. An empty table gives an empty one.
Windows and lines are compared by 64-bit hashes within one text. Sums fit longs up to 5e11 texts a pool. Other columns of any name are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, byte_chunks, lean, materialise, mix64, padded, span_hashes

WINDOW, MIN_WORDS, MAX_REPEATED = 8, 20, 30
UNIT, SHARE, RIDGE, LEAST, GAIN, SLICES, CUT, REWEIGHT = 256, 0.75, 0.5, 50, 1e-3, 64, 0.9999, 0.975
COUNTS = ["n_words", "word_chars", "n_symbols", "n_capitals", "n_marks", "n_lines", "n_dup_lines", "n_repeat_words"]
FEATURES = ["word_length", "symbols", "capitals", "marks", "dup_lines", "repeat_words"]
#: The least scale of each dimension. The base rule judges repeats, so here they only add to the other dimensions.
FLOOR = [0.1, 0.1, 0.1, 0.1, 0.4, 0.4]
P = len(FEATURES)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def _bytes(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table


SYMBOL = _bytes("#*$%&|<>")
CAPITAL = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
MARK = _bytes("!\"'()+,-./:;=?@[\\]^_`{}~")


def repeats(group: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of items with a group and a hash: which equal an earlier one of their group, and which equal any other."""
    order = np.lexsort((h, group))
    same = (group[order][1:] == group[order][:-1]) & (h[order][1:] == h[order][:-1])
    later, any_other = np.zeros(len(h), bool), np.zeros(len(h), bool)
    later[order[1:][same]] = True
    any_other[order[1:][same]] = any_other[order[:-1][same]] = True
    return later, any_other


def text_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """COUNTS of each text."""
    n = len(offsets) - 1
    buf, starts = padded(data, offsets, 1, 32)
    ends = starts + np.diff(offsets)

    def totals(mask):
        c = np.concatenate([[0], np.cumsum(mask)])
        return c[ends] - c[starts]

    inside, spans = ~SPACE[buf], span_hashes(buf)
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begin, end = edge[0::2], edge[1::2]
    text = np.searchsorted(starts, begin, "right") - 1
    out = np.zeros((n, len(COUNTS)), np.int64)
    out[:, 0] = np.bincount(text, minlength=n)
    out[:, 1] = totals(inside & ((buf & 0xC0) != 0x80))
    out[:, 2], out[:, 3], out[:, 4] = totals(SYMBOL[buf]), totals(CAPITAL[buf]), totals(MARK[buf])
    breaks = np.flatnonzero(buf == 10)
    first, last = np.sort(np.concatenate([starts, breaks + 1])), np.sort(np.concatenate([ends, breaks]))
    words = np.concatenate([[0], np.cumsum(inside)])
    full = words[last] > words[first]
    first, last = first[full], last[full]
    line_text = np.searchsorted(starts, first, "right") - 1
    out[:, 5] = np.bincount(line_text, minlength=n)
    out[:, 6] = np.bincount(line_text[repeats(line_text, spans(first, last))[0]], minlength=n)
    if len(begin) >= WINDOW:
        h, m = spans(begin, end), len(begin) - WINDOW + 1
        window = np.zeros(m, np.uint64)
        for i in range(WINDOW):
            window = mix64(window + h[i : i + m] + np.uint64(i + 1))
        whole = np.flatnonzero(text[:m] == text[WINDOW - 1 :])
        at = whole[repeats(text[whole], window[whole])[1]]
        steps = np.zeros(len(begin) + 1, np.int64)
        np.add.at(steps, at, 1)
        np.add.at(steps, at + WINDOW, -1)
        out[:, 7] = np.bincount(text[np.cumsum(steps[:-1]) > 0], minlength=n)
    return out


@lean
def count_rows(batches):
    for batch in batches:
        parts = [text_counts(data, offsets) for _, _, data, offsets in byte_chunks(batch.column("text"))]
        counts = np.concatenate(parts) if parts else np.zeros((0, len(COUNTS)), np.int64)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "lang", "source")), *(pa.array(counts[:, i]) for i in range(len(COUNTS)))], ["doc_id", "lang", "source", *COUNTS])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, COUNTS, base_failed and FEATURES (integers of 1/UNIT) of each row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), "text")
    counted = rows.mapInArrow(count_rows, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS))
    share = lambda a, b: F.asin(F.sqrt(F.least(F.lit(1.0), F.col(a) / F.greatest(F.lit(1), F.col(b)))))
    length = F.log(F.greatest(F.lit(1), F.col("word_chars")) / F.greatest(F.lit(1), F.col("n_words")))
    features = [length, share("n_symbols", "n_words"), share("n_capitals", "word_chars"), share("n_marks", "n_words"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")]
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return counted.select("*", failed.alias("base_failed"), *(F.round(f * UNIT).cast("int").alias(name) for f, name in zip(features, FEATURES, strict=True)))


def pools(rows: DataFrame) -> DataFrame:
    """lang, source and the pool that their texts belong to."""
    sizes = rows.groupBy("lang", "source").agg(F.count_if(~F.col("base_failed")).alias("n"))
    small = sizes.where(F.col("n") < LEAST).groupBy("lang").agg(F.sum("n").alias("others"))
    level = F.when(F.col("n") >= LEAST, F.to_json(F.array("lang", "source"))).when(F.col("others") >= LEAST, F.to_json(F.array("lang"))).otherwise("[]")
    return sizes.join(small, "lang", "left").select("lang", "source", level.alias("pool"))


def chi2_below(x: float, p: int) -> float:
    """The distribution function of chi-square with an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, p // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(q: float, p: int) -> float:
    low, high = 0.0, 1e3
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_below(mid, p) < q else (low, mid)
    return (low + high) / 2


def consistency(share: float) -> float:
    """What the scatter of the inner share of a normal distribution is too small by."""
    return share / chi2_below(chi2_quantile(share, P), P + 2)


def scales(weighted: DataFrame) -> DataFrame:
    """pool, middle and scale: of each dimension the lower median and the lower median deviation times 1.4826, FLOOR at least, by counts of values (a few thousand a dimension at most)."""
    values = weighted.select("pool", "w", F.posexplode(F.array(*FEATURES)).alias("dim", "v")).groupBy("pool", "dim", "v").agg(F.sum("w").alias("w"))

    def middle(table, by):
        window = Window.partitionBy("pool", "dim").orderBy(by)
        summed = table.groupBy("pool", "dim", by).agg(F.sum("w").alias("w")).withColumn("upto", F.sum("w").over(window)).withColumn("all", F.sum("w").over(Window.partitionBy("pool", "dim")))
        return summed.where("2 * upto >= all and 2 * (upto - w) < all").select("pool", "dim", F.col(by).alias("mid"))

    medians = middle(values, "v")
    spread = middle(values.join(medians, ["pool", "dim"]).withColumn("off", F.abs(F.col("v") - F.col("mid"))), "off").withColumnRenamed("mid", "mad")
    scale = F.greatest(F.col("mad") * 1.4826, F.element_at(F.array(*(F.lit(f * UNIT) for f in FLOOR)), F.col("dim") + 1))
    at = medians.join(spread, ["pool", "dim"]).select("pool", "dim", "mid", scale.alias("scale"))
    of = lambda c: F.array(*(F.max(F.when(F.col("dim") == i, F.col(c))) for i in range(P)))
    return at.groupBy("pool").agg(of("mid").alias("middle"), of("scale").alias("scale"))


def _scaled(i: int):
    return F.col(f"u{i}") / F.col("scale")[i]


def _distance():
    """Squared Mahalanobis distance from the columns u, scale, mean and precision."""
    z = [_scaled(i) - F.col("mean")[i] for i in range(P)]
    return sum((z[i] * z[j] * F.col("precision")[k] * (1 if i == j else 2) for k, (i, j) in enumerate(PAIRS)), F.lit(0.0))


SUMS = ["n", *(f"s{i}" for i in range(P)), *(f"s{i}_{j}" for i, j in PAIRS)]


def _sums():
    w = F.col("w")
    return [F.sum(w).alias("n"), *(F.sum(w * F.col(f"u{i}")).alias(f"s{i}") for i in range(P)), *(F.sum(w * F.col(f"u{i}") * F.col(f"u{j}")).alias(f"s{i}_{j}") for i, j in PAIRS)]


def _symmetric(values) -> np.ndarray:
    m = np.zeros((P, P))
    for (i, j), v in zip(PAIRS, values, strict=True):
        m[i, j] = m[j, i] = v
    return m


def _shape(scatter: np.ndarray) -> tuple[list[float], float]:
    """The precision, as PAIRS, and the log determinant of a scatter with its ridge."""
    ridged = (1 - RIDGE) * scatter + RIDGE * np.eye(P)
    inverse = np.linalg.inv(ridged)
    return [float(inverse[i, j]) for i, j in PAIRS], float(np.linalg.slogdet(ridged)[1])


PARAMETERS = "pool string, start int, scale array<double>, mean array<double>, precision array<double>, logdet double, turn int, settled boolean"


COLUMNS = [c.split(" ")[0] for c in PARAMETERS.split(", ")]


def start_frames(frames):
    """The starting scatters of each pool: from its sums of tangents, of signs, and none (the identity)."""
    for frame in frames:
        rows = []
        for r in frame.itertuples(index=False):
            for start, sums in enumerate((r.tangents, r.signs, None)):
                m = np.eye(P)
                if sums is not None:
                    m = _symmetric(np.asarray(sums, float))
                    if start == 0:  # correlations
                        d = np.sqrt(np.maximum(np.diag(m), 1e-9))
                        m = m / np.outer(d, d)
                        np.fill_diagonal(m, 1.0)
                    else:
                        m = m * P / max(np.trace(m), 1e-9)
                rows.append((r.pool, start, list(r.scale), [0.0] * P, *_shape(m), 0, False))
        yield pd.DataFrame(rows, columns=COLUMNS)


def step_frames(frames, factor):
    """Mean, precision and determinant from the sums over the texts chosen; the ones before, if they were as good."""
    for frame in frames:
        rows = []
        for r in frame.itertuples(index=False):
            sums, scale = [int(v) for v in r.new], np.asarray(r.scale, float)
            n = sums[0]
            # n * n * covariance, in integers
            pairs = [n * sums[1 + P + k] - sums[1 + i] * sums[1 + j] for k, (i, j) in enumerate(PAIRS)]
            precision, logdet = _shape(_symmetric([v / (n * n) for v in pairs]) * factor / np.outer(scale, scale))
            mean, settled = [float(s / n / c) for s, c in zip(sums[1 : 1 + P], scale, strict=True)], r.turn > 0 and logdet > r.logdet - GAIN
            if settled and logdet >= r.logdet:
                mean, precision, logdet = list(r.mean), list(r.precision), r.logdet
            rows.append((r.pool, r.start, list(scale), mean, precision, logdet, r.turn + 1, settled))
        yield pd.DataFrame(rows, columns=COLUMNS)


def concentrated(weighted: DataFrame, parameters: DataFrame) -> DataFrame:
    """One concentration step of every pool and start."""
    judged = weighted.join(parameters.select("pool", "start", "scale", "mean", "precision"), "pool")
    sliced = judged.withColumn("slice", F.floor(F.log2(_distance() + 2.0**-20) * SLICES).cast("int")).groupBy("pool", "start", "slice").agg(*_sums())
    upto = Window.partitionBy("pool", "start").orderBy("slice")
    summed = sliced.select("pool", "start", "n", *(F.sum(c).over(upto).alias(f"all_{c}") for c in SUMS), F.ceil(F.sum("n").over(Window.partitionBy("pool", "start")) * SHARE).alias("h"))
    cut = summed.where("all_n >= h and all_n - n < h").select("pool", "start", F.array(*(f"all_{c}" for c in SUMS)).alias("new"))
    factor = consistency(SHARE)
    return cut.join(parameters, ["pool", "start"]).mapInPandas(lambda it: step_frames(it, factor), PARAMETERS)


def reweighted(weighted: DataFrame, parameters: DataFrame) -> DataFrame:
    """Mean and precision over all texts within the REWEIGHT quantile of chi-square."""
    judged = weighted.join(parameters.select("pool", "start", "scale", "mean", "precision"), "pool").where(_distance() <= chi2_quantile(REWEIGHT, P))
    new = judged.groupBy("pool", "start").agg(*_sums()).select("pool", "start", F.array(*SUMS).alias("new"))
    factor = consistency(REWEIGHT)
    return new.join(parameters.withColumn("turn", F.lit(-1)), ["pool", "start"]).mapInPandas(lambda it: step_frames(it, factor), PARAMETERS)


def estimates(weighted: DataFrame, middles: DataFrame) -> DataFrame:
    """pool, scale, mean and precision by minimum covariance determinant; weighted: pool, u0.. (a vector less its pool's medians) and w (how many texts have it)."""
    scaled = weighted.join(middles.select("pool", "scale"), "pool")
    norm = F.sqrt(sum((_scaled(i) ** 2 for i in range(P)), F.lit(1e-9)))
    whole = lambda x, y: F.sum(F.col("w") * F.round(4096 * x * y).cast("long"))  # noqa: E731  integers, so that the order of adding doesn't count
    made = [F.array(*(whole(f(i), f(j)) for i, j in PAIRS)).alias(name) for name, f in (("tangents", lambda i: F.tanh(_scaled(i))), ("signs", lambda i: _scaled(i) / norm))]
    moving = materialise(scaled.groupBy("pool").agg(F.first("scale").alias("scale"), *made).mapInPandas(start_frames, PARAMETERS), "mcd-start")
    ended = []
    while not moving.isEmpty():
        step = materialise(concentrated(weighted, moving), "mcd-step")
        ended.append(step.where("settled"))
        moving = step.where("not settled")
    every = reduce(DataFrame.unionByName, [*ended, moving])
    best = every.groupBy("pool").agg(F.min_by(F.struct("start", "scale", "mean", "precision", "logdet"), F.struct("logdet", "start")).alias("best")).select("pool", "best.*")
    return materialise(reweighted(weighted, best), "mcd").select("pool", "scale", "mean", "precision")


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, COUNTS, base_failed, FEATURES, pool, distance (squared; null if base_failed) and kept of each row."""
    rows = materialise(statistics(docs), "statistics")
    of = materialise(pools(rows), "pools")
    vectors = materialise(rows.where("not base_failed").join(of, ["lang", "source"]).groupBy("pool", *FEATURES).agg(F.count("*").alias("w")), "vectors")
    middles = materialise(scales(vectors), "middles")
    off = [(F.col(f) - F.col("middle")[i]).alias(f"u{i}") for i, f in enumerate(FEATURES)]
    weighted = materialise(vectors.join(middles, "pool").select("pool", "w", *off), "weighted")
    final = materialise(estimates(weighted, middles).join(middles.select("pool", "middle"), "pool"), "estimates")
    known = rows.join(of, ["lang", "source"]).join(final, "pool", "left").select("*", *off)
    distance = F.when(~F.col("base_failed"), _distance())
    kept = F.coalesce(distance <= chi2_quantile(CUT, P), F.lit(False))
    return known.select("doc_id", "lang", "source", *COUNTS, "base_failed", *FEATURES, "pool", distance.alias("distance"), kept.alias("kept"))
