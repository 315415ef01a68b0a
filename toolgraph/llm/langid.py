"""Language identification as a mixture of languages, fitted to each document by expectation-maximisation.

Learnt: for each language the counts of byte trigrams (A-Z lowered, other ASCII a space, texts framed by spaces). With 155 symbols left there are 3.7 million
trigrams at most, whatever the corpus, and the broadcast table has an entry of six bytes for each pair of a language and a trigram that its training texts have, so no two share a count and a language costs what it uses; all others have
the language's smoothing. A document's trigrams are drawn from a mixture of the languages; EM estimates the proportions. The language set is then chosen: the k languages of the largest proportions, for the k whose own fit has the greatest log-likelihood
less ``PENALTY * log(trigrams)`` for each language (a proportion under ``LEAST`` never enters). Predicted is the set's largest proportion, which is the score.

Edge cases: a null text, or one without a letter, is ``und`` with score 0, and so is every text if no language was learnt; equal proportions go to the language first in
order; repeated rows are judged each; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Counts, byte_chunks, crc_mod, lean, padded, rows_where

SMOOTHING, ROUNDS, PENALTY, LEAST = 0.5, 10, 4.0, 0.02
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, languages map<string,double>"
#: Symbols: 0 a space, 1 to 26 letters, then the bytes from 128 on.
SYMBOLS = 155
CODES = SYMBOLS**3
_LUT = np.zeros(256, np.uint8)
_LUT[97:123] = _LUT[65:91] = np.arange(1, 27)
_LUT[128:] = np.arange(27, SYMBOLS)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all trigrams but those of spaces only around their middle, and each one's text."""
    buf, starts = padded(data, offsets, 2, 32)
    buf = _LUT[buf].astype(np.uint32)
    a, b, c = buf[:-2], buf[1:-1], buf[2:]
    code = (a * SYMBOLS + b) * SYMBOLS + c
    keep = np.flatnonzero((b != 0) | ((a != 0) & (c != 0)))
    text = np.searchsorted(starts - 1, keep, "right") - 1
    return code[keep], text


@lean
def count_rows(batches):
    """(lang, slot, n): sums of a task, given out whenever four million pairs have gathered."""
    index: dict[str, int] = {}
    sums = Counts()

    def out():
        keys, n = sums.drain()
        names = pa.array(list(index), pa.string())
        for i in range(0, len(keys), 100_000):
            k = keys[i : i + 100_000].astype(np.int64)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(k // CODES)), pa.array((k % CODES).astype(np.int32)), pa.array(n[i : i + 100_000])], ["lang", "slot", "n"])

    for batch in batches:
        of = np.array([index.setdefault(x, len(index)) for x in batch.column("lang").to_pylist()], np.uint64)
        for i, j, data, offsets in byte_chunks(batch.column("text")):
            code, text = trigrams(data, offsets)
            sums.add(of[i:j][text] * np.uint64(CODES) + code)
        if len(sums.keys) > 4_000_000:
            yield from out()
    yield from out()


class Table:
    """Probabilities by row (a trigram; 0: one that wasn't found) and language: those that were counted, and each language's smoothing for the rest."""

    def __init__(self, row: np.ndarray, lang: np.ndarray, n: np.ndarray, rows: int, languages: int):
        order = np.lexsort((lang, row))
        under = np.bincount(lang, weights=n, minlength=languages) + SMOOTHING * rows
        self.shape = rows, languages
        self.start = np.searchsorted(row[order], np.arange(rows + 1)).astype(np.int64)
        self.lang = lang[order].astype(np.uint16)
        self.value = ((n[order] + SMOOTHING) / under[lang[order]]).astype(np.float32)
        self.smooth = (SMOOTHING / under).astype(np.float32)

    def __getitem__(self, rows: np.ndarray) -> np.ndarray:
        """The given rows, by all languages."""
        out = np.tile(self.smooth, (len(rows), 1))
        first, many = self.start[rows], self.start[rows + 1] - self.start[rows]
        at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
        out[np.repeat(np.arange(len(rows)), many), self.lang[at]] = self.value[at]
        return out


def fit(p: np.ndarray, n: np.ndarray, first: np.ndarray, mask: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """EM for many texts at once: rows of p and n (trigram probabilities by language, counts) of text i start at first[i].

    mask: texts x languages that may have a share. Returns proportions and log-likelihoods.
    """
    sizes = np.diff(np.append(first, len(n)))
    total = np.add.reduceat(n, first)
    pi = mask / mask.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        w = p * np.repeat(pi, sizes, axis=0).astype(np.float32)
        w *= (n / np.einsum("ij->i", w))[:, None]
        pi = np.add.reduceat(w, first, axis=0).astype(np.float64) / total[:, None]
    s = np.einsum("ij,ij->i", p, np.repeat(pi, sizes, axis=0).astype(np.float32))
    return pi, np.add.reduceat(n * np.log(s).astype(np.float64), first)


def proportions(rows: np.ndarray, table: Table, code: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Each text's proportions over its chosen language set; zeros for texts without trigrams. rows: code -> row of the table."""
    out = np.zeros((n_texts, table.shape[1]))
    key, n = np.unique(text.astype(np.int64) * CODES + code, return_counts=True)
    if not len(key):
        return out
    owner, p, n = key // CODES, table[rows[key % CODES]], n.astype(np.float32)
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    ids = owner[first]
    total = np.add.reduceat(n, first)
    penalty = PENALTY * np.log(total + 1)
    full, _ = fit(p, n, first, np.ones((len(ids), table.shape[1])))
    single = np.add.reduceat(np.log(p) * n[:, None], first, axis=0).astype(np.float64)
    best_one = single.argmax(axis=1)
    full[np.arange(len(ids)), best_one] += 1e-9
    order = np.argsort(-full, axis=1, kind="stable")
    best = np.zeros_like(full)
    best[np.arange(len(ids)), best_one] = 1
    value = single.max(axis=1) - penalty
    sizes = np.diff(np.append(first, len(n)))
    for k in range(2, table.shape[1] + 1):
        use = np.flatnonzero(full[np.arange(len(ids)), order[:, k - 1]] >= LEAST)
        if not len(use):
            break
        rows = np.repeat(np.isin(np.arange(len(ids)), use), sizes)
        mask = np.zeros((len(use), table.shape[1]))
        np.put_along_axis(mask, order[use, :k], 1, axis=1)
        begin = np.concatenate([[0], np.cumsum(sizes[use])[:-1]])
        pi, ll = fit(p[rows], n[rows], begin, mask, 5)
        better = ll - k * penalty[use] > value[use]
        best[use[better]] = pi[better]
        value[use[better]] = (ll - k * penalty[use])[better]
    out[ids] = best
    return out


@lean
def predict_rows(batches, model):
    names, known, table = model.value
    rows = np.zeros(CODES, np.int32)
    rows[known] = np.arange(1, len(known) + 1)
    for batch in batches:
        texts = batch.column("text")
        pred, score, mix = [], [], []
        for i, j, data, offsets in byte_chunks(texts):
            if names:
                pi = proportions(rows, table, *trigrams(data, offsets), j - i)
                top, most = pi.argmax(axis=1).tolist(), pi.max(axis=1).tolist()
            else:
                pi, top, most = np.zeros((j - i, 0)), [0] * (j - i), [0.0] * (j - i)
            letters = (_LUT[data] != 0) & (data < 128)
            sums = np.concatenate([[0], np.cumsum(letters)])
            plain = sums[offsets[1:]] > sums[offsets[:-1]]
            for r in range(j - i):
                if most[r] > 0 and (plain[r] or any(map(str.isalpha, texts[i + r].as_py() or ""))):
                    pred.append(names[top[r]])
                    score.append(min(1.0, most[r]))
                    mix.append([(names[x], float(pi[r, x])) for x in np.flatnonzero(pi[r])])
                else:
                    pred.append("und")
                    score.append(0.0)
                    mix.append([])
        kind = pa.map_(pa.string(), pa.float64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(mix, kind)], ["doc_id", "held_out", "lang_pred", "score", "languages"])


def learn(train: DataFrame) -> tuple[list[str], np.ndarray, Table]:
    """From (lang, text): the languages in order, the codes found, and the probabilities by row (0: a code that wasn't, then those found) and language."""
    got = train.where("lang is not null and text is not null").select("lang", "text").mapInArrow(count_rows, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    lang, slot, n = got.column("lang").combine_chunks().dictionary_encode(), got.column("slot").to_numpy(), got.column("n").to_numpy()
    lang = lang.combine_chunks() if isinstance(lang, pa.ChunkedArray) else lang
    found = lang.dictionary.to_pylist()
    names = sorted(found)
    known, row = np.unique(slot, return_inverse=True)
    of = np.array([names.index(x) for x in found], np.int64)[lang.indices.to_numpy()] if names else np.zeros(0, np.int64)
    return names, known, Table(row + 1, of, n.astype(float), len(known) + 1, len(names))


def _learnt(rows: DataFrame):
    return rows.sparkSession.sparkContext.broadcast(learn(rows.where(~F.col("held_out"))))


def identify(docs: DataFrame, held_out) -> DataFrame:
    """doc_id, held_out, lang_pred, score and the proportions of each row; learns from the rows whose held_out is false."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", held_out.alias("held_out"))
    model = _learnt(rows)
    return rows.select("doc_id", "held_out", "text").mapInArrow(lambda it: predict_rows(it, model), SCHEMA)


def documents_identified(docs: DataFrame) -> DataFrame:
    return identify(docs, crc_mod(F.col("doc_id"), 4) == 2)


def confident(docs: DataFrame, held_out, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, with a language that has ``least`` of the mixture or more; texts without letters go. Each row is judged by its text alone."""
    model = _learnt(docs.select("text", "lang", held_out.alias("held_out")))
    known = lambda out: np.array([x != "und" and s >= least for x, s in zip(out.column("lang_pred").to_pylist(), out.column("score").to_pylist(), strict=True)], bool)
    return rows_where(docs, lambda it: predict_rows(it, model), known)
