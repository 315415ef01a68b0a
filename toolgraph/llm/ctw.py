"""Language-model scoring by context-tree weighting over byte contexts.

Each byte is coded as eight binary decisions (its bits, high first). In every context of up to ``depth`` preceding bytes each of the 255
decision nodes keeps a Krichevsky-Trofimov estimate, and the weighting mixes the estimates of all depths. A context is a node of the tree
if it occurs ``LEAST`` times or more in the training texts, however large those are. The other contexts of a node share one leaf, so the leaves
partition all contexts and the mixture is a proper probability.

A byte's probability depends only on the gram of the byte and its context, so the model is a table of the log probability of each gram that any text has. The tree is weighed in three
steps. Grams are dealt by the four bytes before the last, and tasks weigh the subtrees below these; what they give for each context of four bytes is dealt by its last two bytes
and weighed up to those; the driver weighs the contexts of up to two bytes. No part can outgrow its task, whatever the corpus: a context of four bytes has 65,536 below it, one of two bytes
65,536 of four, and there are 65,793 of up to two (in text, a few thousand of each). On the way back each context of four bytes gets a pair (a, b) such that a + b * p is the whole mixture, p being that of its own subtree. Up to ``TABLE_LIMIT``
grams and tokens the tables are broadcast. Beyond it, texts are dealt in groups of about ``GROUP_BYTES``; a group asks the parts of the tables for the keys that it has, packed as arrays, and is scored with the answers.

Gram and token counts come from all training texts: tasks fold their own and pack them as arrays for each part of the keys, and the parts are summed (as many as there are shuffle partitions, and one at least for each ``PART_BYTES`` of text). Edge cases: a null text is empty;
a null id counts as the empty text for the split; without training texts every decision has probability 1/2 and every token count is 0
(base_score 0 for lack of a distribution if V + N is 0: log10 of 0.1/0.1); repeated rows are scored and counted each.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _R, LOWER_LUT, Counts, byte_chunks, crc_mod, fold_sorted, lean, materialise, mix64, padded, word_hashes

DEPTH, LEAST, DEAL, BORDER = 6, 2, 4, 2
#: Grams, and tokens, that are broadcast at most (16 bytes each); beyond it texts are dealt in groups of so many bytes. Grams that a task weighs.
TABLE_LIMIT, GROUP_BYTES, TASK_GRAMS = 6_000_000, 40 << 20, 50_000
#: Bytes of text for each part of the keys at most.
PART_BYTES = 32 << 20
GRAM_SCHEMA, CELL_SCHEMA = "key long, logp double", "key long, zeros double, ones double, log_w double"
PACKED_SCHEMA, COUNT_SCHEMA = "part int, kind int, keys binary, n binary", "kind int, key long, n long"
_WANTED, WANTED_SCHEMA = ["part", "kind", "keys", "n", "owner"], "part int, kind int, keys binary, n binary, owner long"
OUT_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"

_OUT = pa.schema([(c.split(" ")[0], {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[c.split(" ")[1]]) for c in OUT_SCHEMA.split(", ")])


def grams(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The padded buffer, the positions of every text byte and its end mark (byte 0), and each text's first such position's index (n + 1)."""
    buf, starts = padded(data, offsets, depth)
    buf = LOWER_LUT[buf]
    sizes = np.diff(offsets) + 1
    first = np.concatenate([[0], np.cumsum(sizes)])
    where = np.arange(first[-1]) + np.repeat(starts - first[:-1], sizes)
    return buf, where, first


def gram_keys(buf: np.ndarray, where: np.ndarray, depth: int) -> np.ndarray:
    """Each position's byte (lowest) and the depth bytes before it, as one integer."""
    key, have = buf.astype(np.uint64), 1
    while have <= depth:  # twice as many bytes each time
        step = min(have, depth + 1 - have)
        longer = below(key, step)
        longer[step:] |= key[:-step] << np.uint64(8 * step)
        key, have = longer, have + step
    return key[where]


@lean
def count_rows(batches, depth: int, parts: int):
    """(part, kind, keys, n): counts of byte grams (kind 1) and word hashes (kind 0) over all texts of a task, packed as arrays for each part of the keys; the grams of held-out texts count 0."""
    words, learnt, others = Counts(), Counts(), Counts()

    def out(limit: int):
        for kind, c in ((0, words), (1, learnt), (1, others)):
            if len(c.keys) > limit:
                keys, n = c.drain()
                yield from packed(kind, keys, n * (c is not others), parts)

    for batch in batches:
        for held in (False, True):
            part = batch.filter(pc.equal(batch.column("held_out"), held))
            for _, _, data, offsets in byte_chunks(part.column("text")) if len(part) else ():
                buf, where, _ = grams(data, offsets, depth)
                (others if held else learnt).add(gram_keys(buf, where, depth))
                if not held:
                    words.add(word_hashes(data, offsets)[0])
        yield from out(4_000_000)
    for c in (words, learnt, others):
        c._fold()
    yield from out(0)


def packed(kind: int, keys: np.ndarray, n: np.ndarray, parts: int):
    """Rows of one part each, about a million keys at a time."""
    part = (mix64(keys) % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int64)
    order = np.argsort(part, kind="stable")
    keys, n = keys[order], n[order]
    bounds = np.searchsorted(part[order], np.arange(parts + 1)).tolist()
    rows, held = [], 0
    for p in range(parts):
        x, y = bounds[p], bounds[p + 1]
        if y > x:
            rows.append((p, keys[x:y].tobytes(), n[x:y].astype(np.int64).tobytes()))
            held += y - x
        if rows and (held > 1_000_000 or p + 1 == parts):
            ids, k, m = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array([kind] * len(ids), pa.int32()), pa.array(k, pa.binary()), pa.array(m, pa.binary())], ["part", "kind", "keys", "n"])
            rows, held = [], 0


@lean
def merged_rows(batches):
    """(kind, key, n): the sums of the parts that a task has, folded whenever four million keys wait."""
    held: dict[int, list] = {0: [], 1: []}
    waiting = {0: 0, 1: 0}
    for batch in batches:
        for i in range(len(batch)):
            kind = batch.column("kind")[i].as_py()
            keys = np.frombuffer(batch.column("keys")[i].as_py(), np.uint64)
            held[kind].append((keys, np.frombuffer(batch.column("n")[i].as_py(), np.int64)))
            waiting[kind] += len(keys)
            if waiting[kind] > 4_000_000:
                held[kind], waiting[kind] = [fold_sorted(*map(np.concatenate, zip(*held[kind], strict=True)))], 0
    for kind, parts in held.items():
        if parts:
            keys, n = fold_sorted(*map(np.concatenate, zip(*parts, strict=True)))
            for i in range(0, len(keys), 100_000):
                k = keys[i : i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k.view(np.int64)), pa.array(n[i : i + 100_000])], ["kind", "key", "n"])


def lgamma(x: np.ndarray) -> np.ndarray:
    """log gamma for x >= 0.5: recurrence up to 8, then Stirling's series."""
    shift = np.zeros_like(x)
    x = x.copy()
    for _ in range(8):
        low = x < 8
        shift[low] -= np.log(x[low])
        x[low] += 1
    inv = 1 / (x * x)
    return shift + (x - 0.5) * np.log(x) - x + 0.9189385332046727 + (1 / 12 - inv * (1 / 360 - inv / 1260)) / x


def decisions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones at the 255 decision nodes (index 1 to 255) of rows of byte counts."""
    tree = np.zeros((len(counts), 512))
    tree[:, 256:] = counts
    for i in (128, 64, 32, 16, 8, 4, 2, 1):
        tree[:, i : 2 * i] = tree[:, 2 * i : 4 * i : 2] + tree[:, 2 * i + 1 : 4 * i : 2]
    return tree[:, 2:512:2], tree[:, 3:512:2]


def kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return lgamma(zeros + 0.5) + lgamma(ones + 0.5) - lgamma(zeros + ones + 1) - 1.1447298858494002


def below(keys: np.ndarray, size: int) -> np.ndarray:
    """The lowest bytes of keys."""
    return keys & np.uint64((1 << 8 * size) - 1)


def level(cells: np.ndarray, zeros: np.ndarray, ones: np.ndarray, d: int, least: int) -> SimpleNamespace:
    """The decision nodes of the contexts of d bytes; cells (sorted) are context << 8 | decision node."""
    held = (zeros + ones)[np.searchsorted(cells, cells & ~np.uint64(255) | np.uint64(1))]
    zeros, ones = zeros.astype(float), ones.astype(float)
    est = kt(zeros, ones)
    return SimpleNamespace(cells=cells, zeros=zeros, ones=ones, node=(held >= least) | (d == 0), est=est, log_w=est, p=(ones + 0.5) / (zeros + ones + 1))


def weigh(upper: SimpleNamespace, lower: SimpleNamespace, d: int) -> None:
    """Weights of the contexts of d bytes, from those of one byte more."""
    lower.up = np.searchsorted(upper.cells, below(lower.cells, d + 1))
    own = lower.up[lower.node]
    fold = lambda x: np.bincount(own, x[lower.node], len(upper.cells))
    zeros, ones = upper.zeros - fold(lower.zeros), upper.ones - fold(lower.ones)
    sums = fold(lower.log_w) + kt(zeros, ones)
    upper.log_w = np.logaddexp(upper.est, sums) - np.log(2)
    upper.share = 1 / (1 + np.exp(-np.clip(upper.est - sums, -700, 700)))
    upper.rest = (ones + 0.5) / (zeros + ones + 1)


def subtrees(keys: np.ndarray, n: np.ndarray, depth: int, low: int, least: int) -> tuple[dict[int, SimpleNamespace], np.ndarray]:
    """The levels depth to low of the sorted grams, and the cells of each gram's eight decisions at depth."""
    levels: dict[int, SimpleNamespace] = {}
    shift = np.arange(8, 0, -1, dtype=np.uint64)
    for d in range(depth, low - 1, -1):
        keys, where = np.unique(below(keys, d + 1), return_inverse=True)
        n = np.bincount(where, n, len(keys))
        cell = (keys & ~np.uint64(255))[:, None] | ((keys & np.uint64(255) | np.uint64(256))[:, None] >> shift)
        one = ((keys[:, None] >> (shift - np.uint64(1))) & np.uint64(1)).astype(bool)
        cells, of = np.unique(cell.ravel(), return_inverse=True)
        total, ones = np.bincount(of, np.repeat(n, 8), len(cells)), np.bincount(of, (n[:, None] * one).ravel(), len(cells))
        levels[d] = level(cells, total - ones, ones, d, least)
        if d == depth:
            at = of.reshape(-1, 8)
        else:
            weigh(levels[d], levels[d + 1], d)
    return levels, at


def _grams_of(batches) -> tuple[np.ndarray, np.ndarray]:
    got = [(b.column("key").to_numpy().view(np.uint64), b.column("n").to_numpy()) for b in batches]
    keys, n = (np.concatenate(x) for x in zip(*got, strict=True)) if got else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    order = np.argsort(keys)
    return keys[order], n[order]


def climb(cells: np.ndarray, zeros: np.ndarray, ones: np.ndarray, log_w: np.ndarray, low: int, high: int, least: int) -> dict[int, SimpleNamespace]:
    """The levels low to high, from the weighed cells of the contexts of low bytes."""
    order = np.argsort(cells)
    levels = {low: level(cells[order], zeros[order], ones[order], low, least)}
    levels[low].log_w = log_w[order]
    for d in range(low - 1, high - 1, -1):
        x = levels[d + 1]
        keys, where = np.unique(below(x.cells, d + 1), return_inverse=True)
        levels[d] = level(keys, np.bincount(where, x.zeros, len(keys)), np.bincount(where, x.ones, len(keys)), d, least)
        weigh(levels[d], x, d)
    return levels


def above(levels: dict[int, SimpleNamespace], low: int) -> tuple[np.ndarray, np.ndarray]:
    """(a, b) for each cell of level low: the whole mixture is a + b * p, p being the mixture of its own subtree; b is 0 where its context is no node."""
    at, live = np.arange(len(levels[low].cells)), levels[low].node
    a, b = np.zeros(len(at)), np.ones(len(at))
    for d in range(low - 1, -1, -1):
        at, x = levels[d + 1].up[at], levels[d]
        # below the deepest node of a path, the leaf that its rarer contexts share
        a, b = np.where(live, a, x.rest[at]), np.where(live, b, 0.0)
        live = x.node[at]
        share = np.where(live, x.share[at], 0.0)
        a, b = share * x.p[at] + (1 - share) * a, (1 - share) * b
    return a, b


def _batch(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns], names)


_CELL = ["key", "zeros", "ones", "log_w"]


@lean
def cell_rows(batches, depth: int, low: int, least: int):
    """The weighed cells of the contexts of low bytes, from grams."""
    keys, n = _grams_of(batches)
    if len(keys):
        x = subtrees(keys, n, depth, low, least)[0][low]
        yield _batch(_CELL, x.cells, x.zeros, x.ones, x.log_w)


def _cells_of(batches) -> list[np.ndarray] | None:
    got = [[b.column(c).to_numpy() for c in _CELL] for b in batches]
    return [np.concatenate(x) for x in zip(*got, strict=True)] if got else None


@lean
def border_rows(batches, low: int, high: int, least: int):
    """The weighed cells of the contexts of high bytes, from those of low bytes."""
    if (got := _cells_of(batches)) is not None:
        x = climb(got[0].view(np.uint64), *got[1:], low, high, least)[high]
        yield _batch(_CELL, x.cells, x.zeros, x.ones, x.log_w)


@lean
def above_rows(batches, low: int, high: int, least: int, top):
    """(key, x, y): the pairs (a, b) of the cells of low bytes. top: the levels below high, and the cells of level high - 1 are those of the driver."""
    if (got := _cells_of(batches)) is None:
        return
    levels = climb(got[0].view(np.uint64), *got[1:], low, high, least)
    levels |= {d: x for d, x in top.value.items() if d < high}
    if high:
        levels[high].up = np.searchsorted(levels[high - 1].cells, below(levels[high].cells, high))
    a, b = above(levels, low)
    yield _batch(["key", "x", "y"], levels[low].cells, a, b)


@lean
def gram_rows(batches, depth: int, low: int, least: int):
    """log10 probability of each gram's byte after its context. Rows (key, x, y) are grams and their numbers, without y, or cells of low bytes and their pairs."""
    got = [[b.column("key").to_numpy().view(np.uint64), b.column("x").to_numpy(), b.column("y").to_numpy(zero_copy_only=False)] for b in batches]
    if not got:
        return
    key, x, y = (np.concatenate(c) for c in zip(*got, strict=True))
    gram = np.isnan(y)
    cells, a, b = key[~gram], x[~gram], y[~gram]
    keys, n = key[gram], x[gram]
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    levels, at = subtrees(keys, n, depth, low, least)
    p, live = levels[depth].p[at], levels[depth].node[at]
    for d in range(depth - 1, low - 1, -1):
        at, upper = levels[d + 1].up[at], levels[d]
        p = np.where(live, p, upper.rest[at])
        live = upper.node[at]
        p = np.where(live, upper.share[at] * upper.p[at] + (1 - upper.share[at]) * p, p)
    order = np.argsort(cells)
    of = order[np.searchsorted(cells[order], levels[low].cells)][at]
    p = a[of] + b[of] * p
    one = ((keys[:, None] >> np.arange(7, -1, -1, dtype=np.uint64)) & np.uint64(1)).astype(bool)
    yield _batch(["key", "logp"], keys, np.log10(np.where(one, p, 1 - p)).sum(axis=1))


def gram_table(counts: DataFrame, depth: int, least: int) -> tuple[DataFrame, int]:
    """(key, logp) of every gram, written, and their number."""
    spark, low, high = counts.sparkSession, min(DEAL, depth), min(BORDER, depth)
    gram = counts.where("kind = 1").select("key", "n")
    size = gram.count()
    parts = max(8, size // TASK_GRAMS + 1)
    # grams and cells have their context above the lowest byte
    context = lambda d: F.shiftrightunsigned("key", 8).bitwiseAND((1 << 8 * d) - 1)
    cells = materialise(gram.repartition(parts, context(low)).mapInArrow(lambda it: cell_rows(it, depth, low, least), CELL_SCHEMA), "ctw-cells")
    dealt = cells.repartition(parts, context(high))
    got = dealt.mapInArrow(lambda it: border_rows(it, low, high, least), CELL_SCHEMA).toArrow()
    key, *rest = (got.column(c).to_numpy() for c in _CELL)
    held = spark.sparkContext.broadcast({d: x for d, x in climb(key.view(np.uint64), *rest, high, 0, least).items() if d < high})
    pairs = dealt.mapInArrow(lambda it: above_rows(it, low, high, least, held), "key long, x double, y double")
    both = gram.select("key", F.col("n").cast("double").alias("x"), F.lit(None).cast("double").alias("y")).unionAll(pairs)
    return materialise(both.repartition(parts, context(low)).mapInArrow(lambda it: gram_rows(it, depth, low, least), GRAM_SCHEMA), "ctw-grams"), size


class Table:
    """Key -> value, by a hash table of arrays: entries in order of their slot, each at its slot or at the first free place after the entry before."""

    EMPTY = np.uint64(2**64 - 1)  # grams have 56 bits; of word hashes one in 2**64 would be lost

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 1.4).bit_length())
        kind = np.int32 if self.bits < 31 else np.int64  # half the room where it is built, on the driver
        at = self.slots(keys).astype(kind)
        order = np.argsort(at).astype(kind)
        at, rank = at[order], np.arange(len(keys), dtype=kind)
        at -= rank
        np.maximum.accumulate(at, out=at)
        at += rank
        size = max(1 << self.bits, int(at[-1]) + 1 if len(at) else 0) + 1
        self.keys, self.values = np.full(size, self.EMPTY), np.zeros(size, values.dtype)
        self.keys[at], self.values[at] = keys[order], values[order]

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _R) >> np.uint64(64 - self.bits)).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The values of the keys; 0 without an entry."""
        out, at, where = np.zeros(len(keys), self.values.dtype), self.slots(keys), None
        while len(keys):
            there = self.keys[at]
            found = np.flatnonzero(there == keys)
            out[found if where is None else where[found]] = self.values[at[found]]
            left = np.flatnonzero((there != keys) & (there != self.EMPTY))
            where = left if where is None else where[left]
            keys, at = keys[left], at[left] + 1
        return out


def table_of(rows: pa.Table) -> Table:
    """The grams' log probabilities, in single precision."""
    return Table(rows.column("key").to_numpy().view(np.uint64), rows.column("logp").to_numpy().astype(np.float32))


@lean
def wanted_rows(batches, depth: int, parts: int):
    """(part, kind, keys, n, owner): for each group of texts (owner; rows come group by group) the distinct grams (kind 1) and word hashes (kind 0) that it has, packed as arrays for each part of the keys."""
    words, found, owner = Counts(), Counts(), None

    def out():
        for kind, c in ((0, words), (1, found)):
            for x in packed(kind, *c.drain(), parts):
                yield pa.RecordBatch.from_arrays([*x.columns[:3], pa.array([None] * len(x), pa.binary()), pa.array([owner] * len(x), pa.int64())], _WANTED)

    for batch in batches:
        owners = batch.column("owner").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(owners)) + 1).tolist(), len(owners)]
        for x, y in zip(edges, edges[1:], strict=False):
            if y > x and owner != int(owners[x]):
                yield from out()
                owner = int(owners[x])
            for _, _, data, offsets in byte_chunks(batch.column("text").slice(x, y - x)):
                buf, where, _ = grams(data, offsets, depth)
                found.add(gram_keys(buf, where, depth))
                words.add(word_hashes(data, offsets)[0])
    yield from out()


@lean
def table_rows(batches, kind: int, column: str, parts: int):
    """The same for a table of (key, value): owner -1, and the values beside the keys."""
    for batch in batches:
        keys, values = batch.column("key").to_numpy().view(np.uint64), batch.column(column).to_numpy()
        for x in packed(kind, keys, values.astype(float).view(np.int64), parts):
            yield pa.RecordBatch.from_arrays([*x.columns, pa.array(np.full(len(x), -1))], _WANTED)


@lean
def answer_rows(batches):
    """(owner, kind, keys, n): the keys that each group wants and that the tables have, with their values, of the part that a task has. Rows come by owner, so the part's tables are held, and requests answered one after the other."""
    none = [(np.zeros(0, np.uint64), np.zeros(0))]
    own: dict[int, list] = {0: list(none), 1: list(none)}
    tables = None
    for batch in batches:
        for i in range(len(batch)):
            owner, kind, keys = batch.column("owner")[i].as_py(), batch.column("kind")[i].as_py(), np.frombuffer(batch.column("keys")[i].as_py(), np.uint64)
            if owner < 0:  # the tables come first
                own[kind].append((keys, np.frombuffer(batch.column("n")[i].as_py(), np.float64)))
                continue
            if tables is None:
                tables = {k: Table(*map(np.concatenate, zip(*x, strict=True))) for k, x in own.items()}
                own.clear()
            values = tables[kind].of(keys)
            known = values != 0  # no log probability and no count is 0
            yield pa.RecordBatch.from_arrays([pa.array([owner]), pa.array([kind], pa.int32()), pa.array([keys[known].tobytes()], pa.binary()), pa.array([values[known].astype(np.float32 if kind else np.int64).tobytes()], pa.binary())], ["owner", "kind", "keys", "n"])


@lean
def score_rows(batches, model, vocab, totals, depth):
    """One row a text. model: the grams' table; vocab: the table of word hashes and counts, or None if the counts are joined in later."""
    n_all, n_distinct, end_count = totals
    under = n_all + 0.1 * (n_distinct + 1)
    table = model.value
    known = vocab.value if vocab else None
    for batch in batches:
        cols: list[list] = [[] for _ in range(5)]
        for _, _, data, offsets in byte_chunks(batch.column("text"), 1 << 19):
            h, first = word_hashes(data, offsets)
            n = np.diff(first)
            base, hits = np.zeros(len(n)), np.zeros(len(n), np.int64)
            if known is not None:
                c = known.of(h)
                value = np.log10((c + 0.1) / under) if under else np.zeros(len(h))
                base = np.array([value[a:b].sum() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)])
                seen = np.concatenate([[0], np.cumsum(c > 0)])
                hits = seen[first[1:]] - seen[first[:-1]]
            buf, where, begin = grams(data, offsets, depth)
            score = np.add.reduceat(table.of(gram_keys(buf, where, depth)).astype(float), begin[:-1])
            for to, x in zip(cols, (n, hits, base, score, np.diff(offsets)), strict=True):
                to.append(x)
        if not cols[0]:
            continue
        n, hits, base, score, size = (np.concatenate(x) for x in cols)
        end = float(np.log10((end_count + 0.1) / under))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(n + 1), pa.array(hits + (end_count > 0)), pa.array(np.full(len(n), n_all)), pa.array(base + end), pa.array(score), pa.array(size), pa.array(-score / np.log10(2) / (size + 1))],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"],
        )


def lm_scores(docs: DataFrame, held_out, depth: int = DEPTH, least: int = LEAST, limit: int = TABLE_LIMIT) -> DataFrame:
    """Scores every text; ``held_out`` (a Column over docs) marks the rows that are not learnt from.

    Returns OUT_SCHEMA: the unigram baseline (base_score), the context-tree model's log10 probability of the text and its end (score),
    and the code length per byte.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held_out.alias("held_out"))
    n_train, size = rows.agg(F.count_if(~F.col("held_out")), F.sum(F.octet_length("text"))).first()
    # a text has as many grams as bytes at most, so no part holds more than PART_BYTES of them, whatever the corpus
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (size or 0) // PART_BYTES + 1)
    counted = rows.select("text", "held_out").mapInArrow(lambda it: count_rows(it, depth, parts), PACKED_SCHEMA)
    # arrays instead of rows go through the shuffle: each task has folded its own keys already
    counts = materialise(counted.repartitionById(parts, "part").mapInArrow(merged_rows, COUNT_SCHEMA), "ctw-counts")
    words = counts.where("kind = 0").select("key", "n")
    got = words.agg(F.count("*"), F.sum("n")).first()
    totals = (got[1] or 0) + n_train, got[0] + (n_train > 0), n_train
    table, size = gram_table(counts, depth, least)
    if max(size, got[0]) > limit:
        return _by_group(rows, table, words, totals, depth, parts)
    model = spark.sparkContext.broadcast(table_of(table.toArrow()))
    known = words.toArrow()
    vocab = spark.sparkContext.broadcast(Table(known.column("key").to_numpy().view(np.uint64), known.column("n").to_numpy()))
    return rows.mapInArrow(lambda it: score_rows(it, model, vocab, totals, depth), OUT_SCHEMA)


def _by_group(rows: DataFrame, table: DataFrame, words: DataFrame, totals: tuple, depth: int, parts: int) -> DataFrame:
    """The same without broadcasts: texts are dealt in groups, each group asks the parts of the tables for the keys that it has, and is scored with the answers."""
    groups = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // GROUP_BYTES + 1
    # one shuffle of the texts, which both uses below read: they take the same columns, so that Spark makes it once
    dealt = rows.withColumn("owner", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))).repartition(max(1, groups), "owner")
    asked = dealt.sortWithinPartitions("owner").mapInArrow(lambda it: wanted_rows(it, depth, parts), WANTED_SCHEMA)
    held = table.mapInArrow(lambda it: table_rows(it, 1, "logp", parts), WANTED_SCHEMA).unionAll(words.mapInArrow(lambda it: table_rows(it, 0, "n", parts), WANTED_SCHEMA))
    answers = asked.unionAll(held).repartitionById(parts, "part").sortWithinPartitions("owner").mapInArrow(answer_rows, "owner long, kind int, keys binary, n binary")

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        own: dict[int, list] = {0: [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 1: [(np.zeros(0, np.uint64), np.zeros(0, np.float32))]}
        for r in right.to_pylist():
            own[r["kind"]].append((np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["n"], np.float32 if r["kind"] else np.int64)))
        vocab, model = (SimpleNamespace(value=Table(*map(np.concatenate, zip(*own[kind], strict=True)))) for kind in (0, 1))
        del own
        return pa.Table.from_batches(list(score_rows(left.to_batches(), model, vocab, totals, depth)), _OUT)

    return dealt.groupBy("owner").cogroup(answers.groupBy("owner")).applyInArrow(scored, OUT_SCHEMA)


def documents_scored(docs: DataFrame) -> DataFrame:
    return lm_scores(docs, crc_mod(F.col("doc_id"), 10) == 0)
