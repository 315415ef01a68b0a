"""Models in one process, by their definition: what the operators are held against."""

import math
from collections import Counter, defaultdict

import numpy as np
import zstandard

from toolgraph.llm import langid
from toolgraph.llm.ctw import decisions, kt


def fill(amount: float, children: list[tuple[float, float]]) -> list[float]:
    """Shares of ``amount`` by weight among (weight, capacity), shortages going to the siblings: the rounds that ``shared`` has in closed form (tests hold it against them)."""
    out, left = [0.0] * len(children), set(range(len(children)))
    while left and amount > 1e-9:
        total = sum(children[i][0] for i in left)
        if total <= 0:
            break
        short = [i for i in left if children[i][1] - out[i] <= amount * children[i][0] / total]
        if not short:
            for i in left:
                out[i] += amount * children[i][0] / total
            break
        given = 0.0
        for i in short:
            given += children[i][1] - out[i]
            out[i] = children[i][1]
        left -= set(short)
        amount -= given
    return out


def budgets(leaves: dict[tuple, int], weights: dict[tuple, float], total: float, max_epochs: float) -> dict[tuple, int]:
    """Tokens for each leaf path, from the tokens it holds; on the driver, for small trees and tests."""
    held: dict[tuple, float] = defaultdict(float)
    children: dict[tuple, set] = defaultdict(set)
    for path, tokens in leaves.items():
        for d in range(len(path) + 1):
            held[path[:d]] += tokens * max_epochs
            if d:
                children[path[: d - 1]].add(path[:d])
    out: dict[tuple, int] = {}

    def go(node: tuple, amount: float) -> None:
        if node in leaves:
            out[node] = int(amount + 1e-6)
            return
        below = sorted(children[node])
        for child, share in zip(below, fill(amount, [(weights.get(c, 1.0), held[c]) for c in below]), strict=True):
            go(child, share)

    go((), min(total, held[()]))
    return out


class Model:
    """The same model with dense tables in one process, for small trees: next state by preceding byte, and log10 probability of each next byte, by state."""

    def __init__(self, tables: list[dict[int, np.ndarray]], depth: int):
        """tables[d]: context (an integer of d bytes, the latest lowest) -> counts of the next byte, for the contexts that are nodes."""
        root = tables[0].get(0, np.zeros(256))
        inner: list[tuple[int, int]] = [(0, 0)]
        for d in range(1, depth):
            inner += [(d, c) for c in sorted(tables[d])]
        index = {x: i for i, x in enumerate(inner)}
        self.inner = len(inner)
        child = np.zeros((self.inner, 256), np.int32)
        self.child = child
        kids: list[list[tuple[int, int]]] = [[] for _ in inner]
        for d in range(1, depth + 1):
            for c in sorted(tables[d]):
                kids[index[d - 1, c & ((1 << 8 * (d - 1)) - 1)]].append((c >> 8 * (d - 1), c))
        size = self.inner
        leaf_counts: list[np.ndarray] = []
        leaf_of: list[tuple[int, int]] = []
        for i, (d, c) in enumerate(inner):
            own = root if d == 0 else tables[d][c]
            rest = own.astype(np.float64).copy()
            child[i] = size + len(leaf_counts)
            leaf_counts.append(rest)
            leaf_of.append((i, -1))
            for byte, k in kids[i]:
                rest -= tables[d + 1][k]
                if d + 1 < depth:
                    child[i, byte] = index[d + 1, k]
                else:
                    child[i, byte] = size + len(leaf_counts)
                    leaf_counts.append(tables[d + 1][k].astype(np.float64))
                    leaf_of.append((i, byte))
        parent = np.zeros(size + len(leaf_counts), np.int64)
        for i in range(1, size):
            d, c = inner[i]
            parent[i] = index[d - 1, c & ((1 << 8 * (d - 1)) - 1)]
        parent[size:] = [i for i, _ in leaf_of]
        level = np.array([d for d, _ in inner])
        log_w = np.zeros((len(parent), 255), np.float32)
        for a in range(0, len(leaf_counts), 2048):
            log_w[size + a : size + a + 2048] = kt(*decisions(np.array(leaf_counts[a : a + 2048])))
        sums = np.zeros((size, 255))
        np.add.at(sums, parent[size:], log_w[size:])
        beta = np.zeros((size, 255), np.float32)
        own = [root if d == 0 else tables[d][c] for d, c in inner]
        for d in range(depth - 1, -1, -1):
            at = np.flatnonzero(level == d)
            for part in np.array_split(at, max(1, len(at) // 2048)):
                est = kt(*decisions(np.array([own[i] for i in part]).reshape(-1, 256)))
                beta[part] = np.clip(est - sums[part], -700, 700)
                log_w[part] = np.logaddexp(est, sums[part]) - np.log(2)
            if d:
                np.add.at(sums, parent[at], log_w[at])
        del log_w, sums
        # probabilities of a one, from the root's child side down: a state's mixture needs its ancestors' estimates and weights
        self.logp = np.zeros((len(parent), 256), np.float32)
        everything = np.arange(size, len(parent))
        for part in np.array_split(everything, max(1, len(everything) // 1024)):
            zeros, ones = decisions(np.array([leaf_counts[i - size] for i in part]))
            p = (ones + 0.5) / (zeros + ones + 1)
            up, live = parent[part], np.ones(len(part), bool)
            for _ in range(depth):
                if not live.any():
                    break
                zeros, ones = decisions(np.array([own[i] for i in up[live]]))
                here = (ones + 0.5) / (zeros + ones + 1)
                share = 1 / (1 + np.exp(-beta[up[live]].astype(np.float64)))
                p[live] = share * here + (1 - share) * p[live]
                was_root = up == 0
                up = np.where(was_root, 0, parent[up])
                live &= ~was_root
            logs = np.zeros((len(part), 512))
            one, zero = np.log10(p), np.log10(1 - p)
            for i in (1, 2, 4, 8, 16, 32, 64, 128):
                logs[:, 2 * i : 4 * i : 2] = logs[:, i : 2 * i] + zero[:, i - 1 : 2 * i - 1]
                logs[:, 2 * i + 1 : 4 * i : 2] = logs[:, i : 2 * i] + one[:, i - 1 : 2 * i - 1]
            self.logp[part] = logs[:, 256:]
        self.logp = np.ascontiguousarray(self.logp[size:])
        self.depth = depth

    def score(self, buf: np.ndarray, where: np.ndarray) -> np.ndarray:
        """log10 probability of the byte at each position, given the bytes before it."""
        state = self.child[0][buf[where - 1]].astype(np.int64)
        flat = self.child.reshape(-1)
        for d in range(2, self.depth + 1):
            low = state < self.inner
            at = np.where(low, state * 256 + buf[where - d], 0)
            state = np.where(low, flat[at], state)
        return self.logp.reshape(-1)[(state - self.inner) * 256 + buf[where]].astype(np.float64)


def full_alignment(template: list, text: list) -> tuple[int, int, int] | None:
    """(matched, first, last place) of the most words of the template in order in the text, of equals the one with fewest text words passed over; without a band."""
    row = [(0, 0, -1, -1)] * (len(text) + 1)
    for word in template:
        new = [(0, 0, -1, -1)]
        for p, w in enumerate(text):
            best = row[p + 1]
            left = new[p]
            if left[0]:
                best = max(best, (left[0], left[1] - 1, left[2], left[3]))
            if w == word:
                matched, gap, first, _ = row[p]
                best = max(best, (matched + 1, gap, first if matched else p, p))
            new.append(best)
        row = new
    best = max(row)
    return (best[0], best[2], best[3]) if best[0] else None


def language_mixtures(train: list[tuple[str, str]]):
    """From (text, language) a function that gives a text's proportions by language: plain EM over trigrams as byte strings in dictionaries."""

    def grams(t):
        b = bytes(x + 32 if 65 <= x < 91 else x if 97 <= x < 123 or x > 127 else 32 for x in t.encode())
        b = b"  " + b + b"  "
        return Counter(b[i : i + 3] for i in range(len(b) - 2) if b[i + 1] != 32 or (b[i] != 32 and b[i + 2] != 32))

    counts: dict = {}
    for t, x in train:
        counts.setdefault(x, Counter()).update(grams(t))
    names, known = sorted(counts), set().union(*counts.values())
    under = {x: sum(counts[x].values()) + 0.5 * (len(known) + 1) for x in names}

    def em(n, p, pi, rounds):
        for _ in range(rounds):
            new = dict.fromkeys(pi, 0.0)
            for g, k in n.items():
                s = sum(pi[x] * p[g][x] for x in pi)
                for x in pi:
                    new[x] += k * pi[x] * p[g][x] / s
            pi = {x: v / sum(n.values()) for x, v in new.items()}
        return pi, sum(k * math.log(sum(pi[x] * p[g][x] for x in pi)) for g, k in n.items())

    def judged(t):
        n = grams(t)
        p = {g: {x: (counts[x][g] + 0.5) / under[x] for x in names} for g in n}
        penalty = langid.PENALTY * math.log(sum(n.values()) + 1)
        full, _ = em(n, p, dict.fromkeys(names, 1 / len(names)), langid.ROUNDS)
        single = {x: sum(k * math.log(p[g][x]) for g, k in n.items()) for x in names}
        top = max(names, key=lambda x: single[x])
        full[top] += 1e-9
        best, value = {top: 1.0}, single[top] - penalty
        order = sorted(names, key=lambda x: -full[x])
        for k in range(2, len(names) + 1):
            if full[order[k - 1]] < langid.LEAST:
                break
            pi, ll = em(n, p, dict.fromkeys(order[:k], 1 / k), 5)
            if ll - k * penalty > value:
                best, value = pi, ll - k * penalty
        return best

    return judged


def difference(model: dict, text: str) -> float:
    """The normalised difference of a text's sizes under two dictionaries, block by block."""
    data, both = (text or "").encode(), []
    for d in (model["bad"], model["good"]):
        c = zstandard.ZstdCompressor(level=1, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False, write_content_size=False, write_dict_id=False)
        both.append(sum(len(c.compress(data[i : i + 2048])) for i in range(0, len(data), 2048)))
    return (both[0] - both[1]) / (both[0] + both[1]) if data else 0.0


def compressed(model: dict):
    """A function that gives a text's score under a learnt model."""
    return lambda text: 1 / (1 + math.exp(-model["a"] - model["b"] * difference(model, text)))
