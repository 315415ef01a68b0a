"""Near-duplicates: MinHash bands propose pairs, parities and odd sketches discard the dissimilar, full shingle sets confirm.

A text's set holds its distinct five-word shingles (fewer words: the whole sequence; no words: the empty set, linked with nothing). Texts with
equal sets form one class and only classes are compared. A class has 128 MinHash samples; 84 make 28 bands of three (a pair at similarity 0.75 shares none
with probability 2e-7), and all are folded into a 1024-bit parity bitmap, the odd sketch. Two samples that differ flip two random bits, so XOR's population
count bounds the number that differ: more than ``XOR_LIMIT`` set bits need 67 differing samples or more of 128, which similarity 0.75 gives with a probability under 1e-11.
The set itself is folded into 1024 parity bits too. Each shingle that only one of two sets has flips one, so XOR's count is never above the number of these, of which linked sets have a seventh of their
sizes' sum at most: this discards no link, and up to some 1,500 shingles little else than links passes.

Buckets of a band are never expanded into all pairs: first all members of each are compared with one leader and links are closed into components. Then small buckets
compare the members of different components. Larger ones that still hold several components are dealt again, by the shingles that are rare among their members: two sets can only
link if they share one of the first n - ceil(0.75 n) + 1 of their n shingles, rarest first, early enough in both. There, rounds go on with leaders among the members outside
a shingle's largest component, until none is left that wasn't compared with every member of another component. So each link's two ends come out in one component.

Edge cases: null texts are empty; repeated rows and equal ids are kept as rows; component_id ignores null ids unless all of a component's are null; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_chunks, free, lean, materialise, mix64, word_hashes
from .components import components, merged

SHINGLE, SAMPLES, BANDS, ROWS, SKETCH_BITS = 5, 128, 28, 3, 1024
XOR_LIMIT = 132
#: Buckets up to SMALL compare all members of different components; rare shingles go by leaders, up to LEADERS in the first round and twice as many in each next.
SMALL, LEADERS = 32, 256
#: Up to so many pairs, they are broadcast to the sets instead of shuffling all sets.
FEW_PAIRS = 200_000
#: A rare shingle's members are dealt to tasks in parts of about so many, each with a copy of its leaders.
PART = 256

_rng = np.random.default_rng(5)
_ODD = (_rng.integers(0, 2**31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_WORD = _rng.integers(0, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SAMPLE = _rng.integers(0, 2**63, SAMPLES, dtype=np.uint64)
_BAND = (_rng.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2)) + np.uint64(1)
FEATURES = "doc_id long, text_key long, n_shingles long, sig binary, bands array<long>, sketch array<long>, parity array<long>"


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    h, first = word_hashes(data, offsets)
    rolled = np.zeros(max(0, len(h) - SHINGLE + 1), np.uint64)
    for j in range(SHINGLE):
        rolled += h[j : len(h) - SHINGLE + 1 + j] * _WORD[j]
    rolled = mix64(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(rolled[a : b - SHINGLE + 1]))
        elif b > a:
            out.append(mix64((h[a:b] * _WORD[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _parity(h: np.ndarray) -> np.ndarray:
    """The bitmap, as 64-bit words, of the places that an odd number of the hashes fall on."""
    bits = np.bincount((h >> np.uint64(54)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def sketch_set(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Band keys, and the odd sketch and the set's parity as 64-bit words, of a set that isn't empty."""
    low = (s >> np.uint64(32)).astype(np.uint32)
    least = np.empty(SAMPLES, np.uint32)
    for a in range(0, SAMPLES, 16):
        best = None
        for k in range(0, len(low), 4096):
            now = (_ODD[a : a + 16] * low[k : k + 4096]).min(axis=1)
            best = now if best is None else np.minimum(best, now)
        least[a : a + 16] = best
    wide = least.astype(np.uint64)
    bands = mix64((wide[: BANDS * ROWS].reshape(BANDS, ROWS) * _BAND).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
    return bands.view(np.int64), _parity(mix64(wide + _SAMPLE)), _parity(s)


@lean
def feature_rows(batches):
    for batch in batches:
        for i, j, data, offsets in byte_chunks(batch.column("text")):
            sets = shingle_sets(data, offsets)
            done = [sketch_set(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(i, j - i),
                    batch.column("text_key").slice(i, j - i),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([x and x[0] for x in done], pa.list_(pa.int64())),
                    pa.array([x and x[1] for x in done], pa.list_(pa.int64())),
                    pa.array([x and x[2] for x in done], pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "n_shingles", "sig", "bands", "sketch", "parity"],
            )


def set_rows(batches):
    for batch in batches:
        for i, j, data, offsets in byte_chunks(batch.column("text")):
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(i, j - i), pa.array([s.tobytes() for s in shingle_sets(data, offsets)], pa.binary())], ["node", "items"])


@lean
def verify_rows(batches):
    """The pairs whose sets have 100 * intersection >= 75 * union."""
    for batch in batches:
        keep = np.zeros(len(batch), bool)
        x, y = batch.column("x"), batch.column("y")
        last, a = None, None
        for i in range(len(batch)):
            own = x[i].as_buffer()
            if last is None or own.address != last:
                a, last = np.frombuffer(own, np.uint64), own.address
            b = np.frombuffer(y[i].as_buffer(), np.uint64)
            if min(len(a), len(b)) * 100 >= 75 * max(len(a), len(b)):
                at = np.searchsorted(a, b)
                at[at == len(a)] = 0
                both = int((a[at] == b).sum())
                keep[i] = 100 * both >= 75 * (len(a) + len(b) - both)
        mask = pa.array(keep)
        yield pa.RecordBatch.from_arrays([batch.column("u").filter(mask), batch.column("v").filter(mask)], ["u", "v"])


def xor_count(a: str, b: str) -> Column:
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(1, SKETCH_BITS // 64)), F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0])))


def may_link(n_a: str, n_b: str, p_a: str, p_b: str, s_a: str, s_b: str) -> Column:
    """Sizes, parities and sketches allow similarity 0.75."""
    sizes = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * 75
    return sizes & (xor_count(p_a, p_b) * 7 <= F.col(n_a) + F.col(n_b)) & (xor_count(s_a, s_b) <= XOR_LIMIT)


def _near(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(features with their node, (node, component) of linked classes)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    features = materialise(docs.withColumn("text_key", F.xxhash64("text")).mapInArrow(feature_rows, FEATURES), "minhash")
    features, classes, id_of = _classes(features)
    slots = classes.select("node", F.posexplode("bands").alias("band", "value")).select("node", F.xxhash64("band", "value").alias("bucket"))
    # sums by bucket are written before they are joined back: Spark splits a hot bucket in a join of two shuffles, not in one that also sums
    sizes = materialise(slots.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("leader")).where("size > 1"), "sizes")
    members = materialise(slots.join(sizes, "bucket"), "buckets")
    light = classes.select("node", "n", "sketch", "parity")
    sets = _sets(docs, classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "doc_id"), id_of)
    stars = members.where("node <> leader").select(F.col("leader").alias("u"), F.col("node").alias("v"))
    groups = components(_verified(_likely(stars.distinct(), light), sets))
    # within a small bucket: each member but the leader with those after it that are of other components
    few = members.where(f"size > 2 and size <= {SMALL} and node <> leader").join(groups, "node", "left").select("bucket", F.struct("node", F.coalesce("component", "node").alias("c")).alias("x"))
    lists = few.groupBy("bucket").agg(F.sort_array(F.collect_list("x")).alias("all"))
    later = F.transform("all", lambda x, i: F.struct(x["node"].alias("u"), F.filter(F.slice("all", i + 2, SMALL), lambda y: y["c"] != x["c"]).alias("rest")))
    small = lists.select(F.explode(later).alias("x")).select("x.u", F.explode("x.rest.node").alias("v"))
    found = _verified(_likely(small.distinct(), light), sets)
    if not found.isEmpty():
        groups = merged(groups, found)
    every_part = F.sequence(F.lit(0), F.col("parts") - 1)
    rare = _parted(_rare(members.where(f"size > {SMALL}").select("bucket", "node", "size"), groups, sets))
    crowded = materialise(rare.drop("size").join(light, "node"), "crowded")
    done = crowded.select("bucket", "node").limit(0)
    turn = 0
    while True:
        turn += 1
        placed = crowded.join(groups, "node", "left").select("bucket", "part", "node", "n", "pos", "prev", "sketch", "parity", F.coalesce("component", "node").alias("component"))
        held = placed.groupBy("bucket", "component").agg(F.count("*").alias("held"))
        most = held.groupBy("bucket").agg(F.max_by("component", F.struct("held", "component")).alias("largest"), (F.sum("held") - F.max("held")).alias("others"), _parts(F.sum("held")).alias("parts")).where("others > 0")
        outside = placed.join(most.withColumn("part", F.explode(every_part)), ["bucket", "part"]).where("component <> largest").join(done, ["bucket", "node"], "left_anti")
        # all of a few, else one of each hash slot: a bounded number of leaders for a bucket of any size
        limit = LEADERS << min(turn - 1, 4)
        slot = F.when(F.col("others") <= limit, F.col("node")).otherwise(F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(limit)))
        chosen = outside.groupBy("bucket", slot.alias("slot")).agg(F.min(F.struct("node", "n", "pos", "prev", "sketch", "parity", "component", "parts")).alias("x"))
        chosen = materialise(chosen.select("bucket", "x.*"), "leaders")
        if chosen.isEmpty():
            break
        done = done.unionAll(chosen.select("bucket", "node"))
        theirs = chosen.select("bucket", F.explode(every_part).alias("part"), F.col("node").alias("leader"), F.col("n").alias("n_l"), F.col("pos").alias("pos_l"), F.col("prev").alias("prev_l"), F.col("sketch").alias("s_l"), F.col("parity").alias("p_l"), F.col("component").alias("c_l"))
        # with the same shingle before this one, both meet there
        pairs = placed.join(theirs, ["bucket", "part"]).where((F.col("component") != F.col("c_l")) & F.coalesce(F.col("prev") != F.col("prev_l"), F.lit(True)))
        # what both may share lies at or after this shingle
        pairs = pairs.where((F.least(F.col("n") - F.col("pos"), F.col("n_l") - F.col("pos_l")) * 175 >= (F.col("n") + F.col("n_l")) * 75) & may_link("n", "n_l", "parity", "p_l", "sketch", "s_l"))
        of = [F.least("component", "c_l").alias("a"), F.greatest("component", "c_l").alias("b"), xor_count("sketch", "s_l").alias("x")]
        pairs = materialise(pairs.select(F.least("node", "leader").alias("u"), F.greatest("node", "leader").alias("v"), *of).distinct(), "candidates")
        # of two components the likeliest pair goes first: if it links, the others need no look
        best = pairs.groupBy("a", "b").agg(F.min(F.struct("x", "u", "v")).alias("best")).select("best.u", "best.v")
        found = _verified(best, sets)
        if not found.isEmpty():
            groups = merged(groups, found)
        new = [groups.select(F.col("node").alias(x), F.col("component").alias(f"new_{x}")) for x in ("a", "b")]
        apart = pairs.join(new[0], "a", "left").join(new[1], "b", "left").where(F.coalesce("new_a", "a") != F.coalesce("new_b", "b")).select("u", "v").join(best, ["u", "v"], "left_anti")
        found = _verified(apart, sets)
        if not found.isEmpty():
            groups = merged(groups, found)
    return features, groups


def _id(sig: Column, turn: int) -> Column:
    return F.xxhash64(sig, F.lit(turn))


def _classes(features: DataFrame) -> tuple[DataFrame, DataFrame, Callable[[Column], Column]]:
    """(features with their node, a row for each class, digest -> node). A node is 64 bits of the set's 128-bit digest; digests that share one with a lesser digest get another.

    Those come to the driver: with N classes about N * N / 2**65, so three of ten thousand million.
    """
    moved: dict[bytes, int] = {}

    def id_of(sig: Column) -> Column:
        out = F.when(F.lit(False), F.lit(0).cast("long"))
        for turn in sorted(set(moved.values())):
            out = out.when(sig.isin([F.lit(bytearray(x)) for x, t in moved.items() if t == turn]), _id(sig, turn))
        return out.otherwise(_id(sig, 0))

    while True:
        named = features.withColumn("node", id_of(F.col("sig")))
        wanted = (F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("parity").alias("parity"), F.min("doc_id").alias("doc_id"), F.min("sig").alias("sig"), F.max("sig").alias("last"))
        classes = materialise(named.where("n_shingles > 0").groupBy("node").agg(*wanted), "classes")
        mixed = classes.where("sig <> last").select("node", F.col("sig").alias("least"))
        again = [bytes(r["sig"]) for r in named.where("n_shingles > 0").join(mixed, "node").where("sig <> least").select("sig").distinct().collect()] if not mixed.isEmpty() else []
        if not again:
            return named, classes.drop("sig", "last"), id_of
        for sig in again:
            moved[sig] = moved.get(sig, 0) + 1


def _several(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows (bucket, node, size) of buckets whose members are of several components, large buckets dealt in parts."""
    placed = rows.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.max("size").alias("size")).where("a <> b")
    mixed = mixed.select("bucket", F.explode(F.sequence(F.lit(0), _parts(F.col("size")) - 1)).alias("part"))
    return _parted(placed).join(mixed, ["bucket", "part"], "left_semi").drop("component", "part")


def _parts(size: Column) -> Column:
    return (size / PART).cast("int") + 1


def _parted(rows: DataFrame) -> DataFrame:
    """Rows (node, size, ...) with the part of their bucket that they are dealt to."""
    return rows.withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), _parts(F.col("size"))).cast("int"))


def _rare(crowds: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(bucket, node, pos, prev, size): the shingles, as buckets of some size, at which members of crowds (bucket, node) can link others, their place in the node's set, rarest first, and the shared one before.

    Equally rare shingles of the same sets stand together, so pairs that share a run of them meet once; a bucket whose members all have one shingle before it is left out, as they meet there.
    """
    nodes = _several(crowds, groups).select("node").distinct()
    tokens = materialise(sets.join(nodes, "node", "left_semi").mapInArrow(token_rows, "node long, size long, token long"), "tokens")
    often = tokens.groupBy("token").agg(F.count("*").alias("often"), F.bit_xor(F.xxhash64("node")).alias("who")).where("often > 1")
    shared = tokens.join(often, "token").groupBy("node").agg(F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("often", "who", "token"))).alias("all"))
    # shingles that no other set has come first and can't meet
    alone = F.col("size") - F.size("all")
    most = F.col("size") - F.ceil(F.col("size") * 75 / 100) + 1
    first = shared.select("node", alone.alias("alone"), F.slice("all", 1, F.greatest(F.lit(0), most - alone).cast("int")).alias("first"))
    both = F.transform("first", lambda x, i: F.struct(x["token"].alias("bucket"), F.get("first", i - 1)["token"].alias("prev")))
    places = first.select("node", "alone", F.posexplode(both).alias("i", "x")).select("x.bucket", "node", (F.col("alone") + F.col("i")).alias("pos"), "x.prev")
    rare = materialise(places, "rare")
    placed = rare.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    counts = (F.count("*") - F.count("prev")).alias("firsts"), F.min("prev").alias("a"), F.max("prev").alias("b"), F.min("component").alias("c"), F.max("component").alias("d"), F.count("*").alias("size")
    wanted = materialise(placed.groupBy("bucket").agg(*counts).where("(firsts > 0 or a <> b) and c <> d").select("bucket", "size"), "wanted")
    return rare.join(wanted, "bucket")


@lean
def token_rows(batches):
    for batch in batches:
        for i in range(len(batch)):
            token = np.frombuffer(batch.column("items")[i].as_buffer(), np.int64)
            node, size = batch.column("node")[i].as_py(), len(token)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, node)), pa.array(np.full(size, size)), pa.array(token)], ["node", "size", "token"])


def _sets(docs: DataFrame, wanted: DataFrame, id_of: Callable[[Column], Column]) -> DataFrame:
    """(node, items): the sets of the wanted classes (node, doc_id), computed again from one text of each."""
    found = docs.where("text is not null").join(wanted.withColumnRenamed("doc_id", "d"), F.col("doc_id").eqNullSafe(F.col("d"))).select("node", "text")
    made = found.mapInArrow(_checked_sets, "node long, items binary, sig binary")
    # ids may repeat with other texts: those have other sets
    return materialise(made.where(F.col("node") == id_of(F.col("sig"))).select("node", "items").dropDuplicates(["node"]), "sets")


@lean
def _checked_sets(batches):
    for batch in batches:
        for out in set_rows([batch]):
            items = out.column("items")
            yield out.append_column("sig", pa.array([blake2b(x.as_buffer() if x.is_valid else b"", digest_size=16).digest() for x in items], pa.binary()))


def _likely(pairs: DataFrame, light: DataFrame) -> DataFrame:
    """The pairs (u, v) that sizes, parities and sketches let pass."""
    a = light.select(F.col("node").alias("u"), F.col("n").alias("n_u"), F.col("parity").alias("p_u"), F.col("sketch").alias("s_u"))
    b = light.select(F.col("node").alias("v"), F.col("n").alias("n_v"), F.col("parity").alias("p_v"), F.col("sketch").alias("s_v"))
    return pairs.join(a, "u").join(b, "v").where(may_link("n_u", "n_v", "p_u", "p_v", "s_u", "s_v")).select("u", "v")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets link, written."""
    pairs = materialise(pairs, "pairs")
    few = pairs.count() <= FEW_PAIRS
    held = F.broadcast if few else lambda x: x
    x = sets.select(F.col("node").alias("u"), F.col("items").alias("x")).join(held(pairs), "u")
    y = sets.select(F.col("node").alias("v"), F.col("items").alias("y"))
    if few:  # only the sets that pairs name are shuffled
        y = y.join(F.broadcast(pairs.select("v").distinct()), "v", "left_semi")
    return materialise(x.join(y, "v").select("u", "v", "x", "y").mapInArrow(verify_rows, "u long, v long"), "links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): component_id is the least id of all texts that links reach; kept marks that row."""
    features, groups = _near(docs)
    rows = features.select("doc_id", "n_shingles", "node")
    placed = rows.where("n_shingles > 0").join(groups, "node", "left").select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component"))
    least = materialise(placed.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    named = placed.join(least, "component").select("doc_id", "n_shingles", "component_id")
    empty = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return named.unionAll(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` of each component: that of the least id, null the last, and of one id's texts that of the least hash. Texts without words all stay."""
    features, groups = _near(docs)
    placed = features.where("n_shingles > 0").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = placed.groupBy("component").agg(F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "text_key")).alias("first"))
    # the names must differ from every column of docs
    kept_id, kept_key, key = free(docs, "kept_id", "kept_key", "key")
    keep = first.select(F.col("first.doc_id").alias(kept_id), F.col("first.text_key").alias(kept_key))
    keyed = docs.withColumn(key, F.xxhash64("text"))
    worded = F.coalesce(F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    # rows that repeat both id and text are of one component
    chosen = keyed.where(worded).join(keep, F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id)) & (F.col(key) == F.col(kept_key)), "left_semi").dropDuplicates(["doc_id", key])
    return chosen.unionByName(keyed.where(~worded)).drop(key)
