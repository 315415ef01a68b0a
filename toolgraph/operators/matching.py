"""Entity resolution: identity keys by method, candidate edges, and the ordered one-to-one assignment."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalise_package_url, remove_protocol
from .components import components
from .quality import chunked
from .storage import remove, stored, workspace

#: name -> builder of an array of identity values from a record's columns (empty or null: the record has none).
IDENTITIES: dict[str, Callable[[], Column]] = {}


def register_identity(name: str, build: Callable[[], Column]) -> None:
    IDENTITIES[name] = build


def _one(c: Column) -> Column:
    return F.array_compact(F.array(c))


def _homepage() -> Column:
    return F.nullif(remove_protocol(normalise_package_url(F.col("homepage"))), F.lit(""))


register_identity("name", lambda: _one(F.col("name")))
register_identity("name_insensitive", lambda: _one(F.nullif(F.lower("name"), F.lit(""))))
register_identity("homepage", lambda: _one(_homepage()))
register_identity("biotoolsID_unprefixed", lambda: _one(F.regexp_replace("biotoolsID", "^bioconductor-", "")))
register_identity("doi", lambda: F.array_distinct(F.array_compact(F.transform("publication", lambda p: p["doi"]))))
register_identity("name_homepage", lambda: _one(F.when(F.nullif(F.lower(F.trim("name")), F.lit("")).isNotNull() & _homepage().isNotNull(), F.concat_ws("\u001f", F.lower(F.trim("name")), _homepage()))))


def keys(records: DataFrame, methods: list[str], file: str = "file") -> DataFrame:
    """(file, method, value): the inverted index's rows."""
    unknown = [m for m in methods if m not in IDENTITIES]
    if unknown:
        raise ValueError(f"unknown identity methods: {unknown}; known: {sorted(IDENTITIES)}")

    def tag(m: str) -> Column:
        # a record without values for one method still has those of the others
        values = F.coalesce(IDENTITIES[m]().cast("array<string>"), F.array().cast("array<string>"))
        return F.transform(values, lambda v: F.struct(F.lit(m).alias("method"), v.alias("value")))

    tagged = F.flatten(F.array(*map(tag, methods)))
    return records.select(F.col(file).alias("file"), F.explode(tagged).alias("k")).select("file", "k.method", "k.value")


#: Pairs that one task makes at once.
PAIRS = 2_000_000


def edges(left: DataFrame, right: DataFrame) -> DataFrame:
    """(f1, f2, method): pairs that share a value under a method.

    They grow with the product of a value's files, so their number is counted first, and values with more than PAIRS of them are dealt in parts, each a block of left by a block of right. Only files that both have several
    values under a method can meet twice; these pairs alone are compared for repeats.
    """
    k = ["method", "value"]

    def side(df: DataFrame, f: str, n: str) -> DataFrame:
        rows = df.select(F.col("file").alias(f), *k).where("value is not null").distinct()
        return rows.withColumn(f"several_{n}", F.count("*").over(Window.partitionBy(f, "method")) > 1)

    mine, theirs = side(left, "f1", "1"), side(right, "f2", "2")
    sizes = mine.groupBy(*k).agg(F.count("*").alias("n1")).join(theirs.groupBy(*k).agg(F.count("*").alias("n2")), k)
    cut1 = F.least(F.col("n1"), F.ceil(F.col("n1") * F.col("n2") / PAIRS))
    sizes = sizes.withColumn("cut1", cut1).withColumn("cut2", F.least(F.col("n2"), F.ceil(F.col("n1") * F.col("n2") / F.col("cut1") / PAIRS)))
    tasks = int((sizes.agg(F.sum(F.col("n1") * F.col("n2"))).first()[0] or 0) // PAIRS + 1)
    cuts = sizes.select(*k, "cut1", "cut2")
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    own = lambda f, c: F.pmod(F.xxhash64(f), F.col(c))
    mine = mine.join(cuts, k).withColumn("part1", own("f1", "cut1")).withColumn("part2", every("cut2")).drop("cut1", "cut2")
    theirs = theirs.join(cuts, k).withColumn("part2", own("f2", "cut2")).withColumn("part1", every("cut1")).drop("cut1", "cut2")
    on = [*k, "part1", "part2"]
    if tasks > 1:
        mine, theirs = mine.repartition(tasks, *on), theirs.repartition(tasks, *on)
    once = mine.join(theirs, on).where("not (several_1 and several_2)").select("f1", "f2", "method")
    return once.unionByName(mine.where("several_1").join(theirs.where("several_2"), on).select("f1", "f2", "method").distinct())


def without_partner(mine: DataFrame, theirs: DataFrame, files: DataFrame) -> DataFrame:
    """The files (file) none of whose keys (file, method, value) the other side has. Pairs aren't spelt out."""
    shared = mine.join(theirs.select("method", "value").distinct(), ["method", "value"], "left_semi").select("file")
    return files.join(shared, "file", "left_anti")


def inverted_index(rows: DataFrame, lists: bool = True, chunk: int | None = None) -> DataFrame:
    """(method, value, n, files) of keys (file, method, value); without ``lists`` only the counts. With ``chunk`` a value's files come as rows (method, value, chunk, n, files) of at most so many, for values that very many files share."""
    if chunk:
        return chunked(rows.distinct(), ["method", "value"], "file", chunk, "files")
    wanted = [F.count("*").alias("n"), *([F.sort_array(F.collect_list("file")).alias("files")] if lists else [])]
    return rows.distinct().groupBy("method", "value").agg(*wanted)


#: Rows of keys that one task takes at once.
BLOCK = 100_000


def _ordered(f1: list, f2: list, value: list, cut: frozenset = frozenset()) -> tuple[list[tuple], object]:
    """The ordered loop itself over rows of keys (one of f1 and f2 is None): the pairs, and the file at which it had to stop since a list of ``cut`` was used up (None: at the end)."""
    wants: dict = {}
    lists: dict = {}
    for a, b, v in zip(f1, f2, value, strict=True):
        if b is None:
            wants.setdefault(a, []).append(v)
        else:
            lists.setdefault(v, []).append(b)
    for files in lists.values():
        files.sort(reverse=True)
    taken, pairs = set(), []
    for a in sorted(wants):
        best = None
        for v in wants[a]:
            files = lists.get(v)
            if files is None:
                continue
            while files and files[-1] in taken:
                files.pop()
            if files:
                best = files[-1] if best is None or files[-1] < best else best
            elif v in cut:
                return pairs, a
        if best is not None:
            taken.add(best)
            pairs.append((a, best))
    return pairs, None


def _solve_components(batches):
    """Whole components, which come one after the other, in parts of as many as fit a block."""
    import pyarrow as pa

    def solved(rows):
        cols = [rows.column(c).to_pylist() for c in ("f1", "f2", "method", "value")]
        pairs, _ = _ordered(cols[0], cols[1], list(zip(cols[2], cols[3], strict=True)))
        types = [rows.schema.field(c).type for c in ("f1", "f2")]
        yield from pa.Table.from_arrays([pa.array([p[i] for p in pairs], types[i]) for i in (0, 1)], ["f1", "f2"]).to_batches()

    kept = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        kept = table if kept is None else pa.concat_tables([kept, table])
        if len(kept) < BLOCK // 4 or not len(table):
            continue
        ids = kept.column("component").to_numpy()
        whole = len(ids) - int((ids[::-1] != ids[-1]).argmax()) if ids[0] != ids[-1] else 0  # the last one may go on in the next batch
        if whole:
            yield from solved(kept.slice(0, whole))
            kept = kept.slice(whole).combine_chunks()
    if kept is not None and len(kept):
        yield from solved(kept)


def _peel(state: DataFrame, folder: str, turn: int) -> tuple[DataFrame, DataFrame]:
    """Pairs that are final whatever the order of the rest: groups of files that have one value only, the n-th taking the n-th, and pairs in which both are the least that the other can have. And the rows left."""
    k = ["method", "value"]
    live = state.groupBy(*k).agg(F.min("f1").alias("least1"), F.min("f2").alias("least2")).where("least1 is not null and least2 is not null")
    held = F.count("*").over(Window.partitionBy("f1", "f2"))
    state = stored(state.join(live, k).withColumn("held", held), f"{folder}/live-{turn}")
    # every row of such a value is its file's only one
    alone = state.groupBy(*k).agg(F.max("held").alias("most")).where("most = 1").select(*k)
    ranked = state.join(alone, k, "left_semi").withColumn("rank", F.row_number().over(Window.partitionBy(*k, F.col("f1").isNull()).orderBy("f1", "f2")))
    groups = ranked.where("f1 is not null").select(*k, "rank", "f1").join(ranked.where("f2 is not null").select(*k, "rank", "f2"), [*k, "rank"]).select("f1", "f2")
    others = state.join(alone, k, "left_anti")
    best1 = others.where("f1 is not null").groupBy("f1").agg(F.min("least2").alias("f2"))
    best2 = others.where("f2 is not null").groupBy("f2").agg(F.min("least1").alias("f1"))
    fixed = stored(groups.unionByName(best1.join(best2, ["f1", "f2"])), f"{folder}/peeled-{turn}")
    # a group's files that are left over have no one to take
    return fixed, _without(others.select("f1", "f2", *k), fixed)


def _without(state: DataFrame, pairs: DataFrame) -> DataFrame:
    return state.join(pairs.select("f1"), "f1", "left_anti").join(pairs.select("f2"), "f2", "left_anti").select("f1", "f2", "method", "value")


def _pairs(spark, pairs: list[tuple], schema) -> DataFrame:
    import pyarrow as pa

    kinds = pa.Table.from_arrays([pa.array([p[i] for p in pairs], schema.field(c).type) for i, c in enumerate(("f1", "f2"))], ["f1", "f2"])
    return spark.createDataFrame(kinds)


def _all_at_once(state: DataFrame) -> DataFrame:
    """The pairs of a state that is within a block."""
    table = state.toArrow()
    f1, f2, method, value = (table.column(c).to_pylist() for c in ("f1", "f2", "method", "value"))
    return _pairs(state.sparkSession, _ordered(f1, f2, list(zip(method, value, strict=True)))[0], table.schema)


def _first_block(state: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """The pairs of the first files of left that together have about ``block`` rows, by the ordered loop over a few times as many rows, and the rows left.

    Of a value only the first free files of right can be wanted: twice as many as the block's files that have it, and two. If these don't do, as files took them by other values, the loop stops there, and the next block begins there.
    """
    spark, k = state.sparkSession, ["method", "value"]
    mine = state.where("f1 is not null")
    bound = mine.orderBy("f1").limit(block).agg(F.max("f1").alias("bound")).first()["bound"]
    mine = mine.where(F.col("f1") <= F.lit(bound)).select("f1", *k)
    need = mine.groupBy(*k).agg((2 * F.count("*") + 2).alias("need"))
    theirs = state.where("f2 is not null").select("f2", *k).join(need, k)
    for by in ([*k, F.pmod(F.xxhash64("f2"), F.lit(64))], k):  # in parts first, so that no task ranks a whole value
        order = Window.partitionBy(*by).orderBy("f2")
        theirs = theirs.withColumn("rank", F.row_number().over(order)).where("rank <= need + 1").drop("rank")
    table = mine.select("f1", F.lit(None).cast(state.schema["f2"].dataType).alias("f2"), *k, F.lit(None).cast("long").alias("need")).unionByName(theirs.select(F.lit(None).cast(state.schema["f1"].dataType).alias("f1"), "f2", *k, "need")).toArrow()
    f1, f2, method, value, needs = (table.column(c).to_pylist() for c in ("f1", "f2", *k, "need"))
    names = list(zip(method, value, strict=True))
    held: dict = {}
    for b, v, n in zip(f2, names, needs, strict=True):
        if b is not None:
            held.setdefault(v, [n, 0])[1] += 1
    pairs, stop = _ordered(f1, f2, names, frozenset(v for v, (n, files) in held.items() if files > n))
    chosen = _pairs(spark, pairs, table.schema)
    left = F.col("f1") > F.lit(bound) if stop is None else F.col("f1") >= F.lit(stop)
    return chosen, _without(state.where(F.col("f1").isNull() | left), chosen)


def assign(left: DataFrame, right: DataFrame, block: int = BLOCK) -> DataFrame:
    """(f1, f2) one to one: each file of left (file, method, value), in order, takes the least file of right that shares a value with it and that none before it took.

    Pairs are never spelt out: a list of files for each value, in order, and a look at the heads of a file's lists do. Files that share values, also by way of others, form a component, and components don't touch each other: they are found in
    rounds that grow with the logarithm of the longest chain, and those of up to ``block`` rows of keys are each solved by the loop in one task, many in parallel. If all rows are within one block, no components are looked for.

    A component beyond a block is taken in turns, as its order is a chain of dependencies in the worst case: pairs that are final whatever the rest does are taken at once (groups of files with one shared value, mutually least pairs), then the first block
    of files by the loop; so turns are bounded by its rows over ``block``, and a value that very many files share is ranked by sorts that spill. What a turn leaves is written, and the folders before it go.

    Null files and values match nothing; repeated keys count once; empty tables give no pairs.
    """
    spark, k = left.sparkSession, ["method", "value"]
    folder = workspace(spark, "assign")
    side = lambda df, f, other, t: df.select(F.col("file").alias(f), F.lit(None).cast(t).alias(other), *k).where(f"{f} is not null and value is not null")
    types = left.schema["file"].dataType, right.schema["file"].dataType
    both = side(left, "f1", "f2", types[1]).select("f1", "f2", *k).unionByName(side(right, "f2", "f1", types[0]).select("f1", "f2", *k)).distinct()
    shared = both.groupBy(*k).agg(F.count("f1").alias("n1"), F.count("f2").alias("n2")).where("n1 > 0 and n2 > 0").select(*k)
    state = stored(both.join(shared, k, "left_semi"), f"{folder}/keys")
    size, done = state.count(), []
    if size > block:
        # a value stands for the least file of left that has it, so only these files are nodes; two of one hash only make one component of two
        numbered = types[0].simpleString() in ("tinyint", "smallint", "int", "bigint")
        node = lambda c: F.col(c).cast("long") if numbered else F.xxhash64(c)
        hung = stored(state.join(state.groupBy(*k).agg(F.min("f1").alias("head")), k).select("f1", "f2", *k, node("head").alias("head")), f"{folder}/hung-keys")
        theirs = hung.where("f2 is not null").groupBy("f2").agg(F.min("head").alias("least"), F.max("head").alias("most")).where("least <> most").select("f2", "least")
        links = hung.where("f1 is not null").select(node("f1").alias("u"), F.col("head").alias("v")).unionByName(hung.where("f2 is not null").join(theirs, "f2").select(F.col("head").alias("u"), F.col("least").alias("v")))
        labels = components(links, folder)
        tagged = stored(hung.join(labels, F.col("head") == F.col("node"), "left").select(F.coalesce("component", "head").alias("component"), "f1", "f2", *k), f"{folder}/tagged")
        # as many as there are blocks, at most
        large = F.broadcast(stored(tagged.groupBy("component").agg(F.count("*").alias("size")).where(F.col("size") > block).select("component"), f"{folder}/large"))
        small = tagged.join(large, "component", "left_anti").repartition("component").sortWithinPartitions("component")
        done.append(stored(small.mapInArrow(_solve_components, f"f1 {types[0].simpleString()}, f2 {types[1].simpleString()}"), f"{folder}/small"))
        state = tagged.join(large, "component", "left_semi").select("f1", "f2", *k)
    turn = 0
    while True:
        turn += 1
        size, files = state.agg(F.count("*"), F.count("f1")).first()
        if not files:
            break
        if size <= block:
            done.append(stored(_all_at_once(state), f"{folder}/block-{turn}"))
            break
        peeled, rest = _peel(state, folder, turn)
        chosen, rest = _first_block(stored(rest, f"{folder}/rest-{turn}"), block)
        done += [peeled, stored(chosen, f"{folder}/block-{turn}")]
        state = stored(rest, f"{folder}/state-{turn}")
        for name in (f"live-{turn}", f"rest-{turn}", f"state-{turn - 1}"):
            remove(spark, f"{folder}/{name}")
    for name in ("keys", "hung-keys", "hung", "first", "roots", "moved", "large", "tagged", f"state-{turn - 1}"):
        remove(spark, f"{folder}/{name}")
    return reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], f"f1 {types[0].simpleString()}, f2 {types[1].simpleString()}")


def matched(left: DataFrame, right: DataFrame) -> DataFrame:
    """(f1, f2, methods) for the chosen pairs, with every method that links them."""
    mine = left.select(F.col("file").alias("f1"), "method", "value")
    theirs = right.select(F.col("file").alias("f2"), "method", "value")
    return assign(left, right).join(mine, "f1").join(theirs, ["f2", "method", "value"]).groupBy("f1", "f2").agg(F.sort_array(F.collect_set("method")).alias("methods"))


def unmatched(files: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
    return files.join(pairs.select(F.col(side).alias("file")), "file", "left_anti")


def method_counts(pairs: DataFrame) -> DataFrame:
    """(method, n) of matched pairs (f1, f2, methods): how many each method links."""
    return pairs.select(F.explode("methods").alias("method")).groupBy("method").agg(F.count("*").alias("n"))
