"""Mixing sources to target weights over a tree domain -> language -> source.

Budgets go down the tree: a node's tokens are shared among its children by weight; a child that holds less than its share (tokens times ``max_epochs``) gets what it
holds and the rest goes to its siblings by weight, again and again, so only what a whole subtree lacks reaches the siblings of its ancestors. A leaf takes its
budget as whole epochs over all its texts and then a prefix, in tokens, of one more epoch's seeded order.

Sharing is closed form: in ascending order of capacity by weight, the children up to some place are filled, and the others get what is left by weight. So each level is a
window over the children of a node, and the tree never leaves Spark. A text's place in an epoch is the MD5 of seed, epoch and id, in hexadecimal digits.

The prefix is found without gathering a leaf: tokens are summed by the next ``DIGITS`` digits, the sums name the one range in which the budget ends, and that range is split
again by the next digits until it has ``EDGE`` texts or fewer, or texts of one digest only; these are ordered as counted (id, tokens) pairs. The text that crosses the budget is the last taken.

Edge cases: a null text has no tokens; null domains, languages and sources are those named by the empty text; equal digests go by id (null first), then token count; repeated rows count each;
a leaf without tokens gets nothing, and so does a child without weight; without tokens at all the result is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

SEED, MAX_EPOCHS, SHARE, DIGITS, EDGE = 17, 4, 0.6, 2, 1000
TREE = ["domain", "lang", "source"]
#: Target weights by path; a path that isn't listed weighs 1.
WEIGHTS = {("d0",): 3.0, ("d1",): 2.0, ("d2",): 1.0, **{(d, "en"): 4.0 for d in ("d0", "d1", "d2")}, **{(d, "de"): 2.0 for d in ("d0", "d1", "d2")}}
#: Plans of up to so many leaves are broadcast.
FEW_LEAVES = 200_000


def shared(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """(parent, name, share) of children (parent, name, weight, capacity, amount); amount is the parent's."""
    ratio = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).otherwise(float("inf"))
    line = Window.partitionBy(*parent).orderBy("ratio", name)
    c = children.withColumn("ratio", ratio)
    c = c.withColumn("left", F.col("amount") - F.coalesce(F.sum("capacity").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    c = c.withColumn("weights", F.sum("weight").over(line.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    level = F.when(F.col("weights") > 0, F.greatest("left", F.lit(0.0)) / F.col("weights")).otherwise(0.0)
    c = c.withColumn("level", level).withColumn("full", F.col("capacity") <= F.col("level") * F.col("weight"))
    # the first child that isn't filled has the greatest level of those
    rest = F.max(F.when(~F.col("full"), F.col("level"))).over(Window.partitionBy(*parent))
    return c.select(*parent, name, F.when(F.col("full"), F.col("capacity")).otherwise(rest * F.col("weight")).alias("share"))


def plan(leaves: DataFrame, weights: dict[tuple, float], share: float, max_epochs: float) -> DataFrame:
    """(path, held, budget): tokens for each leaf (path, held), for a total of ``share`` of all tokens."""
    spark = leaves.sparkSession
    amounts, leaves = None, leaves.withColumn("top", F.lit(0))
    for d, name in enumerate(TREE, 1):
        parent, path = ["top", *TREE[: d - 1]], TREE[:d]
        listed = [(*k, float(w)) for k, w in weights.items() if len(k) == d]
        weighed = spark.createDataFrame(listed, ", ".join(f"{c} string" for c in path) + ", weight double")
        children = leaves.groupBy("top", *path).agg(F.sum("held").alias("tokens")).withColumn("capacity", F.col("tokens") * F.lit(float(max_epochs)))
        children = children.join(weighed, path, "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
        if amounts is None:  # the root's, over all domains
            total = F.sum("tokens").over(Window.partitionBy("top"))
            children = children.withColumn("amount", F.least(total * F.lit(float(share)), total * F.lit(float(max_epochs))))
        else:
            children = children.join(amounts, parent)
        amounts = shared(children, parent, name).withColumnRenamed("share", "amount")
    budget = F.floor(F.col("amount") + 1e-6)
    return leaves.join(amounts, ["top", *TREE]).select(*TREE, "held", budget.alias("budget"))


def domain_of(source: Column) -> Column:
    """A domain for tables that have none: three groups by the first digit of the source's MD5."""
    return F.concat(F.lit("d"), F.pmod(F.ascii(F.substring(F.md5(F.coalesce(source, F.lit("")).cast("binary")), 1, 1)), F.lit(3)))


def token_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def mix(docs: DataFrame, weights: dict[tuple, float], share: float = SHARE, max_epochs: float = MAX_EPOCHS, seed: int = SEED, domain: Column | None = None, edge: int = EDGE) -> DataFrame:
    """The texts taken: doc_id, domain, lang, source, n_tokens and copies (in how many epochs), for a total of ``share`` of all tokens."""
    none = F.lit("")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(domain_of(F.col("source")) if domain is None else domain, none).alias("domain"), F.coalesce("lang", none).alias("lang"),
        F.coalesce("source", none).alias("source"), token_count(F.col("text")).alias("n_tokens"),
    )
    rows = materialise(rows, "mix")
    leaves = rows.groupBy(*TREE).agg(F.sum("n_tokens").alias("held")).where("held > 0")
    whole = F.floor(F.col("budget") / F.col("held"))
    planned = plan(leaves, weights, share, max_epochs).where("budget > 0").select(*TREE, whole.alias("epochs"), (F.col("budget") - whole * F.col("held")).alias("rest"))
    planned = materialise(planned, "plan")
    held = F.broadcast if planned.count() <= FEW_LEAVES else lambda x: x
    place = F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.col("epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), none)).cast("binary"))
    # a leaf that takes whole epochs only needs no order
    ends = planned.where("rest > 0").select(*TREE, "epochs", "rest", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("before"))
    digits = 0
    while True:
        inside = rows.join(held(ends), TREE).withColumn("place", place).where(F.startswith("place", F.col("prefix")))
        key = F.substring("place", 1, digits + DIGITS)
        sums = inside.groupBy(*TREE, "epochs", "rest", "before", key.alias("next")).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n"), F.min("place").alias("a"), F.max("place").alias("b"))
        upto = F.col("before") + F.sum("tokens").over(Window.partitionBy(*TREE).orderBy("next"))
        ending = sums.withColumn("upto", upto).where((F.col("upto") - F.col("tokens") < F.col("rest")) & (F.col("upto") >= F.col("rest")))
        # a row for each leaf
        found = materialise(ending.select(*TREE, "epochs", "rest", F.col("next").alias("prefix"), (F.col("upto") - F.col("tokens")).alias("before"), ((F.col("n") <= edge) | (F.col("a") == F.col("b"))).alias("last")), "ends")
        ends, digits = found.drop("last"), digits + DIGITS
        if found.where("not last").isEmpty():
            break
    placed = rows.join(held(planned), TREE).withColumn("place", place).join(held(ends.select(*TREE, "prefix", "before")), TREE, "left")
    own = F.substring("place", 1, digits)
    more = F.coalesce(own < F.col("prefix"), F.lit(False)).cast("long")
    clear = placed.where(F.col("prefix").isNull() | (own != F.col("prefix"))).withColumn("copies", F.col("epochs") + more).where("copies > 0").select("doc_id", *TREE, "n_tokens", "copies")
    # the ranges in which budgets end: equal rows are counted, so that a repeated id is one row here
    same = placed.where(own == F.col("prefix")).groupBy(*TREE, "epochs", "rest", "before", "place", "doc_id", "n_tokens").agg(F.count("*").alias("n"))
    line = Window.partitionBy(*TREE).orderBy("place", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    need = F.greatest(F.col("rest") - F.col("before") - F.coalesce(F.sum(F.col("n") * F.col("n_tokens")).over(line), F.lit(0)), F.lit(0))
    taken = F.when(F.col("n_tokens") > 0, F.least(F.col("n"), F.ceil(need / F.col("n_tokens")))).otherwise(F.when(need > 0, F.col("n")).otherwise(0))
    both = F.array(F.struct((F.col("epochs") + 1).alias("copies"), F.col("taken").alias("n")), F.struct(F.col("epochs").alias("copies"), (F.col("n") - F.col("taken")).alias("n")))
    counted = same.withColumn("taken", taken).select("doc_id", *TREE, "n_tokens", F.explode(both).alias("x")).where("x.n > 0 and x.copies > 0")
    # rows again, a thousand at a time
    runs = counted.select("doc_id", *TREE, "n_tokens", "x.copies", "x.n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("x.n") - 1) / 1000))).alias("run"))
    single = runs.withColumn("one", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(1000).cast("long"), F.col("n") - F.col("run") * 1000))))
    return clear.unionByName(single.select("doc_id", *TREE, "n_tokens", "copies"))
