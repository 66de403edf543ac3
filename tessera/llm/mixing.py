"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the key -ln(u) / w, an exponential of rate w, where u in (0, 1)
comes from a hash of its id and w is its quality weight; within a source, ascending
keys are a weighted sample without replacement of any length. A source's target is
met by complete epochs first (every document once for each whole multiple of the
source's size), then by the documents with the smallest keys until the rest of the
target is used up.

The prefix sums do not gather a source in one task: keys are binned by their logarithm,
BINS bins an octave. Whatever the weights, an exponential key falls into an octave's bin
with a probability of at most ln(2) / (e * BINS), about 1 in 4,000, so bins are small for
any source; they are summed with map-side combining, and rows are sorted only inside the
single bin where a source's budget ends. Sources are ranked by range partitions, and the
level of their targets is found among the distinct pairs of size and weight, so that a
source for each host does not gather all of them in a task either.

Defined cases: a null text has size 0 and is never taken; a null source is a source of
its own and comes last; repeated rows (equal id and text) have equal keys and are
taken one after the other; a text is counted whole, however long; columns to carry along
that are named like the result's own are left out; an empty table gives an empty result.
Reruns agree, as nothing depends on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, kept, n_words

#: Bins of keys an octave.
BINS = 1 << 10
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
#: A source is repeated at most so many times.
MAX_EPOCHS = 2
#: Most sources whose budgets are sent to all executors; more are joined by a shuffle.
BROADCAST_SOURCES = 1_000
SEED = 42


def quality_weight(text: str, words):
    """From 0.05 to 1: the share of a text's words that have no symbol of their own, at most."""
    symbols = F.coalesce(F.length(text) - F.length(F.translate(text, "#*$%&|<>!", "")), F.lit(0))
    return F.greatest(F.lit(0.05), F.lit(1.0) - symbols / F.greatest(words, F.lit(1)))


def ranked(sizes: DataFrame) -> DataFrame:
    """Adds n, the place of each source from 1, by code point and null last: by range partitions and their counts."""
    order = F.col("source").asc_nulls_last()
    placed = checkpointed(sizes.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))  # a row a partition
    before = counts.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    return placed.withColumn("_own", own).join(F.broadcast(before), F.col("_part") == F.col("_p")).select(*sizes.columns, (F.col("_before") + F.col("_own")).alias("n"))


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target. sizes: source and source_size, one row a source.

    Water filling in closed form: with sources in ascending order of cap / weight, source
    i is at its cap exactly if the budget left after the caps before it, dealt by weight to
    the rest, reaches the cap; the level (target per unit of weight of those below their
    caps) follows from the first source that is not. Sources of equal size and weight are
    one row of the order.
    """
    cycle = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    weighed = ranked(sizes).select("source", "source_size", F.get(cycle, ((F.col("n") - 1) % len(WEIGHTS)).cast("int")).alias("weight"), (F.col("source_size") * float(MAX_EPOCHS)).alias("cap"))
    weighed = checkpointed(weighed)
    alike = weighed.groupBy("cap", "weight").agg(F.sum("source_size").alias("size"), F.sum("cap").alias("caps"), F.sum("weight").alias("weights"))
    ratio = F.col("cap") / F.col("weight")
    ascending = Window.orderBy(ratio, "cap").rowsBetween(Window.unboundedPreceding, -1)  # of distinct pairs
    before = lambda c: F.coalesce(F.sum(c).over(ascending), F.lit(0.0))
    filled = alike.withColumns({"budget": F.sum("size").over(Window.partitionBy()) * (SHARE_PERCENT / 100), "caps_before": before("caps"), "weight_left": F.sum("weights").over(Window.partitionBy()) - before("weights")})
    filled = filled.withColumn("level", (F.col("budget") - F.col("caps_before")) / F.col("weight_left"))
    level = filled.where(F.col("level") * F.col("weight") < F.col("cap")).agg(F.min(F.struct(ratio.alias("r"), "cap", "level"))["level"]).first()[0]
    target = F.col("cap") if level is None else F.least("cap", F.lit(level) * F.col("weight"))
    return weighed.select("source", "source_size", target.alias("target"))


def _keyed(seed: int) -> dict:
    """Columns of a row: size, key, bin of the key, hash of the text."""
    digits = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id")).cast("binary")), 1, 13), 16, 10)
    uniform = (digits.cast("long") + F.lit(0.5)) / float(1 << 52)
    size = n_words("text")
    key = -F.log(uniform) / quality_weight("text", size)
    return {"size": size, "_key": key, "_bin": F.floor(F.log2(key) * BINS).cast("int"), "_h": F.xxhash64("text")}


def _dealt(docs: DataFrame, keep: list[str], split_last: bool, seed: int) -> tuple[DataFrame, DataFrame, DataFrame, bool]:
    """Rows outside and inside the bin where their source's budget ends, each with part (words of
    the fractional epoch); the budgets; whether these are few."""
    rows = docs.select("doc_id", "source", *keep, *[c.alias(n) for n, c in _keyed(seed).items()])
    rows = checkpointed(rows)
    bins = checkpointed(rows.groupBy("source", "_bin").agg(F.sum("size").alias("words")))
    plan = checkpointed(targets(bins.groupBy("source").agg(F.sum("words").alias("source_size"))))
    few = plan.count() <= BROADCAST_SOURCES
    send = F.broadcast if few else lambda df: df
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = plan.withColumn("rest", F.greatest(F.lit(0), F.round("target").cast("long") - F.col("epochs") * F.col("source_size")))
    running = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    before = bins.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    wanted = send(plan.select(F.col("source").alias("_p"), "rest"))
    ends = before.join(wanted, F.col("source").eqNullSafe(F.col("_p"))).where("before < rest AND rest <= before + words").select("_p", F.col("_bin").alias("end_bin"), "before")
    budget = plan.withColumnRenamed("source", "_s").join(ends, F.col("_s").eqNullSafe(F.col("_p")), "left").drop("_p")
    marked = rows.join(send(budget), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    whole = marked.where("end_bin IS NULL OR _bin <> end_bin").withColumn("part", F.when(F.col("_bin") < F.col("end_bin"), F.col("size")).otherwise(F.lit(0)))
    inside = Window.partitionBy("source").orderBy("_key", "doc_id", "_h", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = marked.where("_bin = end_bin").withColumn("left", F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(inside), F.lit(0)))
    cut = F.greatest(F.lit(0), F.least("size", "left"))
    if not split_last:
        cut = F.when((2 * cut >= F.col("size")) & (cut > 0), F.col("size")).otherwise(F.lit(0))
    return whole, edge.withColumn("part", cut).drop("left"), budget, few


def mix(docs: DataFrame, keep: list[str] | None = None, split_last: bool = True, seed: int = SEED) -> DataFrame:
    """doc_id, source, keep, size, source_size, target, epochs, taken of every document.

    taken is the words that the mix takes, over all epochs. Where a budget ends inside a
    document, split_last takes the words up to the budget; otherwise the document is taken
    whole if that brings the source nearer to its target.
    """
    keep = kept(keep, "doc_id", "source", "text", "size", "source_size", "target", "epochs", "taken")
    whole, edge, _, _ = _dealt(docs, keep, split_last, seed)
    out = ["doc_id", "source", *keep, "size", "source_size", "target", "epochs"]
    taken = (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken")
    return whole.select(*out, taken).unionByName(edge.select(*out, taken))


def repeated(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: every row of docs as often as it is taken, whole, with the columns of docs.

    The rows are dealt out where they are read, by the last key that each source takes, so
    texts are not shuffled. Copies of the row at that place (equal id and text) are all taken.
    """
    names = {c: c if c in ("doc_id", "source", "text") else f"c{i}" for i, c in enumerate(docs.columns)}  # no clash with names in here
    docs = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    _, edge, budget, few = _dealt(docs, [], False, seed)
    own = F.struct("_key", "doc_id", "_h")
    last = edge.where("part > 0").groupBy(F.col("source").alias("_l")).agg(F.max(own).alias("_last"))
    budget = budget.select("_s", F.col("epochs").alias("_epochs"), F.col("end_bin").alias("_end")).join(last, F.col("_s").eqNullSafe(F.col("_l")), "left").drop("_l")
    budget = checkpointed(budget)
    rows = docs.withColumns({n: c for n, c in _keyed(seed).items() if n != "size"} | {"_words": n_words("text")})
    rows = rows.join(F.broadcast(budget) if few else budget, F.col("source").eqNullSafe(F.col("_s")))
    more = F.coalesce((F.col("_bin") < F.col("_end")) | (own <= F.col("_last")), F.lit(False)) & (F.col("_words") > 0)
    times = F.when(F.col("_words") > 0, F.col("_epochs")).otherwise(0) + more.cast("long")
    return rows.withColumn("_times", times.cast("int")).where("_times > 0").withColumn("_n", F.explode(F.sequence(F.lit(1), "_times"))).select(*[F.col(n).alias(c) for c, n in names.items()])
