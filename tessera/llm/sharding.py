"""Shards of near-equal bytes by k-d tree partitioning.

Items are recursively split at a weighted quantile (the median where both sides get
as many shards) along the widest metadata dimension of their node, until every leaf is
one shard holding its share of the bytes. All nodes of a level are split together. A
weighted quantile is found by radix refinement: bytes are summed by node and digit of
the key, the digit where the sum crosses the wanted share is kept, and the next digit
is looked at inside it; so rows are never sorted or gathered, every pass shuffles at
most nodes * 2**DIGIT sums, and the driver sees one row a node.

The items are groups of equal texts, which stay together. A group over
1 / GROUP_PART of a shard is dealt into small pieces by a hash of the id first, so that one
hot group cannot unbalance the shards; group_pieces says into how many (1: together).

A cut passes between items, so one large item at a cut leaves its leaves unequal. The
leaves are therefore laid out in their order, each with its smallest items at both ends and
the largest in the middle, and the line is cut anew into equal shares of bytes: only small
items at the ends of a leaf change over to the leaf beside it. Positions come from sums of
bins, at most 2 * CLASSES * 64 a leaf; items are sorted only in the bins that a cut crosses.

Defined cases: a null or empty text has size 8; nulls in source or language are values
like any other; rows with equal id and text may get any slot of their shard, and
nothing else about them differs; only the length and hashes of a text are used, however long
it is; columns to carry along that are named like the result's own are left out; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, kept, n_bytes

SHARDS, GROUP_PART, PIECES = 24, 8, 32
#: Bits of a coordinate, of the tie-breaking hash behind it, and of one digit.
COORDINATE, TIE, DIGIT = 24, 24, 12
#: Rows of a shard that are numbered by one task, about.
SLOT_ROWS = 200_000
#: Classes of an item's bytes: eighths of an octave.
CLASSES = 512
DIMENSIONS = ("x_size", "x_source", "x_lang", "x_id")


def _scaled(items: DataFrame) -> DataFrame:
    """Coordinates of all dimensions stretched to 0 .. 2**COORDINATE - 1."""
    span = items.agg(*[f(d).alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max))])
    wide = items.crossJoin(F.broadcast(span))  # one row
    top = float((1 << COORDINATE) - 1)
    scaled = {d: F.when(F.col(f"hi_{d}") > F.col(f"lo_{d}"), F.floor((F.col(d) - F.col(f"lo_{d}")) / (F.col(f"hi_{d}") - F.col(f"lo_{d}")) * top)).otherwise(0).cast("long") for d in DIMENSIONS}
    return wide.withColumns(scaled).select(*items.columns)


def _by_node(values: dict, kind: str) -> Column:
    """values[node], null for other nodes: a place of a constant array, however many shards there are."""
    cells = [f"cast('{values[n]!r}' AS {kind})" if n in values else f"cast(NULL AS {kind})" for n in range(max(values, default=-1) + 1)]
    return F.get(F.expr(f"array({', '.join(cells)})"), F.col("node"))


def kd_tree(items: DataFrame, shards: int) -> DataFrame:
    """Adds node, the first shard of the leaf. items: DIMENSIONS, tie (TIE bits) and weight."""
    items = checkpointed(_scaled(items).withColumn("node", F.lit(0)))
    sizes = {0: shards}
    while any(n > 1 for n in sizes.values()):
        split = {k: n for k, n in sizes.items() if n > 1}
        widths = items.where(F.col("node").isin(list(split))).groupBy("node").agg(F.sum("weight").alias("weight"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]).collect()  # a row a node
        widest = {r["node"]: max(DIMENSIONS, key=lambda d: r[d]) for r in widths}
        wanted = {r["node"]: r["weight"] * (split[r["node"]] // 2) / split[r["node"]] for r in widths}
        along = F.get(F.array(*[F.col(d) for d in DIMENSIONS]), _by_node({k: DIMENSIONS.index(d) for k, d in widest.items()}, "int"))
        key = F.shiftleft(along, TIE) + F.col("tie")
        level = items.where(F.col("node").isin(list(widest))).select("node", key.alias("key"), "weight") if widest else None
        cut = {k: 0 for k in widest}  # digits found so far
        below = {k: 0.0 for k in widest}
        for shift in range(COORDINATE + TIE - DIGIT, -1, -DIGIT):
            if not widest:
                break
            prefix = _by_node(cut, "bigint")
            digit = F.shiftright(F.col("key"), shift).bitwiseAND((1 << DIGIT) - 1)
            sums = level.where(F.shiftright(F.col("key"), shift + DIGIT) == prefix).groupBy("node", digit.alias("digit")).agg(F.sum("weight").alias("weight"))
            running = Window.partitionBy("node").orderBy("digit")
            left = _by_node({k: float(wanted[k] - below[k]) for k in widest}, "double")
            marked = sums.withColumn("upto", F.sum("weight").over(running)).withColumn("left", left)
            last = marked.groupBy("node").agg(F.max("digit").alias("digit"))
            found = marked.where("upto >= left").groupBy("node").agg(F.min(F.struct("digit", F.col("upto") - F.col("weight"), "weight")).alias("hit")).collect()  # a row a node
            hits = {r["node"]: (r["hit"][0], r["hit"][1], r["hit"][2]) for r in found}
            if len(hits) < len(widest):  # rounding at the last digit
                hits = {r["node"]: (r["digit"], 0.0, 0.0) for r in last.collect()} | hits
            for k, (d, before, weight) in hits.items():
                cut[k] = (cut[k] << DIGIT) | d
                below[k] += before
                if shift == 0 and wanted[k] - below[k] > weight / 2:  # the nearer side of the item at the cut
                    cut[k] += 1
        if widest:
            right = F.when(key >= _by_node(cut, "bigint"), F.col("node") + _by_node({k: split[k] // 2 for k in widest}, "int"))
            items = checkpointed(items.withColumn("node", F.coalesce(right, F.col("node")).cast("int")))
        sizes = {k: n for k, n in sizes.items() if n == 1} | {j: m for k, n in split.items() for j, m in ((k, n // 2), (k + n // 2, n - n // 2))}
    return items


def even_cuts(items: DataFrame, shards: int, order: list[str]) -> DataFrame:
    """items of kd_tree with shard: the leaves in a line, cut into shares of equal weight."""
    size_class = F.least(F.lit(CLASSES - 1), F.floor(F.log2(F.col("weight").cast("double")) * 8)).cast("int")
    place = F.when(F.col("tie").bitwiseAND(1) == 0, size_class).otherwise(2 * CLASSES - size_class)
    binned = items.withColumn("_place", place).withColumn("_sub", F.shiftright("tie", 1).bitwiseAND(63).cast("int"))
    same = ["node", "_place", "_sub"]
    bins = checkpointed(binned.groupBy(*same).agg(F.sum("weight").alias("_bytes")))
    leaves = bins.groupBy("node").agg(F.sum("_bytes").alias("_leaf"))  # at most shards rows
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    leaves = leaves.select(F.col("node").alias("_n"), F.coalesce(F.sum("_leaf").over(upto(Window.orderBy("node"))), F.lit(0)).alias("_start"), F.sum("_leaf").over(Window.partitionBy()).alias("_all"))
    before = F.col("_start") + F.coalesce(F.sum("_bytes").over(upto(Window.partitionBy("node").orderBy("_place", "_sub"))), F.lit(0))
    bins = bins.join(F.broadcast(leaves), F.col("node") == F.col("_n")).select(*[F.col(c).alias(f"_b{c}") for c in same], "_bytes", "_all", before.alias("_before"))
    number = lambda at: F.greatest(F.lit(0), F.least(F.lit(shards - 1), F.floor(at * shards / F.col("_all")))).cast("int")
    crossed = number(F.col("_before")) != number(F.col("_before") + F.col("_bytes") - 1)
    bins = checkpointed(bins.withColumn("_crossed", crossed))
    found = binned.join(bins, [binned[c] == bins[f"_b{c}"] for c in same])
    whole = found.where("NOT _crossed").withColumn("shard", number(F.col("_before") + F.col("_bytes") / 2))
    own = F.sum("weight").over(Window.partitionBy(*same).orderBy("tie", *order))  # of at most shards bins
    cut = found.where("_crossed").withColumn("_own", own).withColumn("shard", number(F.col("_before") + F.col("_own") - F.col("weight") / 2)).drop("_own")
    return whole.unionByName(cut).select(*items.columns, "shard")


def shard(docs: DataFrame, shards: int = SHARDS, keep: list[str] | None = None) -> DataFrame:
    """doc_id, keep, size, text_crc32, shard, slot and group_pieces of every row."""
    names = {c: f"c{i}" for i, c in enumerate(kept(keep, "doc_id", "size", "text_crc32", "shard", "slot", "group_pieces"))}  # no clash with names in here
    keep = list(names.values())
    docs = docs.select("doc_id", "text", "source", "lang", *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    code = lambda c: F.crc32(F.coalesce(c, F.lit("\0")).cast("binary"))
    rows = docs.select(
        "doc_id", *keep, (n_bytes("text") + 8).alias("size"), crc.alias("text_crc32"), F.xxhash64("text").alias("_text"), F.xxhash64("doc_id").alias("_deal"), code("source").alias("_source"), code("lang").alias("_lang")
    )
    rows = checkpointed(rows)
    groups = rows.groupBy("_text", "text_crc32", "size").agg(
        F.sum("size").alias("bytes"), F.min("_source").alias("x_source"), F.min("_lang").alias("x_lang"), F.coalesce(F.min("doc_id"), F.lit(-1)).cast("double").alias("x_id"), F.count("*").alias("n")
    )
    groups = checkpointed(groups)
    total, n_rows = groups.agg(F.sum("bytes"), F.sum("n")).first()
    limit = max(1.0, (total or 0) / shards / GROUP_PART)
    pieces = F.when((F.col("bytes") > limit) & (F.col("n") > 1), F.least("n", F.ceil(PIECES * F.col("bytes") / F.lit(limit)))).otherwise(1).cast("long").alias("pieces")
    large = groups.select("_text", "text_crc32", "size", pieces).where("pieces > 1")  # fewer than shards * GROUP_PART groups
    dealt = rows.join(F.broadcast(large), ["_text", "text_crc32", "size"], "left").withColumn("_piece", F.when(F.col("pieces").isNull(), 0).otherwise(F.pmod("_deal", "pieces")))
    same = ["_text", "text_crc32", "size", "_piece"]
    items = dealt.groupBy(*same).agg(
        F.sum("size").alias("weight"), F.min("_source").alias("x_source"), F.min("_lang").alias("x_lang"), F.coalesce(F.min("doc_id"), F.lit(-1)).cast("double").alias("x_id"), F.count("*").alias("n")
    )
    items = items.withColumn("x_size", F.log2(F.col("size").cast("double"))).withColumn("tie", F.shiftrightunsigned(F.xxhash64("_text", "_piece"), 64 - TIE))
    leaves = even_cuts(kd_tree(items, shards), shards, same).select(*[F.col(c).alias(f"i{c}") for c in same], "shard")
    match = [dealt[c] == leaves[f"i{c}"] for c in same]
    placed = dealt.join(leaves, match).select("doc_id", *keep, "size", "text_crc32", "_text", "shard", F.coalesce("pieces", F.lit(1)).cast("long").alias("group_pieces"))
    numbered = with_slots(placed, max(1, -(-(n_rows or 0) // (shards * SLOT_ROWS))))
    return numbered.select("doc_id", *[F.col(n).alias(c) for c, n in names.items()], "size", "text_crc32", "shard", "slot", "group_pieces")


def with_slots(placed: DataFrame, sections: int) -> DataFrame:
    """Numbers the rows of each shard from 0: rows are numbered in sections of a shard, which are added up."""
    placed = checkpointed(placed.withColumn("_section", F.pmod(F.xxhash64("doc_id"), F.lit(sections)).cast("int")))
    running = Window.partitionBy("shard").orderBy("_section").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "_section").agg(F.count("*").alias("n")).withColumn("_offset", F.coalesce(F.sum("n").over(running), F.lit(0))).drop("n")
    own = Window.partitionBy("shard", "_section").orderBy("doc_id", "_text")
    numbered = placed.withColumn("_n", F.row_number().over(own))
    return numbered.join(offsets, ["shard", "_section"]).withColumn("slot", F.col("_offset") + F.col("_n") - 1).drop("_section", "_offset", "_n", "_text")
