"""Near-duplicate classes by BagMinHash.

A text is the multiset of its shingles of SHINGLE words. Its signature comes from one
Poisson process for each shingle over the half line of weights: the unit [0, 1), then
[1, 2), [2, 4), [4, 8) and so on are the levels of the hierarchy, each with its own
process, whose points carry a time, a weight coordinate and one of SIGNATURE components
(all from hashes of shingle, level and number of the point). A component of the
signature is the first point below the shingle's weight, so two signatures agree there
with the probability of the weighted Jaccard similarity. Points come in ascending time
and end at a time by which all components are full, so a text costs a few hashes a
shingle and not SIGNATURE of them; in the rare case that one is left empty, the time is
doubled for that text.

Classes are the connected components of the links, pairs of different texts whose
multisets overlap by SIMILARITY or more (exact weighted Jaccard, not estimated).
Candidates share one of BANDS bands of ROWS components; at similarity 0.8 a pair is
missed with probability 7e-5. Equal texts are one node. Within a bucket no pairs are
made at first: its members are verified against its least member, and only where that
leaves a bucket in several components are members compared across them, after an exact
bound on the overlap. So no link that could join two components is left out, while a
large group of alike texts costs about one comparison a member.

Texts are named by two 64-bit hashes and numbered. Neither candidates nor decisions move
whole texts about: a sieve of bits of the wanted ids (common.sifted, of bounded size) ends
most others in the scan, and what it lets through is decided by a join.

Defined cases: texts without a word (null, empty, only punctuation) are alone in their
class unless equal and not empty; texts under SHINGLE words have one shingle, all their
words; rows with equal id and text count as one; rows without an id get no class; a text is
read whole, however long; other columns do not matter, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import checkpointed, compacted, free_name, measured, sifted

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5
SIGNATURE = BANDS * ROWS
MAX_ROUNDS = 60
#: Links that one task may join up into components.
FEW_LINKS = 1_000_000
#: Most texts that a rare token has; such a token gives RARE * (RARE - 1) / 2 pairs at most.
RARE = 16
#: Members of the largest component of a bucket that the others are first compared with, and by how many times they grow.
PIVOTS, STEP = 16, 64
_DOC_BITS = 12
_ID = T.U((1 << (64 - _DOC_BITS)) - 1)
_BLOCK_ROWS = 1 << _DOC_BITS


def shingles(b: T.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text of a block: hash, weight, row. A block has under 2**12 rows."""
    data = T.lower(b.data)
    starts, ends, rows = T.spans(T.ALNUM[data], b.offsets)
    words = T.span_hashes(data, starts, ends)
    keys, at = T.windows(words, rows, SHINGLE)
    own = rows[at]
    n_words = np.bincount(rows, minlength=b.n)
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    if len(short):
        first = np.searchsorted(rows, short)
        extra = np.zeros(len(short), T.U)
        for j in range(SHINGLE - 1):
            more = n_words[short] > j
            at_j = np.minimum(first + j, len(words) - 1)
            extra = np.where(more, T.mix(extra + words[at_j]), extra)
        keys, own = np.concatenate([keys, extra]), np.concatenate([own, short])
    joined = np.sort((own.astype(T.U) << T.U(64 - _DOC_BITS)) | (keys & _ID))
    if not len(joined):
        return np.zeros(0, T.U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], joined[1:] != joined[:-1]]))
    weight = np.diff(np.concatenate([new, [len(joined)]]))
    return T.mix((joined[new] & _ID) + T.U(1)), weight, (joined[new] >> T.U(64 - _DOC_BITS)).astype(np.int64)


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> T.U(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signatures(hashes: np.ndarray, weight: np.ndarray, row: np.ndarray, n: int, m: int = SIGNATURE) -> np.ndarray:
    """n by m first times; infinity for a text without shingles."""
    out = np.full(n * m, np.inf)
    total = np.bincount(row, weights=weight, minlength=n)
    level = np.zeros(len(hashes), np.int64)
    x, w, r = hashes, weight, row
    top = int(weight.max()) if len(weight) else 0
    parts = [(x, w, r, level)]
    j = 1
    while (1 << (j - 1)) < top:  # level j is [2**(j-1), 2**j)
        some = np.flatnonzero(weight > (1 << (j - 1)))
        parts.append((hashes[some], weight[some], row[some], np.full(len(some), j)))
        j += 1
    x, w, r, level = (np.concatenate(p) for p in zip(*parts, strict=True))
    low = np.where(level == 0, 0.0, np.exp2(np.maximum(level - 1, 0)))
    length = np.maximum(low, 1.0)
    seed = T.mix(x + level.astype(T.U) * T.U(0x9E3779B97F4A7C15))
    todo, factor = np.ones(n, bool), np.log(m) + 3
    while True:
        limit = np.where(todo & (total > 0), factor / np.maximum(total, 1), 0.0)
        live = np.flatnonzero(limit[r] > 0)
        out[np.repeat(todo, m)] = np.inf
        time = np.zeros(len(live))
        point = 0
        while len(live):
            point += 1
            h = T.mix(seed[live] + T.U(point * 0xD1B54A32D192ED03 % (1 << 64)))
            u = _unit(h)
            rate = m * length[live]
            ahead = limit[r[live]] - time
            near = u >= np.exp(-rate * ahead) * (1 - 1e-12)
            live, time, h = live[near], time[near] - np.log(u[near]) / rate[near], h[near]
            inside = time <= limit[r[live]]
            live, time, h = live[inside], time[inside], h[inside]
            g = T.mix(h ^ T.U(0x8CB92BA72F3D8DD7))
            y = low[live] + length[live] * _unit(T.mix(g))
            hit = y < w[live]
            component = (g >> T.U(33)).astype(np.int64) % m
            np.minimum.at(out, r[live][hit] * m + component[hit], time[hit])
        left = np.isinf(out.reshape(n, m)).any(1) & (total > 0)
        if not left.any():
            return out.reshape(n, m)
        todo, factor = left, factor * 2


def _row_blocks(column, limit: int = 2 << 20):
    for b in T.blocks(column, limit):
        for lo in range(0, b.n, _BLOCK_ROWS):
            hi = min(b.n, lo + _BLOCK_ROWS)
            if hi - lo == b.n:
                yield b
            else:
                yield T.Block(slice(b.rows.start + lo, b.rows.start + hi), b.data[b.offsets[lo] : b.offsets[hi]], b.offsets[lo : hi + 1] - b.offsets[lo])


def _list(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values.view(np.int64)))


def _per_text(source: DataFrame, make) -> DataFrame:
    """Adds an array<long> made from each text; the text is the last column of source and goes."""
    names = source.columns[:-1]

    def run(batches):
        for batch in batches:
            for b in _row_blocks(batch.columns[-1]):
                part = batch.slice(b.rows.start, b.n).columns[:-1]
                yield pa.RecordBatch.from_arrays([*part, make(b)], [*names, "made"])

    schema = source.schema[:-1]
    return source.mapInArrow(T.tidy(run), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", made array<bigint>")


def _bands(b: T.Block) -> pa.Array:
    hashes, weight, row = shingles(b)
    words = np.bincount(row, minlength=b.n) > 0
    bits = signatures(hashes, weight, row, b.n).view(T.U).reshape(b.n, BANDS, ROWS)
    out = np.tile(T.mix(np.arange(1, BANDS + 1, dtype=T.U)), (b.n, 1))
    for j in range(ROWS):
        out = T.mix(out ^ bits[:, :, j])
    return _list(out[words].ravel(), np.where(words, BANDS, 0))


def _bag(b: T.Block) -> pa.Array:
    """The multiset as a set: copy c of a shingle is a token of its own."""
    hashes, weight, row = shingles(b)
    x = np.repeat(hashes, weight)
    first = np.repeat(np.cumsum(weight) - weight, weight)
    copy = (np.arange(len(x)) - first).astype(T.U)
    return _list(T.mix(x + copy * T.U(0xA24BAED4963EE407)), np.bincount(row, weights=weight, minlength=b.n).astype(np.int64))


def components(links: DataFrame, n_links: int, few: int = FEW_LINKS) -> DataFrame:
    """node, label (least node of its component) of all ends of links (a, b).

    Up to few links are joined up by one task, which holds two numbers a link. More are joined up by
    all: least labels of neighbours, then of labels (pointer jumping), until nothing changes.
    """
    if n_links <= few:
        return compacted(links.select("a", "b").coalesce(1).mapInArrow(_joined_up, "node bigint, label bigint"))
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    both = compacted(both)
    label = compacted(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("label")))
    for _ in range(MAX_ROUNDS):
        far = both.join(label.select(F.col("node").alias("v"), F.col("label").alias("far")), "v").groupBy(F.col("u").alias("node")).agg(F.min("far").alias("far"))
        nearer = label.join(far, "node").select("node", F.col("label").alias("old"), F.least("label", "far").alias("label"))
        jump = label.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = compacted(nearer.join(jump, "label").select("node", F.least("label", "next").alias("label"), (F.least("label", "next") != F.col("old")).alias("moved")))
        label = new.drop("moved")
        if new.where("moved").isEmpty():
            return label
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _joined_up(batches):
    """Union-find over all links of the partition."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(parent.setdefault(a, a)), find(parent.setdefault(b, b))
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["node", "label"])


def _verify(pairs: DataFrame, bags: DataFrame, similarity: float) -> tuple[DataFrame, int]:
    """a, b, similarity of the pairs that are links, and their number."""
    left = bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a"))
    right = bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("bag_a", "bag_b"))
    share = common / (F.size("bag_a") + F.size("bag_b") - common)
    return measured(both.select("a", "b", share.alias("similarity")).where(F.col("similarity") >= similarity))


def _hashed(docs: DataFrame, *more) -> DataFrame:
    """doc_id, h1, h2 (two hashes of the text that name it) and more."""
    return docs.select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), *more)


def classes(docs: DataFrame, similarity: float = SIMILARITY, few: int = FEW_LINKS) -> tuple[DataFrame, DataFrame]:
    """(h1, h2, node, class_id) a distinct text of a row with an id; and the verified links (a, b, similarity) of nodes.

    class_id is the least id of the class.
    """
    keyed = _hashed(docs.where("doc_id IS NOT NULL"), "text")
    found = _per_text(keyed, _bands)
    # written with their numbers, so these do not change
    texts = checkpointed(found.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.first("made").alias("bands")).withColumn("text_hash", F.monotonically_increasing_id()))
    postings = texts.select("text_hash", F.explode("bands").alias("key"))
    # aggregates are written before they are joined: joined in the same stage, a hot key could not be split
    leaders = compacted(postings.groupBy("key").agg(F.min("text_hash").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n"), 200_000)
    stars = postings.join(leaders, "key").where("text_hash <> a").select("key", "a", F.col("text_hash").alias("b"))
    stars = compacted(stars)
    edges = compacted(stars.groupBy("a", "b").agg(F.count("*").alias("n")))
    nodes = edges.select(F.col("a").alias("text_hash")).union(edges.select(F.col("b").alias("text_hash"))).distinct()
    wanted = compacted(texts.join(nodes, "text_hash").select(F.col("rep").alias("doc_id"), "h1", "h2", F.col("text_hash").alias("node")))
    # most other texts end in the scan: what is shuffled are the bags of those that have a candidate
    likely = sifted(keyed, wanted, "doc_id", "h1").where("_likely").select("doc_id", "h1", "h2", "text")
    bags = _per_text(likely, _bag).withColumnRenamed("made", "bag").join(wanted, ["doc_id", "h1", "h2"]).select("node", "bag")
    bags = compacted(bags.dropDuplicates(["node"]), 2_000)
    # the leader met most often first: most members need no other comparison
    best = edges.groupBy("b").agg(F.max(F.struct("n", "a")).alias("x")).select(F.col("x.a").alias("a"), "b")
    links, n = _verify(best, bags, similarity)
    links, label = _settle(stars, bags, links, n, similarity, few)
    heads = texts.join(label, F.col("text_hash") == F.col("node"), "left").select("h1", "h2", "text_hash", "rep", F.coalesce("label", "text_hash").alias("label"))
    least = compacted(heads.groupBy("label").agg(F.min("rep").alias("class_id")), 200_000)
    return heads.join(least, "label").select("h1", "h2", F.col("text_hash").alias("node"), "class_id"), links


def _settle(stars: DataFrame, bags: DataFrame, links: DataFrame, n: int, similarity: float, few_links: int) -> tuple[DataFrame, DataFrame]:
    """All links and the components. Compares across the components of each bucket that still has several, after exact bounds.

    Tokens that at most RARE texts of all such buckets have are rare. First, the members of a
    bucket are compared with the one that has the largest share of tokens that others have too,
    which is nearest to what they have in common. Then texts that share a rare token are
    compared: each such token gives few pairs. Other pairs overlap in common tokens alone, and
    are compared only where each has enough of them; that rules out texts made from one by many
    edits, and those with much of their own around one passage.

    What is left of a bucket is compared in rounds: those outside its largest component with
    PIVOTS members of that one, then with STEP times as many, and so on. A text with many links
    is inside after a round or two. Once the next would be all, or the rest is no more than the
    buckets had members, all pairs across components that are left are compared, whatever their
    number: it grows with the square of a bucket only where its texts stay in different components
    and the bounds rule out none of their pairs.
    """
    label = components(links, n, few_links)
    members = _labelled(stars, label)
    several = compacted(members.groupBy("key").agg(F.min("l").alias("lo"), F.max("l").alias("hi")).where("lo <> hi").select("key"), 200_000)
    members, left = measured(members.join(several, "key").drop("l"))
    if not left:
        return links, label
    own = bags.join(members.select("node").distinct(), "node")
    tokens = own.select("node", F.explode("bag").alias("token"))
    few = tokens.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") <= RARE)
    rare = compacted(tokens.join(few, "token"), 500_000)
    found = rare.groupBy("node").agg(F.count("*").alias("rare"), F.count_if(F.col("n") == 1).alias("alone"))
    size = F.col("size")
    info = own.select("node", F.size("bag").alias("size")).join(found, "node", "left")
    info = info.select("node", "size", (size - F.coalesce("alone", F.lit(0))).alias("shared"), (size - F.coalesce("rare", F.lit(0))).alias("common"))
    info = compacted(info.where(F.col("shared") >= similarity * size - 1e-6))
    members = compacted(members.join(info, "node"))

    def may_link(*bounds: str):
        needed = (F.col("size") + F.col("size_x")) * (similarity / (1 + similarity)) - 1e-6
        each = [F.least(c, f"{c}_x") >= needed for c in ("size", *bounds)]
        return (F.col("l") != F.col("l_x")) & each[0] & each[-1]

    def other(df: DataFrame, *keys: str) -> DataFrame:
        return df.select(*keys, *[F.col(c).alias(f"{c}_x") for c in df.columns if c not in keys])

    share = F.struct(F.col("shared") / size, "node", "size", "shared", "common")
    lead = compacted(members.groupBy("key").agg(F.max(share).alias("x")).select("key", "x.node", "x.size", "x.shared", "x.common"), 200_000)
    with_label = lambda df: df.join(label, "node", "left").withColumn("l", F.coalesce("label", "node")).drop("label")

    def compare(pairs: DataFrame) -> None:
        nonlocal links, n, label
        pairs = pairs.select(F.least("node", "node_x").alias("a"), F.greatest("node", "node_x").alias("b")).distinct()
        more, n_more = _verify(pairs, bags, similarity)
        if n_more:
            links, n = links.unionByName(more), n + n_more
            label = components(links, n, few_links)

    compare(with_label(members).join(other(with_label(lead), "key"), "key").where(may_link("shared")))
    own = rare.where("n > 1").drop("n").join(with_label(info), "node")
    with_rare = own.join(other(own, "token"), "token").where((F.col("node") < F.col("node_x")) & may_link("shared")).select("node", "node_x")
    members, pivots = members.where(F.col("common") >= similarity * size - 1e-6).drop("shared"), PIVOTS
    while True:
        now = with_label(members)
        parts = now.groupBy("key", "l").agg(F.count("*").alias("n"))
        main = parts.groupBy("key").agg(F.max(F.struct("n", "l")).alias("x"), F.sum("n").alias("all")).where("all > x.n")
        main = compacted(main.select("key", F.col("x.l").alias("main"), F.col("x.n").alias("inside"), "all"), 200_000)
        most, rest = main.agg(F.max("inside"), F.sum(F.col("all").cast("double") * (F.col("all") - F.col("inside")))).first()
        last = most is None or most <= pivots or rest <= left
        now = now.join(main.select("key", "main"), "key")
        outside = now.where("l <> main").drop("main")
        if last:
            every = now.withColumn("first", F.col("l") == F.col("main")).drop("main")
            once = F.col("first_x") | (F.col("node") < F.col("node_x"))
            pairs = outside.join(other(every, "key"), "key").where(may_link("common") & once)
        else:
            # the best of each cell: no task gathers a bucket
            cell = F.pmod(F.xxhash64("node", F.lit(pivots)), F.lit(pivots))
            best = now.where("l = main").groupBy("key", cell.alias("cell")).agg(F.max(F.struct(F.col("common") / size, "node", "size", "common", "l")).alias("x"))
            pairs = outside.join(other(best.select("key", "x.node", "x.size", "x.common", "x.l"), "key"), "key").where(may_link("common"))
        pairs = pairs.select("node", "node_x")
        compare(pairs if with_rare is None else pairs.unionByName(with_rare))
        if last:
            return links, label
        with_rare, pivots = None, pivots * STEP


def _labelled(stars: DataFrame, label: DataFrame) -> DataFrame:
    """key, node, l of the members of each bucket, its leader among them."""
    nodes = stars.select("key", F.col("b").alias("node")).unionByName(stars.select("key", F.col("a").alias("node")).distinct())
    return nodes.join(label, "node", "left").select("key", "node", F.coalesce("label", "node").alias("l"))


def _with_class(rows: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, h1, h2, other columns of rows but empty, and class_id."""
    joined = rows.join(found.select("h1", "h2", "class_id"), ["h1", "h2"], "left")
    return joined.withColumn("class_id", F.when(F.col("empty"), F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("class_id"))).drop("empty")


def _empty():
    return (F.coalesce(F.length("text"), F.lit(0)) == 0).alias("empty")


def members(docs: DataFrame, similarity: float = SIMILARITY, few: int = FEW_LINKS) -> DataFrame:
    """doc_id, class_id of every row of docs."""
    found, _ = classes(docs, similarity, few)
    return _with_class(_hashed(docs, _empty()), found).select("doc_id", "class_id")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class: the one whose id names it. Rows without an id stay.

    Rows that stay leave the scan as they are. Only those that go, repeated rows, and the few that
    the sieve takes for such are shuffled with their texts.
    """
    found, _ = classes(docs, similarity)
    rows = _hashed(docs.where("doc_id IS NOT NULL"), _empty()).groupBy("doc_id", "h1", "h2").agg(F.count("*").alias("n"), F.first("empty").alias("empty"))
    decided = compacted(_with_class(rows, found).select("doc_id", "h1", "h2", "n", (F.col("doc_id") == F.col("class_id")).alias("head")).where("n > 1 OR NOT head"), 500_000)
    own = free_name(docs.columns, "_own")
    names = {c: f"{own}_{c}" for c in ("doc_id", "h1", "h2")}
    keyed = docs.withColumns({names["h1"]: F.xxhash64("text"), names["h2"]: F.xxhash64(F.lit(1), "text"), names["doc_id"]: F.col("doc_id")})
    marked = decided.select(*[F.col(c).alias(n) for c, n in names.items()], F.col("head").alias(f"{own}_head"))
    flag = f"{own}_likely"
    flagged = sifted(keyed, marked, names["doc_id"], names["h1"], flag=flag)
    same = list(names.values())
    sure = flagged.where(~F.col(flag)).select(*docs.columns)
    likely = flagged.where(F.col(flag)).drop(flag)
    other = likely.join(marked, same, "left_anti").select(*docs.columns)
    first = likely.join(marked.where(f"`{own}_head`"), same, "left_semi").dropDuplicates(same).select(*docs.columns)
    return sure.unionByName(other).unionByName(first)
