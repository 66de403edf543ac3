"""Benchmark decontamination by template canonicalisation.

Texts and benchmark items become sequences of tokens in which numbers, names (a capital
before small letters) and units (after a number) are typed placeholders. A capital at the
start of a sentence may be a name or not, so each sequence is read in four ways: it is
never a name, it is one if the same word is a name elsewhere in the text, it always is
one, and, fourth, every token stands for itself without regard to capitals. Windows of
WINDOW tokens are hashed in each reading and looked up in the hash table of the
benchmark's windows in that reading; a window counts only if MIN_LITERALS of its tokens
are words in the first reading. Hits of an item on neighbouring alignments (BAND) are
put together, and their slots are checked: one value of the item must stand for one
value of the text throughout, and windows with a contradicting slot are struck out. A
document is contaminated by an item if MIN_SHARE of the item's windows remain among the
hits of such a run and all hits at most an item's length before or after it that agree
with its slots, or if hits on one alignment cover LONG_RUN tokens as they stand in the
item without a break, or twice as many with other values in the slots.

The benchmark is a query set, taken in blocks of at most BLOCK_BYTES of text; each block
is sent to the executors and run against all documents, whatever the number of blocks.

Characters of scripts without spaces are tokens of their own. An item of which no window
has MIN_LITERALS words (arithmetic, lists of names or numbers, very short items) matches
where all its tokens follow each other exactly as they are, without regard to capitals
and signs between them.

Defined cases: null or empty texts and items, and those without a letter or digit, match
nothing; an item under WINDOW tokens is one window of its own length; an item of one token
matches only where the token is a line or text of its own, since any text may hold it
elsewhere; repeated rows are judged one by one; empty tables give empty results.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from . import text as T
from .common import free_name, kept

WINDOW, MIN_LITERALS, MIN_SHARE, BAND = 5, 3, 0.5, 4
#: Tokens of an unbroken run that is enough whatever its share, and the fewest windows that can cover them.
LONG_RUN = 13
LONG_HITS = -(-LONG_RUN // WINDOW)
#: Bytes of benchmark text that are sent to the executors at once.
BLOCK_BYTES = 8 << 20
# Units of measure, lower case.
UNITS = (
    "mm cm m km in ft yd mi mile miles inch inches foot feet yard yards metre metres meter meters kilometre kilometres kilometer kilometers g kg mg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces "
    "ton tons tonne tonnes l ml litre litres liter liters gallon gallons s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years "
    "percent pct usd eur gbp dollar dollars euro euros cent cents kph mph hz khz mhz ghz w kw mw v kv b kb mb gb tb degree degrees"
).split()

_DIGIT = T.byte_table(lambda b: 48 <= b <= 57)
_STOP = T.byte_table(lambda b: chr(b) in ".!?\n")
LITERAL, NUMBER, NAME, UNIT = range(4)
_PLACE = T.mix(np.arange(11, 15, dtype=T.U))


# Code points of scripts written without spaces, and of their punctuation.
_ALONE = np.array([(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FA), (0x30FC, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF)])
_SIGNS = np.array([(0x3000, 0x3004), (0x3008, 0x303F), (0x30FB, 0x30FB), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65)])


class Tokens(NamedTuple):
    values: np.ndarray  # of the word itself
    kinds: np.ndarray  # in the first reading
    known: np.ndarray  # kinds with words at the start of a sentence that are names elsewhere in the text
    broad: np.ndarray  # kinds with all capitals as names
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray


def _unit_hashes() -> np.ndarray:
    body = " ".join(UNITS).encode()
    data = np.frombuffer(body, np.uint8)
    starts, ends, _ = T.spans(data != 32, np.array([0, len(data)]))
    return np.sort(T.span_hashes(data, starts, ends))


def _within(points: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ranges[:, 0], points, "right") - 1
    return (at >= 0) & (points <= ranges[at, 1])


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the characters that are tokens of their own; bytes of punctuation of their scripts."""
    lead = np.flatnonzero(data[:-2] >= 0xE0)
    points = ((data[lead].astype(np.int64) & 15) << 12) | ((data[lead + 1].astype(np.int64) & 63) << 6) | (data[lead + 2] & 63)
    long = data[lead] >= 0xF0
    alone = np.where(long, (data[lead] == 0xF0) & (data[lead + 1] >= 0xA0), _within(points, _ALONE))
    signs = lead[~long & _within(points, _SIGNS)]
    return np.unique(np.concatenate([lead[alone], lead[alone] + 3 + long[alone]])), (signs[:, None] + np.arange(3)).ravel()


def canonical(b: T.Block) -> Tokens:
    """Tokens are runs of letters and digits, or single characters (_ALONE); . and , inside a number belong to it."""
    low = T.lower(b.data)
    inside = T.ALNUM[b.data].copy()
    if len(low) > 2:
        point = ((b.data[1:-1] == 46) | (b.data[1:-1] == 44)) & _DIGIT[b.data[:-2]] & _DIGIT[b.data[2:]]
        inside[1:-1] |= point
    cuts, signs = _characters(b.data)
    inside[signs] = False
    starts, ends, rows = T.spans(inside, np.union1d(b.offsets, cuts) if len(cuts) else b.offsets)
    if len(cuts):
        rows = np.searchsorted(b.offsets, starts, "right") - 1
    values = T.span_hashes(low, starts, ends)
    kinds = np.zeros(len(values), np.int8)
    known, broad = kinds.copy(), kinds.copy()
    if len(values):
        digits = np.zeros(len(low) + 1, np.int64)
        np.cumsum(_DIGIT[b.data], out=digits[1:])
        number = digits[ends] > digits[starts]
        stops = np.zeros(len(low) + 1, np.int64)
        np.cumsum(_STOP[b.data], out=stops[1:])
        first = np.ones(len(values), bool)
        first[1:] = (rows[1:] != rows[:-1]) | (stops[starts[1:]] > stops[ends[:-1]])
        caps = low != b.data
        wide = b.data[starts] >= 0xC0
        capital = caps[np.minimum(starts + wide, len(low) - 1)]
        second = np.minimum(starts + 1 + wide, len(low) - 1)
        long = (ends - starts) > 1 + wide
        small = long & ~caps[second] & ~((b.data[second] >= 0xC3) & caps[np.minimum(second + 1, len(low) - 1)])
        able = capital & small & ~number
        name = able & ~first
        own = T.mix(values + rows.astype(T.U) * T.U(0x9E3779B97F4A7C15))
        units = _unit_hashes()
        at = np.minimum(np.searchsorted(units, values), len(units) - 1)
        after = np.zeros(len(values), bool)
        after[1:] = number[:-1] & (rows[1:] == rows[:-1])
        for reading, names in ((kinds, name), (known, able & np.isin(own, own[name])), (broad, able)):
            reading[names] = NAME
            reading[(units[at] == values) & after & ~number] = UNIT
            reading[number] = NUMBER
    return Tokens(values, kinds, known, broad, starts, ends, rows)


def _word(b: T.Block, t: Tokens, i: int) -> str:
    return b.data[t.starts[i] : t.ends[i]].tobytes().decode("utf-8", "replace")


class Index(NamedTuple):
    """Windows of the items of one block, sorted by hash; by length of window."""

    items: list
    totals: np.ndarray  # windows of each item
    exact: np.ndarray  # must all of them be there, in their order
    kinds: list[np.ndarray]  # with all capitals as names
    words: list[list[str]]
    tables: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]]  # length, reading: hashes, items, places


READINGS = range(4)


def _windows(t: Tokens, k: int, reading: int) -> tuple[np.ndarray, np.ndarray]:
    typed = (t.kinds, t.known, t.broad, t.kinds)[reading]
    exact = reading == 3
    keys, at = T.windows(t.values if exact else np.where(typed == LITERAL, t.values, _PLACE[typed]), t.rows, k)
    if exact:
        return keys, at
    literal = np.zeros(len(typed) + 1, np.int64)
    np.cumsum(typed == LITERAL, out=literal[1:])
    enough = literal[at + k] - literal[at] >= MIN_LITERALS
    return keys[enough], at[enough]


def build_index(items: list, texts: list[str]) -> Index:
    column = pa.array(texts, pa.string())
    totals, exact, kinds, words, tables = [], [], [], [], defaultdict(list)
    for b in T.blocks(column):
        t = canonical(b)
        bounds = np.searchsorted(t.rows, np.arange(b.n + 1))
        for r in range(b.n):
            lo, hi = bounds[r], bounds[r + 1]
            own = Tokens(*(x[lo:hi] for x in t))
            k = min(WINDOW, hi - lo)
            counted = _windows(own, k, 0)[1] if k >= MIN_LITERALS else np.zeros(0, np.int64)
            exact.append(not len(counted))
            for reading in READINGS:
                if k and not len(counted) and reading == 3:
                    keys, at = _windows(own, k, reading)
                    tables[k, reading].append((keys, np.full(len(keys), len(totals)), at))
                    counted = at
                elif not exact[-1]:
                    keys, at = _windows(own, k, reading)
                    some = np.isin(at, counted)
                    tables[k, reading].append((keys[some], np.full(some.sum(), len(totals)), at[some]))
            totals.append(len(counted))
            kinds.append(own.broad)
            words.append([_word(b, t, i) for i in range(lo, hi)])
    done = {}
    for way, found in tables.items():
        keys, of, at = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(keys, kind="stable")
        if len(keys):
            done[way] = keys[order], of[order], at[order]
    return Index(items, np.array(totals), np.array(exact), kinds, words, done)


def _lookup(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in keys, place in table) of equal hashes."""
    bits = np.zeros(1 << 20, bool)
    bits[table & T.U((1 << 20) - 1)] = True
    some = np.flatnonzero(bits[keys & T.U((1 << 20) - 1)])
    lo, hi = np.searchsorted(table, keys[some], "left"), np.searchsorted(table, keys[some], "right")
    n = hi - lo
    at = np.repeat(some, n)
    return at, np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else lo, n) + np.arange(len(at))


def _lines(b: T.Block, t: Tokens) -> np.ndarray:
    """Is a token a line of its own?"""
    breaks = np.zeros(len(b.data) + 1, np.int64)
    np.cumsum((b.data == 10) | (b.data == 13), out=breaks[1:])
    cut = np.ones(len(t.values) + 1, bool)
    cut[1:-1] = (t.rows[1:] != t.rows[:-1]) | (breaks[t.starts[1:]] > breaks[t.ends[:-1]])
    return cut[1:] & cut[:-1]


def _judge(b: T.Block, t: Tokens, index: Index, item: int, hits: list[tuple[int, int, int]], need: float, band: int, whole: bool) -> tuple[int, dict[str, str]] | None:
    """Windows and substitutions of the best set of hits (diagonal, place in text, in item) of an item in a row, if they are enough."""
    kinds, words = index.kinds[item], index.words[item]
    k = min(WINDOW, len(words))
    known: dict[tuple[int, int], list] = {}

    def slots(hit: tuple[int, int, int]) -> list:
        _, i, j = hit
        if (i, j) not in known:
            known[i, j] = [((int(kinds[j + s]), words[j + s].lower()), _word(b, t, i + s).lower()) for s in range(k) if kinds[j + s] != LITERAL]
        return known[i, j]

    def vote(some: list, fixed: dict) -> dict:
        """fixed, and for other slots the value that most hits have."""
        votes: dict[tuple[int, str], dict[str, int]] = defaultdict(lambda: defaultdict(int))
        for hit in some:
            for a, v in slots(hit):
                votes[a][v] += 1
        return {a: max(sorted(v), key=v.__getitem__) for a, v in votes.items()} | fixed

    def agreeing(some: list, chosen: dict) -> list:
        return [hit for hit in some if all(chosen.get(a, v) == v for a, v in slots(hit))]

    best, enough, substitutions = 0, False, {}

    def take(some: list, chosen: dict, long: bool = False) -> None:
        nonlocal best, enough, substitutions
        n = len({j for _, _, j in some})
        if n > best:
            best, substitutions = n, {a[1]: v for a, v in chosen.items() if a[1] != v}
        enough |= long or n >= need

    hits.sort()
    runs, lo = [], 0
    for n in range(1, len(hits) + 1):
        if n == len(hits) or hits[n][0] - hits[n - 1][0] > band:
            runs.append(hits[lo:n])
            lo = n
    by_place = sorted(hits, key=lambda hit: hit[1:])
    places = [i for _, i, _ in by_place]
    for run in runs:
        if whole or len({j for _, _, j in run}) >= need:
            chosen = vote(run, {})
            take(agreeing(run, chosen), chosen)
        if whole:
            continue
        lo = 0
        for n in range(1, len(run) + 1):
            if n == len(run) or run[n][0] != run[n - 1][0] or run[n][1] - run[n - 1][1] > k:
                if run[n - 1][2] - run[lo][2] + k >= LONG_RUN:
                    chosen = vote(run[lo:n], {})
                    for values, length in (({a: a[1] for a in chosen}, LONG_RUN), (chosen, 2 * LONG_RUN)):
                        good, first = agreeing(run[lo:n], values), 0
                        for x in range(1, len(good) + 1):
                            if x == len(good) or good[x][1] - good[x - 1][1] > k:
                                if good[x - 1][2] - good[first][2] + k >= length:
                                    take(good[first:x], values, True)
                                first = x
                lo = n
    if not whole:
        for run in runs:
            if best == index.totals[item]:
                break
            near = by_place[bisect_left(places, min(i for _, i, _ in run) - len(words)) : bisect_right(places, max(i for _, i, _ in run) + len(words))]
            if len(near) > len(run) and len({j for _, _, j in near}) >= max(need, best + 1):
                chosen = vote(run, {})
                near = agreeing(near, chosen)
                chosen = vote(near, chosen)
                take(agreeing(near, chosen), chosen)
    return (best, substitutions) if enough else None


def match_block(b: T.Block, index: Index) -> list[tuple]:
    """(row, item, windows, matched, share, substitutions) of the contaminated rows of a block."""
    t = canonical(b)
    found = [np.zeros((3, 0), np.int64)]
    for (k, reading), (table, of, places) in index.tables.items():
        keys, at = _windows(t, k, reading)
        if k == 1:
            alone = _lines(b, t)[at]
            keys, at = keys[alone], at[alone]
        here, there = _lookup(keys, table)
        found.append(np.stack([of[there], at[here], places[there]]))
    of, at, places = np.concatenate(found, axis=1)
    rows = t.rows[at]
    order = np.lexsort((places, at, of, rows))
    rows, of, at, places = (x[order] for x in (rows, of, at, places))
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (of[1:] != of[:-1]) | (at[1:] != at[:-1]) | (places[1:] != places[:-1])
    rows, of, at, places = (x[fresh] for x in (rows, of, at, places))
    bounds = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (of[1:] != of[:-1]), [True]])) if len(rows) else np.zeros(1, np.int64)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        row, item = int(rows[lo]), int(of[lo])
        total = int(index.totals[item])
        whole = bool(index.exact[item])
        need = total if whole else MIN_SHARE * total
        least = need if whole else min(need, LONG_HITS)
        if hi - lo < least:
            continue
        hits = [(i - j, i, j) for i, j in zip(at[lo:hi].tolist(), places[lo:hi].tolist(), strict=True)]
        if len({j for _, _, j in hits}) < least:
            continue
        judged = _judge(b, t, index, item, hits, need, 0 if whole else BAND, whole)
        if judged:
            best, substitutions = judged
            out.append((row, item, total, best, best / total, [f"{a}={v}" for a, v in sorted(substitutions.items())]))
    return out


def query_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text"):
    """Indexes of the benchmark, a bounded block at a time."""
    rows = benchmark.where(F.col(text).isNotNull()).select(F.col(item_id).alias("item"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    for i in range(n):
        block = sorted((tuple(r) for r in rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == i).collect()), key=str)
        if block:
            yield build_index([r[0] for r in block], [r[1] for r in block])


def contaminated(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """doc_id, keep, item_id, n_windows, n_matched, share, substitutions: a row a contaminated document and item."""
    keep = ["doc_id", *kept(keep, "doc_id", "item_id", "n_windows", "n_matched", "share", "substitutions")]
    source = docs.select(*keep, F.col("text").alias(free_name(keep, "_text")))
    item_type = benchmark.schema["item_id"].dataType
    schema = source.schema[: len(keep)].add("item_id", item_type).add("n_windows", "long").add("n_matched", "long").add("share", "double").add("substitutions", ArrayType(StringType()))
    out = None
    for index in query_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            own = shared.value
            for batch in batches:
                for b in T.blocks(batch.columns[-1]):
                    found = match_block(b, own)
                    if found:
                        rows = pa.array([b.rows.start + r[0] for r in found])
                        part = batch.take(rows).columns[:-1]
                        item = pa.array([own.items[r[1]] for r in found])
                        rest = (pa.array([r[2] for r in found], pa.int64()), pa.array([r[3] for r in found], pa.int64()), pa.array([r[4] for r in found]), pa.array([r[5] for r in found], pa.list_(pa.string())))
                        yield pa.RecordBatch.from_arrays([*part, item, *rest], [*keep, "item_id", "n_windows", "n_matched", "share", "substitutions"])

        found = source.mapInArrow(T.tidy(run), schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that no benchmark item contaminates, with all their columns."""
    at = docs.columns.index("text")
    for index in query_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for batch in batches:
                bad = np.zeros(batch.num_rows, bool)
                for b in T.blocks(batch.column(at)):
                    for r in match_block(b, shared.value):
                        bad[b.rows.start + r[0]] = True
                yield batch.filter(pa.array(~bad))

        docs = docs.mapInArrow(T.tidy(run), docs.schema)
    return docs
