"""Chat formatting by minimum-cost role repair.

A legal conversation is an optional system message, then user and assistant by turns,
from a user to an assistant. A dynamic program over that automaton takes each turn as a
message of its own role (free), of another role (RELABEL), or as a part of the message
before it (MERGE, with RELABEL if the role differs), and may put empty messages in
between (INSERT each), at the least total cost; of equal paths, read from the end, the
one through the earlier state in the order start, system, user, assistant is taken.

A conversation may hold most of all rows, so it is never gathered. Turns are range
partitioned by conversation and turn and written once. A partition's first and last
conversations may go on in its neighbours: for these, one (min, +) matrix a partition is
chained into the costs at which each partition is entered, then the ways back from each
state are chained into the states where it is left. The driver holds these few numbers
a partition, and each partition renders its own turns.

The result has a row a turn; a conversation's pieces in order of position are its text.
"<|" inside a text gets a backslash (so does "<\\|" and so on), so texts cannot forge the
template, and unrendered() gives back the messages.

Defined cases: a null text is empty; a null or unknown role is relabelled, at no other
cost than RELABEL; turns of equal number are ordered by role and text; a null number
comes first; a null conversation is one of its own; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import text as T
from .common import checkpointed, parts

START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = ("", "system", "user", "assistant")
# Other names of the roles.
ALIASES = {"system": 1, "developer": 1, "user": 2, "human": 2, "prompter": 2, "assistant": 3, "gpt": 3, "bot": 3, "model": 3, "ai": 3}
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MERGE, RELABEL, INSERT = 2, 3, 4
FAR = 1 << 60
#: Bytes of turns in a partition, about.
PART_BYTES = 64 << 20


class Step(NamedTuple):
    cost: int
    before: int
    inserted: tuple[int, ...]
    merged: bool


def _insertions() -> list[list[tuple[int, tuple[int, ...]] | None]]:
    """Cheapest run of empty messages from each state to each."""
    out: list[list] = []
    for s in range(4):
        best: list = [None] * 4
        best[s] = (0, ())
        todo = [s]
        while todo:
            a = todo.pop(0)
            for b in NEXT[a]:
                if best[b] is None:
                    best[b] = (best[a][0] + INSERT, (*best[a][1], b))
                    todo.append(b)
        out.append(best)
    return out


_INSERTED = _insertions()


def _steps(role: int) -> list[list[Step | None]]:
    """[before][after]: the cheapest way to take a turn of this role; merging comes first among equals."""
    out: list[list[Step | None]] = [[None] * 4 for _ in range(4)]
    for s in range(4):
        for t in (SYSTEM, USER, ASSISTANT):
            change = 0 if t == role else RELABEL
            options = [Step(MERGE + change, s, (), True)] if s == t else []
            options += [Step(_INSERTED[s][a][0] + change, s, _INSERTED[s][a][1], False) for a in range(4) if _INSERTED[s][a] is not None and t in NEXT[a]]
            out[s][t] = min(options, key=lambda x: (x.cost, not x.merged, len(x.inserted)), default=None)
    return out


STEPS = [_steps(r) for r in range(4)]  # 0: a role of no known name
_MOVES = [[[(s, STEPS[r][s][t].cost) for s in range(4) if STEPS[r][s][t] is not None] for t in range(4)] for r in range(4)]


def forward(roles, entry: list[int]) -> list[list[int]]:
    """Least costs of the four states before the first turn and after each."""
    rows = [entry]
    for r in roles:
        last = rows[-1]
        rows.append([min((last[s] + c for s, c in _MOVES[r][t]), default=FAR) for t in range(4)])
    return rows


def backward(roles, rows: list[list[int]], state: int) -> list[Step]:
    """The steps that end in state; the earliest state wins among equals."""
    out = []
    for i in range(len(roles) - 1, -1, -1):
        before = min(((rows[i][s] + c, s) for s, c in _MOVES[roles[i]][state]))[1]
        out.append(STEPS[roles[i]][before][state])
        state = before
    return out[::-1]


def matrix(roles) -> list[list[int]]:
    return [forward(roles, [0 if s == a else FAR for s in range(4)])[-1] for a in range(4)]


def ending(row: list[int]) -> tuple[int, tuple[int, ...], int]:
    """State after the last turn, empty messages after it, and total cost."""
    cost, state = min((row[s] + _INSERTED[s][ASSISTANT][0], s) for s in range(4) if row[s] < FAR)
    return state, _INSERTED[state][ASSISTANT][1], cost


ENTRY = [0, FAR, FAR, FAR]


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unrendered(text: str) -> list[tuple[str, str]]:
    """The messages of a rendered conversation."""
    found = re.findall(r"<\|(system|user|assistant)\|>\n(.*?)<\|end\|>\n", text, re.S)
    return [(role, re.sub(r"<\\(\\*)\|", r"<\1|", body)) for role, body in found]


def _empty(roles: tuple[int, ...]) -> str:
    return "".join(f"<|{NAMES[r]}|>\n<|end|>\n" for r in roles)


def _code(role: str | None) -> int:
    return ALIASES.get((role or "").strip().lower(), 0)


class Fragment(NamedTuple):
    conv: object
    first: bool  # of its partition
    last: bool
    rows: list


def fragments(batches, width: int):
    """Runs of one conversation in a partition; rows are tuples of the columns after the first (conv_id)."""
    conv, rows, first, seen = None, [], True, False
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[1:width]]
        for i, key in enumerate(batch.column(0).to_pylist()):
            if seen and key != conv:
                yield Fragment(conv, first, False, rows)
                first, rows = False, []
            conv, seen = key, True
            rows.append(tuple(c[i] for c in columns))
    if seen:
        yield Fragment(conv, first, True, rows)


def arranged(turns: DataFrame) -> DataFrame:
    """part, conv_id, turn, role, text: range partitioned, in order, and written once."""
    rows = turns.select("conv_id", "turn", "role", "text").withColumn("_copy", F.monotonically_increasing_id())  # equal rows may be parted, in any order
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.xxhash64("text"), F.col("text").asc_nulls_first(), "_copy"]
    keys = [*order[:4], order[5]]
    size = turns.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    placed = rows.repartitionByRange(max(parts(turns.sparkSession), -(-size // PART_BYTES)), *keys).sortWithinPartitions(*order)
    return checkpointed(placed.select(F.spark_partition_id().alias("part"), "conv_id", "turn", "role", "text"))


def _open_fragments(placed: DataFrame, make, schema: dict):
    """Rows (first, last, conversation, what make(part, fragment) returns) of the at most two open fragments of each partition."""
    source = placed.select("conv_id", "role", "part")
    fields = pa.schema({"part": pa.int32(), "first": pa.bool_(), "last": pa.bool_(), "conv": pa.string(), **{c: pa.list_(pa.int64()) if t.startswith("array") else pa.int64() for c, t in schema.items()}})
    columns = ", ".join(f"{c} {t}" for c, t in schema.items())

    def run(batches):
        for f in fragments(batches, 3):
            if f.first or f.last:
                out = make(f.rows[0][1], f, [_code(r[0]) for r in f.rows])
                yield pa.RecordBatch.from_pylist([{"part": f.rows[0][1], "first": f.first, "last": f.last, "conv": None if f.conv is None else str(f.conv), **out}], fields)

    found = source.mapInArrow(T.tidy(run), f"part int, first boolean, last boolean, conv string, {columns}").collect()  # at most two rows a partition
    return sorted(found, key=lambda r: (r["part"], not r["first"]))


def _joins(a, b) -> bool:
    """Does fragment b go on where fragment a ended?"""
    return a is not None and a["last"] and b["first"] and a["conv"] == b["conv"] and a["part"] != b["part"]


def repair(turns: DataFrame) -> DataFrame:
    """A row a turn: conv_id, turn, position, role, new_role, action, message, cost, piece.

    action is keep, relabel, merge or merge+relabel, with +insert for empty messages before
    it and +append for those after it; cost adds up to that of the conversation.
    """
    placed = arranged(turns)
    first_pass = _open_fragments(placed, lambda part, f, roles: {"n": len(roles), "m": [x for row in matrix(roles) for x in row]}, {"n": "bigint", "m": "array<bigint>"})
    entries: dict[tuple[int, bool], tuple[list[int], int]] = {}
    last, costs, position = None, ENTRY, 0
    for r in first_pass:
        if not _joins(last, r):
            costs, position = ENTRY, 0
        entries[r["part"], r["first"]] = costs, position
        m = r["m"]
        costs, position = [min(min(costs[s] + m[4 * s + t] for s in range(4)), FAR) for t in range(4)], position + r["n"]
        last = r

    def ways_back(part, f, roles):
        rows = forward(roles, entries[part, f.first][0])
        back, new = [], []
        for t in range(4):
            steps = backward(roles, rows, t) if rows[-1][t] < FAR else []
            back.append(steps[0].before if steps else -1)
            new.append(sum(len(s.inserted) + (not s.merged) for s in steps))
        return {"row": rows[-1], "back": back, "new": new}

    second = _open_fragments(placed, ways_back, dict.fromkeys(("row", "back", "new"), "array<bigint>"))
    exits: dict[tuple[int, bool], tuple[int, bool]] = {}
    messages: dict[tuple[int, bool], int] = {}
    state = START
    for i in range(len(second) - 1, -1, -1):
        r = second[i]
        goes_on = i + 1 < len(second) and _joins(r, second[i + 1])
        if not goes_on:
            state = ending(list(r["row"]))[0]
        exits[r["part"], r["first"]] = state, not goes_on
        state = r["back"][state]
    count = 0
    for i, r in enumerate(second):
        count = count if i and _joins(second[i - 1], r) else 0
        messages[r["part"], r["first"]] = count
        count += r["new"][exits[r["part"], r["first"]][0]]
    shared = turns.sparkSession.sparkContext.broadcast((entries, exits, messages))  # a few numbers a partition

    def run(batches):
        entries, exits, messages = shared.value
        for f in fragments(batches, 5):
            part = f.rows[0][3]
            key = (part, f.first)
            known = f.first or f.last
            entry, position = entries[key] if known else (ENTRY, 0)
            roles = [_code(r[1]) for r in f.rows]
            rows = forward(roles, entry)
            state, ends = exits[key] if known else (ending(rows[-1])[0], True)
            message = messages[key] if known else 0
            out = []
            steps = backward(roles, rows, state)
            for i, (r, s) in enumerate(zip(f.rows, steps, strict=True)):
                after = steps[i + 1].before if i + 1 < len(steps) else state
                action = "merge" if s.merged else "keep"
                if roles[i] != after:
                    action = "merge+relabel" if s.merged else "relabel"
                piece = "\n\n" if s.merged else ("<|end|>\n" if message else "") + _empty(s.inserted) + f"<|{NAMES[after]}|>\n"
                if s.inserted:
                    action += "+insert"
                message += len(s.inserted) + (not s.merged)
                piece += escaped(r[2] or "")
                cost = s.cost
                own = message - 1
                if ends and i + 1 == len(steps):
                    _, more, _ = ending([0 if t == state else FAR for t in range(4)])
                    piece += "<|end|>\n" + _empty(more)
                    cost += INSERT * len(more)
                    if more:
                        action += "+append"
                out.append((f.conv, r[0], position + i, r[1], NAMES[after], action, own, cost, piece))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)

    source = placed.select("conv_id", "turn", "role", "text", "part")
    schema = source.select("conv_id", "turn").schema.add("position", "long").add("role", "string").add("new_role", "string").add("action", "string").add("message", "long").add("cost", "long").add("piece", "string")
    names = schema.names
    types = [to_arrow_type(f.dataType) for f in schema]
    return source.mapInArrow(T.tidy(run), schema)
