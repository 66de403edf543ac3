"""Vectorised text primitives over Arrow string columns.

A block is a run of rows whose UTF-8 bytes lie in one flat uint8 array with int64
row offsets, so tokenising and hashing cost a few numpy passes per block and no
Python object per word. Blocks hold about BLOCK_BYTES; one longer row makes a block
of its own, and no text is cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BLOCK_BYTES = 1 << 20
U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
#: Another base for rolling hashes.
SECOND = 0xD6E8FEB86659FD93


class Block(NamedTuple):
    rows: slice
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def blocks(column, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of a string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, ends, body = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield Block(slice(lo, hi), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def byte_table(pattern) -> np.ndarray:
    """True for the bytes for which pattern(byte) holds."""
    return np.array([bool(pattern(b)) for b in range(256)])


#: Bytes of words: all but ASCII white space; ASCII letters, digits and all non-ASCII.
NON_SPACE = byte_table(lambda b: b not in b" \t\n\x0b\x0c\r")
ALNUM = byte_table(lambda b: b >= 0x80 or chr(b).isalnum())


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit integers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def lower(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals to small letters, byte for byte."""
    out = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    if len(data) > 1:
        second = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:] += second.astype(np.uint8) * np.uint8(32)
    return out


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal runs where inside holds; none crosses a row."""
    n = len(inside)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _powers(base: int, n: int) -> np.ndarray:
    x = np.full(n, U(base))
    if n:
        x[0] = U(1)
    return np.cumprod(x)


_CACHE: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    if len(_CACHE.get(base, ())) < n:
        if n > 2 * BLOCK_BYTES:
            return _powers(base, n)
        _CACHE[base] = _powers(base, n)
    return _CACHE[base][:n]


#: Spans of more bytes are hashed one by one, not eight bytes of all spans at a time.
LONG_SPAN = 64


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, eight at a time, each step mixed; no polynomial, since
    those modulo 2**64 agree on long strings of a simple make (Thue-Morse)."""
    size = ends - starts
    out = mix(size.astype(U) * U(_BASE))
    buffer = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(buffer) - 7,), "<u8", buffer, 0, (1,))
    live = np.flatnonzero((size > 0) & (size <= LONG_SPAN))
    at, left = starts[live], size[live]
    while len(live):
        word = words[at]
        short = np.flatnonzero(left < 8)
        word[short] &= (U(1) << (left[short].astype(U) * U(8))) - U(1)
        out[live] = mix(out[live] ^ word)
        more = np.flatnonzero(left > 8)
        live, at, left = live[more], at[more] + 8, left[more] - 8
    far = np.flatnonzero(size > LONG_SPAN)
    if len(far):
        body = memoryview(data)
        own = [xxhash.xxh3_64_intdigest(body[a:b]) for a, b in zip(starts[far].tolist(), ends[far].tolist(), strict=True)]
        out[far] = mix(out[far] ^ np.array(own, U))
    return out


def rolling_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """A 64-bit hash of each of many overlapping spans: a polynomial modulo 2**64, then mixed with the
    length. Equal hashes are to be confirmed by the bytes."""
    total = np.zeros(len(data) + 1, U)
    np.cumsum((mix_bytes()[data]) * powers(base, len(data)), out=total[1:])
    own = (total[ends] - total[starts]) * powers(pow(base, -1, 1 << 64), len(data) + 1)[starts]
    return mix(own ^ (ends - starts).astype(U))


_BYTES: list[np.ndarray] = []


def mix_bytes() -> np.ndarray:
    if not _BYTES:
        _BYTES.append(mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95)))
    return _BYTES[0]


def windows(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every k consecutive words of one row, and the index of the first word of each."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    at = np.flatnonzero(rows[:n] == rows[k - 1 :])
    out = np.zeros(len(at), U)
    for j in range(k):
        out = out * U(_BASE) + hashes[at + j]
    return mix(out), at


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: is it one of equal keys but the one that is kept; is there an equal one at all."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    later, any_ = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    any_[order[1:]] = same
    any_[order[:-1]] |= same
    return later, any_


def sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of values by row."""
    return np.bincount(rows, weights=values, minlength=n).astype(np.int64) if len(rows) else np.zeros(n, np.int64)


def row_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of one flag a byte by row."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def tidy(run: Callable) -> Callable:
    """run over a partition's batches, after which the worker, which may stay idle for a while, gives
    its free memory back to the system."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            library = ctypes.CDLL(None)
            if hasattr(library, "malloc_trim"):
                library.malloc_trim(0)

    return wrapped
