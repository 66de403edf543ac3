"""Exact removal of long repeated byte strings, by a difference cover.

A byte goes if it lies in a string of LENGTH bytes that also starts earlier: in a text
of smaller id, or earlier in the same text. Sorting all suffixes would move every one
of them; a difference cover needs only a sample. The residues COVER modulo PERIOD
differ by every residue, so for any two equal strings at p and q some k < PERIOD puts
both p + k and q + k into the sample, and there SAMPLE = LENGTH - PERIOD + 1 bytes are
equal too.

1. Texts are packed into chunks, which are written once and have fixed numbers.
2. Each chunk ranks its cover samples (hash of SAMPLE bytes, by bucket of the hash,
   sorted, as packed differences); a bucket at a time, samples tied with another
   chunk's are found. Their number of bits grows with the corpus.
3. Only suffixes that reach a tied sample can tie over LENGTH bytes. The text around
   each tied sample goes to the bucket of the sample; a bucket at a time, its suffixes
   are sorted by the hash of LENGTH bytes and all but the first of equal ones are
   marked. Equal surroundings within a chunk are settled there, and only the first
   leaves it.
4. Marks return to their chunks, where bytes are removed.

Memory is bounded by a chunk or a bucket. A sample tied in over HOT_CHUNKS chunks (a
passage of very many texts) would fill one bucket; its suffixes are dealt by their own
hash instead, one for each distinct suffix of a chunk.

Suffixes are grouped by 64-bit hashes within a bucket and confirmed by their bytes (hot ones
by a second hash), not compared in lexicographic order: removal needs ties, not ranks among
different strings. Residues are counted from
a start that differs by text, so that copies tie in one sample a period, not in all.

Defined cases: a null text is empty; texts under LENGTH bytes lose nothing; rows of
equal id are not earlier than each other; rows without an id come last; an empty table
gives an empty result. Text that ends up cut inside a character stays as bytes.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import checkpointed

LENGTH, PERIOD = 100, 73
# A perfect difference set modulo 73.
COVER = np.array([0, 1, 3, 7, 15, 31, 36, 54, 63])
SAMPLE = LENGTH - PERIOD + 1
REACH = PERIOD - 1
CHUNK_BYTES, BUCKET_BYTES, HOT_CHUNKS = 4 << 20, 4 << 20, 512
#: Most buckets, as a power of two: BUCKET_BYTES each up to 64 TB, and 6 MB at 100 TB.
MAX_BITS = 24
_NO_ID = np.iinfo(np.int64).max
_FIELDS = "chunk bigint, kind int, bucket int, payload binary"
TIED, COPIES, HOT, SPANS, SUFFIXES = range(5)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes, compressed: the high bytes of small numbers vanish."""
    parts = [np.array([len(arrays), *(x for a in arrays for x in (len(a), a.itemsize))], np.int64).tobytes()]
    parts += [np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(blob: bytes, *types) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, 2 * n, 8).reshape(n, 2)
    at, out = 8 + 16 * n, []
    for (length, width), kind in zip(sizes.tolist(), types, strict=True):
        planes = np.frombuffer(raw, np.uint8, length * width, at).reshape(width, length)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel() if length else np.zeros(0, kind))
        at += length * width
    return out


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=T.U(0)).astype(T.U))


def _unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpack(blob, T.U)[0], dtype=T.U)


class Chunk:
    """A run of texts: their ids, ends, hashes and bytes."""

    def __init__(self, ids, nulls, offsets, keys, data):
        self.ids, self.nulls, self.offsets, self.keys, self.data = ids, nulls, offsets, keys, data

    @classmethod
    def load(cls, meta: bytes, blob: bytes) -> Chunk:
        ids, nulls, offsets, a, b = _unpack(meta, np.int64, bool, np.int64, T.U, T.U)
        data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8) if len(blob) else np.zeros(0, np.uint8)
        return cls(ids, nulls, offsets, (a, b), data)

    def copies(self) -> np.ndarray:
        """Is an equal text of smaller id in the chunk?"""
        order = np.lexsort((self.ids, self.keys[1], self.keys[0]))
        a, b = (k[order] for k in self.keys)
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        out = np.zeros(len(order), bool)
        out[order] = self.ids[order] > self.ids[order][first]
        return out

    def samples(self, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the cover samples, their texts and hashes; texts in skip and those under LENGTH have none."""
        size = np.diff(self.offsets)
        texts = np.flatnonzero((size >= LENGTH) & ~skip)
        if not len(texts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, T.U)
        phase = (T.mix(self.ids[texts].view(T.U) + T.U(1)) % T.U(PERIOD)).astype(np.int64)
        periods = (size[texts] + phase) // PERIOD + 1
        of = np.repeat(texts, periods)
        n = np.arange(len(of)) - np.repeat(np.cumsum(periods) - periods, periods)
        start = n * PERIOD - np.repeat(phase, periods)
        within = (start[:, None] + COVER[None, :]).ravel()
        of = np.repeat(of, len(COVER))
        good = (within >= 0) & (within + SAMPLE <= size[of])
        of, at = of[good], within[good] + self.offsets[of[good]]
        return at, of, sample_hashes(self.data, at)


def sample_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the SAMPLE = 28 bytes at each place, by unaligned loads."""
    buffer = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(buffer) - 7,), "<u8", buffer, 0, (1,))
    out = np.full(len(at), T.U(0x9E3779B97F4A7C15))
    for shift in (0, 8, 16, SAMPLE - 8):
        out = T.mix(out ^ words[at + shift])
    return out


def pack_texts(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """chunk, n_bytes, meta, blob."""
    source = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text"), F.xxhash64(F.lit(1), "text"), F.col("text")).toDF("a", "b", "c", "text")

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for b in T.blocks(batch.column(3), chunk_bytes):
                ids = batch.column(0).slice(b.rows.start, b.n)
                nulls = ids.is_null().to_numpy(zero_copy_only=False)
                keys = [batch.column(i).slice(b.rows.start, b.n).to_numpy(zero_copy_only=False).view(T.U) for i in (1, 2)]
                meta = _pack(ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False).astype(np.int64), nulls, b.offsets.astype(np.int64), *keys)
                blob = zstandard.ZstdCompressor(level=3).compress(b.data.tobytes())
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([(part << 32) | n], pa.int64()), "n_bytes": pa.array([len(b.data)], pa.int64()), "meta": pa.array([meta], pa.binary()), "blob": pa.array([blob], pa.binary())})
                n += 1

    return source.mapInArrow(T.tidy(run), "chunk bigint, n_bytes bigint, meta binary, blob binary")


def _rows(found: list[tuple]):
    chunk, kind, bucket, payload = zip(*found, strict=True)
    return pa.RecordBatch.from_pydict({"chunk": pa.array(chunk, pa.int64()), "kind": pa.array(kind, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "payload": pa.array(payload, pa.binary())})


def _by_bucket(values: np.ndarray, bits: int):
    """Bucket numbers (top bits) and slices of sorted 64-bit values."""
    if not len(values):
        return []
    bucket = (values >> T.U(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    return list(zip(bucket[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(values)], strict=True))


def _cover(chunks: DataFrame, bits: int, kept: int) -> DataFrame:
    """Step 2, by chunk: the kept top bits of the samples' hashes, and the texts' hashes, by bucket."""

    def run(batches):
        for batch in batches:
            for number, meta, blob in zip(*(batch.column(c).to_pylist() for c in ("chunk", "meta", "blob")), strict=True):
                c = Chunk.load(meta, blob)
                local = c.copies()
                _, _, hashes = c.samples(local)
                values = np.unique(hashes >> T.U(64 - kept))
                shift = T.U(64 - kept)
                found = [(number, TIED, int(i), _pack_sorted(values[lo:hi])) for i, lo, hi in _by_bucket(values << shift, bits)]
                own = np.flatnonzero(~local)
                own = own[np.argsort(c.keys[0][own])]
                found += [(number, COPIES, int(i), _pack(c.keys[0][own[lo:hi]], c.keys[1][own[lo:hi]], c.ids[own[lo:hi]], own[lo:hi].astype(np.uint32))) for i, lo, hi in _by_bucket(c.keys[0][own], bits)]
                if found:
                    yield _rows(found)

    return chunks.mapInArrow(T.tidy(run), _FIELDS)


def _tied_in_bucket(pdf: pd.DataFrame, hot_chunks: int = HOT_CHUNKS) -> pd.DataFrame:
    """Of the samples of a bucket: those in several chunks, by chunk; texts that equal one of smaller id."""
    out = []
    bucket = int(pdf["bucket"].iloc[0])
    own = pdf[pdf["kind"] == TIED]
    if len(own):
        values = [_unpack_sorted(x) for x in own["payload"]]
        ordered = np.sort(np.concatenate(values))
        again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        count = np.searchsorted(ordered, again, "right") - np.searchsorted(ordered, again, "left")
        for number, v in zip(own["chunk"], values, strict=True):
            at = np.minimum(np.searchsorted(again, v), max(0, len(again) - 1))
            tied = (again[at] == v) if len(again) else np.zeros(len(v), bool)
            many = tied & (count[at] > hot_chunks) if len(again) else tied
            for kind, chosen in ((TIED, tied & ~many), (HOT, many)):
                if chosen.any():
                    out.append((number, kind, bucket, _pack_sorted(v[chosen])))
    own = pdf[pdf["kind"] == COPIES]
    if len(own):
        parts = [_unpack(x, T.U, T.U, np.int64, np.uint32) for x in own["payload"]]
        of = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        a, b, ids, rows = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((ids, b, a))
        new = np.ones(len(order), bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        copy = np.zeros(len(order), bool)
        copy[order] = ids[order] > ids[order][first]
        numbers = own["chunk"].to_numpy()
        for i in np.unique(of[copy]):
            out.append((numbers[i], COPIES, bucket, _pack(rows[copy & (of == i)])))
    return pd.DataFrame(out, columns=["chunk", "kind", "bucket", "payload"])


def _surroundings(joined: DataFrame, bits: int, kept: int) -> DataFrame:
    """Step 3, by chunk: text around tied samples by bucket; what is settled in the chunk, as spans."""

    def run(batches):
        for batch in batches:
            for number, meta, blob, found in zip(*(batch.column(c).to_pylist() for c in ("chunk", "meta", "blob", "found")), strict=True):
                rows = _around(number, Chunk.load(meta, blob), found or [], bits, kept)
                if rows:
                    yield _rows(rows)

    return joined.mapInArrow(T.tidy(run), _FIELDS)


def _first_of_equal(keys: np.ndarray, ids: np.ndarray, rows: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items with a 64-bit key: the later ones that a first one settles (smaller id, or the same
    row and an earlier place); and those to send on (all others)."""
    order = np.lexsort((places, rows, ids, keys))
    k = keys[order]
    new = np.ones(len(order), bool)
    new[1:] = k[1:] != k[:-1]
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    settled = np.zeros(len(order), bool)
    settled[order] = (ids[order] > ids[first]) | ((rows[order] == rows[first]) & (places[order] > places[first]))
    return settled, ~settled


def _around(number: int, c: Chunk, found: list[dict], bits: int, kept: int) -> list[tuple]:
    size = np.diff(c.offsets)
    copy = c.copies()
    for x in found:
        if x["kind"] == COPIES:
            copy[_unpack(x["payload"], np.uint32)[0]] = True
    gone = np.flatnonzero(copy & (size >= LENGTH))
    spans = [(gone, np.zeros(len(gone), np.int64), size[gone])]
    out: list[tuple] = []
    at, of, hashes = c.samples(copy)
    if len(at):
        short = hashes >> T.U(64 - kept)
        tied = np.zeros(len(at), bool)
        hot = np.zeros(len(at), bool)
        for kind, flag in ((TIED, tied), (HOT, hot)):
            lists = [_unpack_sorted(x["payload"]) for x in found if x["kind"] == kind]
            if lists:
                values = np.sort(np.concatenate(lists))
                flag[:] = values[np.minimum(np.searchsorted(values, short), len(values) - 1)] == short
        _, twice = T.repeated(hashes)
        tied |= twice & ~hot
        for chosen, special in ((tied, False), (hot, True)):
            own = np.flatnonzero(chosen)
            lo = np.maximum(at[own] - REACH, c.offsets[of[own]])
            hi = np.minimum(at[own] + LENGTH, c.offsets[of[own] + 1])
            wide = hi - lo >= LENGTH
            own, lo, hi = own[wide], lo[wide], hi[wide]
            if not len(own):
                continue
            key = T.mix(T.span_hashes(c.data, lo, hi) ^ T.mix((at[own] - lo).astype(T.U) + hashes[own]))
            settled, _ = _first_of_equal(key, c.ids[of[own]], of[own], lo)
            spans.append((of[own][settled], lo[settled] - c.offsets[of[own][settled]], hi[settled] - c.offsets[of[own][settled]]))
            own, lo, hi = own[~settled], lo[~settled], hi[~settled]
            if special:
                n = hi - lo - LENGTH + 1
                rows = np.repeat(of[own], n)
                p = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else lo
                p, one = np.unique(p, return_index=True)
                rows = rows[one]
                key = T.rolling_hashes(c.data, p, p + LENGTH)
                place = p - c.offsets[rows]
                settled, more = _first_of_equal(key, c.ids[rows], rows, place)
                spans.append((rows[settled], place[settled], place[settled] + LENGTH))
                second = T.rolling_hashes(c.data, p[more], p[more] + LENGTH, T.SECOND)
                rows, key, place = rows[more], key[more], place[more]
                order = np.argsort(key)
                for i, a, b in _by_bucket(key[order], bits):
                    s = order[a:b]
                    out.append((number, SUFFIXES, int(i), _pack(key[s], second[s], c.ids[rows[s]], rows[s].astype(np.uint32), place[s])))
            else:
                order = np.argsort(hashes[own])
                for i, a, b in _by_bucket(hashes[own][order], bits):
                    s = order[a:b]
                    length = hi[s] - lo[s]
                    index = np.repeat(lo[s] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
                    body = c.data[index]
                    out.append((number, TIED, int(i), _pack(c.ids[of[own[s]]], of[own[s]].astype(np.uint32), lo[s] - c.offsets[of[own[s]]], length.astype(np.uint8), body)))
    rows, lo, hi = (np.concatenate(x) for x in zip(*spans, strict=True))
    if len(rows):
        out.append(_span_row(number, rows, lo, hi, bits))
    return out


def _span_row(number: int, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, bits: int) -> tuple:
    rows, lo, hi = joined_spans(rows, lo, hi)
    bucket = int(T.mix(np.array([number + 1], np.int64).view(T.U))[0] >> T.U(64 - bits))
    return number, SPANS, bucket, _pack(rows.astype(np.uint32), lo.astype(np.int64), hi.astype(np.int64))


def joined_spans(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The union of spans of each row, as maximal spans in order."""
    if not len(rows):
        return rows, lo, hi
    order = np.lexsort((lo, rows))
    rows, lo, hi = rows[order], lo[order], hi[order]
    shift = rows.astype(np.int64) * (int(hi.max()) + 2)
    reach = np.maximum.accumulate(hi + shift)
    new = np.ones(len(rows), bool)
    new[1:] = lo[1:] + shift[1:] > reach[:-1]
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(rows)) - 1
    return rows[start], lo[start], reach[end] - shift[start]


def _confirmed(keys: np.ndarray, proofs: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Sorted keys, of which equal ones now stand for equal strings: each string is compared with the
    first of its key, byte for byte, or by a second hash where a bucket has only hashes (hot suffixes).
    Those that differ get keys of their own; no such case is known."""
    if not len(keys):
        return keys
    words = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = proofs[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]
    wrong = (proofs < 0) & (first < 0) & (proofs != first)
    both = np.flatnonzero((proofs >= 0) & (first >= 0) & (proofs != first))
    for lo in range(0, len(both), 1 << 18):
        some = both[lo : lo + (1 << 18)]
        a, b = proofs[some], first[some]
        differ = np.zeros(len(some), bool)
        for shift in (*range(0, LENGTH - 8, 8), LENGTH - 8):
            differ |= words[a + shift] != words[b + shift]
        wrong[some] = differ
    keys = keys.copy()
    for i in np.flatnonzero(wrong).tolist():
        own = data[proofs[i] : proofs[i] + LENGTH].tobytes() if proofs[i] >= 0 else int(proofs[i]).to_bytes(8, "little", signed=True)
        keys[i] = int.from_bytes(hashlib.blake2b(own + int(keys[i]).to_bytes(8, "little"), digest_size=8).digest(), "little")
    return keys


def _settle_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """Step 3, by bucket: sorts its suffixes and marks all but the first of equal ones."""
    numbers = pdf["chunk"].to_numpy()
    kinds = pdf["kind"].to_numpy()
    bucket = int(pdf["bucket"].iloc[0])
    out = [(int(numbers[i]), SPANS, bucket, pdf["payload"].iloc[i]) for i in np.flatnonzero(kinds == SPANS)]
    keys, contexts = [], []  # contexts: number of suffixes, id, row, first place, payload; suffixes of one follow each other
    proofs, bodies, upto = [], [], 0  # of a suffix: where its bytes are among bodies, or a second hash, as a negative number
    for i in np.flatnonzero(kinds == TIED):
        doc, row, lo, length, body = _unpack(pdf["payload"].iloc[i], np.int64, np.uint32, np.int64, np.uint8, np.uint8)
        length = length.astype(np.int64)
        n = length - LENGTH + 1
        start = np.arange(n.sum()) + np.repeat(np.cumsum(length) - length - (np.cumsum(n) - n), n)
        for a in range(0, len(start), 1 << 20):
            part = start[a : a + (1 << 20)]
            first, last = int(part[0]), int(part[-1]) + LENGTH
            keys.append(T.rolling_hashes(body[first:last], part - first, part - first + LENGTH))
        contexts.append((n, doc, row, lo, np.full(len(n), i)))
        proofs.append(start + upto)
        bodies.append(body)
        upto += len(body)
    for i in np.flatnonzero(kinds == SUFFIXES):
        key, second, doc, row, place = _unpack(pdf["payload"].iloc[i], T.U, T.U, np.int64, np.uint32, np.int64)
        keys.append(key)
        proofs.append(-1 - (second >> T.U(1)).astype(np.int64))
        contexts.append((np.ones(len(key), np.int64), doc, row, place, np.full(len(key), i)))
    if keys:
        key = np.concatenate(keys)
        n, doc, row, lo, of = (np.concatenate(x) for x in zip(*contexts, strict=True))
        context = np.repeat(np.arange(len(n), dtype=np.int32), n)
        order = np.argsort(key)
        k = key[order]
        same = k[1:] == k[:-1]
        multiple = np.zeros(len(k), bool)
        multiple[1:] |= same
        multiple[:-1] |= same
        order, k = order[multiple], k[multiple]
        k = _confirmed(k, np.concatenate(proofs)[order], np.concatenate([*bodies, np.zeros(8, np.uint8)]))
        sort = np.argsort(k, kind="stable")
        order, k = order[sort], k[sort]
        own = context[order]
        place = lo[own] + order - (np.cumsum(n) - n)[own]
        doc, row, of = doc[own], row[own], of[own]
        if len(k):
            start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(k))))
            least = np.minimum.reduceat(doc, start)[group]
            gone = doc > least
            some = np.flatnonzero(~gone)  # of the least id: later places in the same row
            unit = numbers[of[some]]
            sort = np.lexsort((place[some], row[some], unit, group[some]))
            g, u, r, p = group[some][sort], unit[sort], row[some][sort], place[some][sort]
            new = np.ones(len(sort), bool)
            new[1:] = (g[1:] != g[:-1]) | (u[1:] != u[:-1]) | (r[1:] != r[:-1])
            first = np.maximum.accumulate(np.where(new, np.arange(len(sort)), 0))
            gone[some[sort]] = p > p[first]
            doc_chunk, row, place = numbers[of[gone]], row[gone].astype(np.int64), place[gone]
            order = np.argsort(doc_chunk, kind="stable")
            bounds = np.flatnonzero(np.concatenate([[True], np.diff(doc_chunk[order]) != 0])) if len(order) else np.zeros(0, int)
            for a, b in zip(bounds, np.append(bounds[1:], len(order))[: len(bounds)], strict=True):
                s = order[a:b]
                x = joined_spans(row[s], place[s], place[s] + LENGTH)
                out.append((int(doc_chunk[order[a]]), SPANS, bucket, _pack(x[0].astype(np.uint32), x[1], x[2])))
    return pd.DataFrame(out, columns=["chunk", "kind", "bucket", "payload"])


def _removed(joined: DataFrame, with_text: bool) -> DataFrame:
    """Step 4: counts, hash and, if wanted, the bytes that stay, of every text."""

    def run(batches):
        for batch in batches:
            for meta, blob, found in zip(*(batch.column(c).to_pylist() for c in ("meta", "blob", "found")), strict=True):
                c = Chunk.load(meta, blob)
                parts = [_unpack(x["payload"], np.uint32, np.int64, np.int64) for x in found or []]
                rows, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 3
                rows, lo, hi = joined_spans(rows.astype(np.int64), lo, hi)
                size = np.diff(c.offsets)
                lost = T.sums(hi - lo, rows, len(size))
                spans = np.bincount(rows, minlength=len(size)).astype(np.int64)
                bounds = np.searchsorted(rows, np.arange(len(size) + 1))
                body = c.data.tobytes()
                hashes, kept = [], []
                for i in range(len(size)):
                    at, own = int(c.offsets[i]), hashlib.sha256()
                    pieces = []
                    for j in range(bounds[i], bounds[i + 1]):
                        pieces.append(body[at : int(c.offsets[i] + lo[j])])
                        at = int(c.offsets[i] + hi[j])
                    pieces.append(body[at : int(c.offsets[i + 1])])
                    for x in pieces:
                        own.update(x)
                    hashes.append(own.hexdigest())
                    kept.append(b"".join(pieces) if with_text else None)
                out = {"doc_id": pa.array(c.ids, mask=c.nulls), "n_bytes": pa.array(size), "n_removed": pa.array(lost), "n_spans": pa.array(spans), "kept_sha256": pa.array(hashes, pa.string())}
                yield pa.RecordBatch.from_pydict(out | ({"kept": pa.array(kept, pa.binary())} if with_text else {}))

    return joined.mapInArrow(T.tidy(run), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if with_text else ""))


def deduplicate(docs: DataFrame, with_text: bool = False, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES, hot_chunks: int = HOT_CHUNKS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, kept (binary) of every text."""
    chunks = checkpointed(pack_texts(docs, chunk_bytes))
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 1
    bits = int(np.clip(math.ceil(math.log2(max(1, total / bucket_bytes))), 4, MAX_BITS))
    kept = int(np.clip(math.ceil(math.log2(total)) + 6, bits + 8, 64))
    cover = _cover(chunks.select("chunk", "meta", "blob"), bits, kept)
    tied = cover.groupBy("bucket").applyInPandas(lambda pdf: _tied_in_bucket(pdf, hot_chunks), _FIELDS)
    around = _surroundings(_with(chunks, tied), bits, kept)
    spans = around.groupBy("bucket").applyInPandas(_settle_bucket, _FIELDS)
    return _removed(_with(chunks, spans), with_text)


def _with(chunks: DataFrame, found: DataFrame) -> DataFrame:
    """Chunks with what was found for them: at most a few payloads a bucket."""
    own = found.groupBy(F.col("chunk").alias("_chunk")).agg(F.collect_list(F.struct("kind", "payload")).alias("found"))
    return chunks.join(own, F.col("chunk") == F.col("_chunk"), "left").select("chunk", "meta", "blob", "found")
