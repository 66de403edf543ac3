"""Language identification by a string kernel.

A text's features are the set of its byte n-grams of ORDERS (blended spectrum,
presence only), over lower-cased letters with all else turned into a blank, hashed to
FEATURES slots; the kernel is |A & B| / sqrt(|A| |B|). LANDMARKS texts span a Nyström
approximation, in which kernel ridge regression is solved for each language against
the rest. Since a score is linear in the presence vector, landmarks and coefficients
fold into one matrix, and a batch of texts is scored by one matrix product.

Training uses a bounded sample (a documented parameter): about PER_LANGUAGE documents
of each language, ALL_LANGUAGES at most, chosen by a hash of the id among those that may be learned from.
Every text is predicted whole, from its bytes alone.

Defined cases: a null text, or one without a letter, gets und and score 0; so does
every text if there is nothing to learn from; repeated rows are predicted one by one;
a null id is neither held out nor learned from; an empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import free_name

ORDERS, FEATURES_LOG2 = (1, 2, 3), 15
FEATURES = 1 << FEATURES_LOG2
#: The sample: documents and landmarks of a language, about.
PER_LANGUAGE, LANDMARKS_PER_LANGUAGE = 400, 48
#: The same of all languages together: with more of them, each has fewer.
ALL_LANGUAGES, ALL_LANDMARKS = 16_000, 2_000
RIDGE = 1e-2
UNKNOWN = "und"

_LETTERS = np.array([b | 0x20 if 65 <= b <= 90 or 97 <= b <= 122 else b if b >= 0x80 else 0x20 for b in range(256)], np.uint8)
_ROWS = 64


def presence(b: T.Block) -> np.ndarray:
    """n texts by FEATURES: is the n-gram there?"""
    n, data = b.n, _LETTERS[T.lower(b.data)].astype(np.uint32)
    flags = np.zeros(n * FEATURES + 1, bool)
    base = np.repeat(np.arange(n, dtype=np.int64) << FEATURES_LOG2, np.diff(b.offsets))
    code = np.zeros(len(data), np.uint32)
    for order in range(1, max(ORDERS) + 1):
        code = data if order == 1 else code[:-1] * np.uint32(256) + data[order - 1 :]
        if order not in ORDERS or not len(code):
            continue
        slot = ((code + np.uint32(order << 28)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - FEATURES_LOG2)
        at = base[: len(code)] + slot
        for j in range(1, order):  # windows that would cross into the next text
            edge = b.offsets[1:] - j
            at[edge[(edge >= 0) & (edge < len(at))]] = n * FEATURES
        flags[at] = True
    flags = flags[:-1].reshape(n, FEATURES)
    return flags


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def scores(self, flags: np.ndarray) -> np.ndarray:
        x = flags.astype(np.float32)
        norm = np.sqrt(np.maximum(x.sum(1, keepdims=True), 1.0))
        return (x @ self.weights) / norm + self.bias


def fit(languages: np.ndarray, bits: np.ndarray, landmarks: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> Model:
    """Nyström features and one-versus-rest kernel ridge regression. bits: packed presence, a row a text."""
    names = sorted(set(languages))
    landmarks = max(1, min(landmarks, ALL_LANDMARKS // len(names)))
    chosen = np.concatenate([np.flatnonzero(languages == c)[:landmarks] for c in names])
    unit = lambda rows: (x := np.unpackbits(bits[rows], axis=1).astype(np.float32)) / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1.0))
    marks = unit(chosen)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    z = np.concatenate([unit(slice(i, i + 256)) @ marks.T for i in range(0, len(bits), 256)]).astype(np.float64) @ whiten
    y = np.where(languages[:, None] == np.array(names)[None, :], 1.0, -1.0)
    share = np.array([np.mean(languages == c) for c in names])
    weight = np.array([1.0 / (len(names) * share[names.index(c)]) for c in languages])[:, None]
    mean = (weight * z).sum(0) / weight.sum()
    target = (weight * y).sum(0) / weight.sum()
    centred = z - mean
    gram = centred.T @ (weight * centred) + ridge * len(z) / z.shape[1] * np.eye(z.shape[1])
    solved = np.linalg.solve(gram, centred.T @ (weight * (y - target)))
    return Model(names, (marks.T @ (whiten @ solved).astype(np.float32)).astype(np.float32), (target - mean @ solved).astype(np.float32))


def _bucket(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """Learns from documents whose crc32 of the id, modulo 3, is not 1."""
    allowed = docs.where((_bucket() != 1) & F.col("lang").isNotNull() & (F.length("text") > 0)).select("lang", "text", "doc_id")
    sizes = {r["lang"]: r["count"] for r in allowed.groupBy("lang").count().collect()}  # a row a language
    if not sizes:
        return None
    per_language = max(1, min(per_language, ALL_LANGUAGES // len(sizes)))
    order = F.shiftrightunsigned(F.xxhash64(F.lit(10), "doc_id"), 1) / float(1 << 63)
    rate = None
    for lang, n in sizes.items():
        share = min(1.0, 1.2 * per_language / n)
        rate = F.when(F.col("lang") == lang, share) if rate is None else rate.when(F.col("lang") == lang, share)
    sample = allowed.withColumn("order", order).where(F.col("order") < rate).select("lang", "order", "text")

    def run(batches):
        for batch in batches:
            for b in _small_blocks(batch.column(2)):
                part = batch.slice(b.rows.start, b.n)
                bits = np.packbits(presence(b), axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in bits], pa.binary())], ["lang", "order", "bits"])

    rows = sorted(sample.mapInArrow(T.tidy(run), "lang string, order double, bits binary").collect(), key=lambda r: (r["lang"], r["order"], r["bits"]))  # the bounded sample
    taken: dict[str, int] = {}
    kept = []
    for r in rows:
        taken[r["lang"]] = taken.get(r["lang"], 0) + 1
        if taken[r["lang"]] <= per_language:
            kept.append(r)
    bits = np.frombuffer(b"".join(r["bits"] for r in kept), np.uint8).reshape(len(kept), FEATURES // 8)
    return fit(np.array([r["lang"] for r in kept]), bits)


def _small_blocks(column):
    """Blocks of at most _ROWS texts."""
    for b in T.blocks(column, 1 << 19):
        for lo in range(0, b.n, _ROWS):
            hi = min(b.n, lo + _ROWS)
            yield T.Block(slice(b.rows.start + lo, b.rows.start + hi), b.data[b.offsets[lo] : b.offsets[hi]], b.offsets[lo : hi + 1] - b.offsets[lo])


def has_letter(b: T.Block) -> np.ndarray:
    ascii_letter = ((b.data | 0x20) >= 97) & ((b.data | 0x20) <= 122)
    found = T.row_sums(ascii_letter, b.offsets) > 0
    for i in np.flatnonzero(~found):
        found[i] = any(c.isalpha() for c in b.data[b.offsets[i] : b.offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


def predict(docs: DataFrame, model: Model | None, keep: list[str], text: str = "text") -> DataFrame:
    """Columns keep, lang_pred and score of every row."""
    source = docs.select(*keep, F.col(text).alias(free_name(keep, "_text")))
    if model is None:
        return docs.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))  # FEATURES floats a language

    def run(batches):
        own = Model(*shared.value)
        names = np.array([*own.languages, UNKNOWN], object)
        for batch in batches:
            for b in _small_blocks(batch.columns[-1]):
                scores = own.scores(presence(b))
                best = scores.argmax(1)
                score = np.clip((scores[np.arange(b.n), best].astype(np.float64) + 1) / 2, 0, 1)
                none = ~has_letter(b)
                best[none], score[none] = len(own.languages), 0.0
                part = batch.slice(b.rows.start, b.n).columns[:-1]
                yield pa.RecordBatch.from_arrays([*part, pa.array(names[best], pa.string()), pa.array(score)], [*keep, "lang_pred", "score"])

    schema = source.schema[: len(keep)].add("lang_pred", "string").add("score", "double")
    return source.mapInArrow(T.tidy(run), schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, by a model of the others."""
    model = train(docs)
    held = docs.select("doc_id", F.coalesce(_bucket() == 1, F.lit(False)).alias("held_out"), "text")
    return predict(held, model, ["doc_id", "held_out"])
