"""Quality rules whose cutoffs carry a guarantee.

Each rule compares a ratio of document counts with a cutoff. The labelled documents are
split by a hash of the id. On the smaller part, the cutoff of each stratum (language) and
rule is fitted: bad documents rejected less LOSS times the good ones are to be most, the
laxest cutoff if equal. The fitted cutoffs end a path of STEPS steps that starts with all
rules off and tightens all of them together. On the other part, the holdout, the steps are
tried from lax to strict, each by an exact binomial (Clopper-Pearson) test that at most
ALPHA of the stratum's good documents are rejected by any of the rules, and the sequence
stops at the first failure; the last step that passed is used. The path does not depend on
the holdout, so testing in its order needs no correction within a stratum; across strata
the level is DELTA / strata (Bonferroni). So with probability 1 - DELTA the verdict of all
rules together keeps the limit in every stratum. A stratum with too few labels certifies
nothing, and only the base rule rejects there.

Defined cases: a null or empty text has no words and fails the base rule; a null
language is a stratum of its own; several labels of one id count once, as the lowest, and
so do several rows of a labelled id; repeated rows are judged one by one; a text is counted
whole, however long; columns to carry along that are named like the result's own are left
out; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .common import checkpointed, kept

ALPHA, DELTA, LOSS, GRID, STEPS = 0.02, 0.05, 10, 200, 20
#: One in so many labelled documents fits the cutoffs; the others certify them.
FIT_PART = 3
#: Largest number of strata whose cutoffs are sent to all executors; beyond it they are joined.
BROADCAST_STRATA = 10_000
#: Rule: numerator, denominator, scale of the grid (value of one step is 1 / scale).
RULES = {
    "symbols": ("n_symbols", "n_words", 50),
    "bangs": ("n_bangs", "n_words", 100),
    "capitals": ("n_capitals", "word_chars", 200),
    "dup_lines": ("n_dup_lines", "n_lines", 200),
    "repeats": ("n_repeat_words", "n_words", 200),
    "word_length": ("word_chars", "n_words", 10),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bangs", "n_capitals")

_SYMBOL = T.byte_table(lambda b: chr(b) in "#*$%&|<>")
_START = T.byte_table(lambda b: b & 0xC0 != 0x80)


def _capitals(data: np.ndarray) -> np.ndarray:
    return T.lower(data) != data


def count_block(b: T.Block) -> dict[str, np.ndarray]:
    """The counts of each text of a block."""
    n, out = b.n, {}
    inside = T.NON_SPACE[b.data]
    starts, ends, rows = T.spans(inside, b.offsets)
    hashes = T.span_hashes(b.data, starts, ends)
    out["n_words"] = np.bincount(rows, minlength=n).astype(np.int64)
    out["word_chars"] = T.row_sums(inside & _START[b.data], b.offsets)
    out["n_symbols"] = T.row_sums(_SYMBOL[b.data], b.offsets)
    out["n_bangs"] = T.row_sums(b.data == ord("!"), b.offsets)
    out["n_capitals"] = T.row_sums(_capitals(b.data), b.offsets)
    line_starts, line_ends, line_rows = T.spans(b.data != 10, b.offsets)
    words_before = np.zeros(len(b.data) + 1, np.int64)
    np.cumsum(inside, out=words_before[1:])
    full = words_before[line_ends] > words_before[line_starts]
    line_starts, line_ends, line_rows = line_starts[full], line_ends[full], line_rows[full]
    lines = T.span_hashes(b.data, line_starts, line_ends)
    later, _ = T.repeated(T.mix(lines + line_rows.astype(T.U) * T.U(0xA24BAED4963EE407)))
    out["n_lines"] = np.bincount(line_rows, minlength=n).astype(np.int64)
    out["n_dup_lines"] = np.bincount(line_rows[later], minlength=n).astype(np.int64)
    keys, at = T.windows(hashes, rows, 3)
    _, twice = T.repeated(T.mix(keys + rows[at].astype(T.U) * T.U(0xA24BAED4963EE407)))
    covered = np.zeros(len(hashes), bool)
    for j in range(3):
        covered[at[twice] + j] = True
    out["n_repeat_words"] = np.bincount(rows[covered], minlength=n).astype(np.int64)
    return out


def counts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns keep of docs and COUNTS of the text."""
    source = docs.select(*keep) if text in keep else docs.select(*keep, text)
    names, at = list(keep), source.columns.index(text)

    def run(batches):
        for batch in batches:
            for b in T.blocks(batch.column(at)):
                found = count_block(b)
                part = batch.slice(b.rows.start, b.n).columns[: len(names)]
                yield pa.RecordBatch.from_arrays([*part, *(pa.array(found[c]) for c in COUNTS)], [*names, *COUNTS])

    schema = source.schema[: len(keep)]
    for c in COUNTS:
        schema = schema.add(c, "long")
    return source.mapInArrow(T.tidy(run), schema)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X of Binomial(n, p), exactly by the sum of its terms."""
    if k >= n:
        return 1.0
    term = n * math.log1p(-p)
    total = math.exp(term)
    odds = math.log(p) - math.log1p(-p)
    for i in range(1, k + 1):
        term += math.log((n - i + 1) / i) + odds
        total += math.exp(term)
    return min(1.0, total)


def certified(n: int, k: int, alpha: float, level: float) -> bool:
    """Is the exact upper bound, at confidence 1 - level, of a rate seen k times in n at most alpha?"""
    return n > 0 and k < alpha * n and binomial_tail(k, n, alpha) <= level


def last_certified(good: np.ndarray, alpha: float, level: float) -> int:
    """The last step that passes before the first that fails; 0 if none does. good: good documents by
    the first step that rejects them, 1 .. STEPS, or STEPS + 1; the first entry is not used."""
    n, lost = int(good.sum()), 0
    for step in range(1, STEPS + 1):
        lost += int(good[step])
        if not certified(n, lost, alpha, level):
            return step - 1
    return STEPS


def _grid(rule: str):
    top, bottom, scale = RULES[rule]
    return F.when(F.col(bottom) > 0, F.least(F.lit(GRID), F.floor(F.col(top) * scale / F.col(bottom)))).otherwise(0).cast("int")


def _at_step(rule: str, step):
    """The cutoff of a rule at a step of the path; null if the rule is off."""
    return GRID - F.floor((GRID - F.col(f"fit_{rule}")) * step / STEPS).cast("int")


def fitted(rows: DataFrame) -> DataFrame:
    """_stratum, fit_<rule> (null: the rule gains nothing). rows: _stratum, _good and the grid value of each rule."""
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"v_{r}").alias("value")) for r in RULES]))
    gain = F.sum(F.when(F.col("_good"), -LOSS).otherwise(1)).alias("gain")
    table = rows.select("_stratum", "_good", rules.alias("x")).where("x.value > 0").groupBy("_stratum", "x.rule", "x.value").agg(gain)
    running = Window.partitionBy("_stratum", "rule").orderBy(F.desc("value"))  # at most GRID rows
    best = table.withColumn("gain", F.sum("gain").over(running)).where("gain > 0").groupBy("_stratum", "rule").agg(F.max(F.struct("gain", "value")).alias("x"))
    return best.groupBy("_stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("x.value") - 1)).alias(f"fit_{r}") for r in RULES])


def cutoffs(found: DataFrame, labels: DataFrame, stratum: str, doc_id: str, alpha: float = ALPHA, delta: float = DELTA) -> tuple[DataFrame, int]:
    """One row a stratum with its cutoffs (null: the rule is off), and the number of strata."""
    graded = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg((F.min("quality") > 0).alias("_good"))
    values = [_grid(r).alias(f"v_{r}") for r in RULES]
    rows = found.where(~F.col("base_failed")).join(graded, F.col(doc_id) == F.col("_id")).select("_id", F.col(stratum).alias("_stratum"), "_good", *values)
    one = F.min(F.struct("_stratum", "_good", *[f"v_{r}" for r in RULES])).alias("x")
    rows = checkpointed(rows.groupBy("_id").agg(one).select(in_fit("_id").alias("_fit"), "x.*"))
    path = checkpointed(fitted(rows.where("_fit")))
    strata = rows.select("_stratum").distinct().count()
    level = delta / max(1, strata)
    sent = F.broadcast(path) if strata <= BROADCAST_STRATA else path
    held = rows.where("NOT _fit AND _good").join(sent.withColumnRenamed("_stratum", "_s"), F.col("_stratum").eqNullSafe(F.col("_s")))
    rejected = lambda step: functools.reduce(lambda a, b: a | b, [F.coalesce(F.col(f"v_{r}") > _at_step(r, step), F.lit(False)) for r in RULES])
    step = F.coalesce(F.array_min(F.filter(F.sequence(F.lit(1), F.lit(STEPS)), rejected)), F.lit(STEPS + 1))
    table = held.select("_stratum", step.alias("step")).groupBy("_stratum", "step").agg(F.count("*").alias("good"))

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        good = np.zeros(STEPS + 2, np.int64)
        good[pdf["step"].to_numpy()] = pdf["good"].to_numpy()
        return pd.DataFrame({"_s": [pdf["_stratum"].iloc[0]], "_step": [last_certified(good, alpha, level)]})

    steps = table.groupBy("_stratum").applyInPandas(test, "_s string, _step int").where("_step > 0")
    cuts = path.join(F.broadcast(steps) if strata <= BROADCAST_STRATA else steps, F.col("_stratum").eqNullSafe(F.col("_s")))
    return cuts.select("_stratum", *[_at_step(r, F.col("_step")).alias(f"cut_{r}") for r in RULES]), strata


def in_fit(doc_id: str):
    """Is a labelled document of the part that fits the cutoffs? By a hash of its id."""
    return F.conv(F.substring(F.md5(F.col(doc_id).cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % FIT_PART == 0


def assess(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """doc_id, keep, COUNTS, base_failed, failed_rules (array of rule names) and kept of every document."""
    keep = kept(keep, "doc_id", stratum, "text", *COUNTS, "base_failed", "failed_rules", "kept")
    found = counts(docs, ["doc_id", stratum, *keep])
    found = checkpointed(found.withColumn("base_failed", _base_failed()))
    cuts, strata = cutoffs(found, labels.select("doc_id", "quality"), stratum, "doc_id", alpha, delta)
    cuts = F.broadcast(cuts) if strata <= BROADCAST_STRATA else cuts
    return _judged(found, cuts, stratum).select("doc_id", stratum, *keep, *COUNTS, "base_failed", "failed_rules", "kept")


def _base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _judged(found: DataFrame, cuts: DataFrame, stratum: str) -> DataFrame:
    fails = F.array_compact(F.array(*[F.when(_grid(r) > F.col(f"cut_{r}"), F.lit(r)) for r in RULES]))
    joined = found.join(cuts, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    return joined.withColumn("failed_rules", fails).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def keep(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of docs that are kept, with all their columns.

    A second pass counts again and filters where the text is, so texts are not shuffled.
    """
    small = checkpointed(counts(docs, ["doc_id", stratum]).withColumn("base_failed", _base_failed()))
    cuts, strata = cutoffs(small, labels.select("doc_id", "quality"), stratum, "doc_id", alpha, delta)
    cuts = F.broadcast(cuts) if strata <= BROADCAST_STRATA else cuts
    safe = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # no clash with the names of counts
    wide = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in safe.items()])
    found = counts(wide, list(safe.values()), safe["text"]).withColumn("base_failed", _base_failed())
    return _judged(found, cuts, safe[stratum]).where("kept").select(*[F.col(n).alias(c) for c, n in safe.items()])
