"""Relational operators with explicit order: nothing depends on the order of rows in a file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered(*order: str | Column) -> Column:
    """An order key; nulls come first."""
    return F.struct(*order)


def first_by(value: str, *order) -> Column:
    """Aggregate: the value of the row that comes first."""
    return F.min_by(value, ordered(*order))


def last_by(value: str, *order) -> Column:
    return F.max_by(value, ordered(*order))


def text_set(value: str, joint: str = "|") -> Column:
    """Aggregate: distinct values, sorted and joined; nulls do not count."""
    return F.array_join(F.sort_array(F.collect_set(value)), joint)


def any_true(value: str | Column) -> Column:
    """Aggregate: is one true? False without a row that is."""
    return F.coalesce(F.bool_or(value), F.lit(False))


def n_distinct(value: str, nullable: bool = False) -> Column:
    """Aggregate: distinct values; a null is one of them if nullable."""
    n = F.count_distinct(F.col(value))
    return n + F.coalesce(F.max(F.col(value).isNull().cast("long")), F.lit(0)) if nullable else n


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row for each value of keys, the first in order.

    An aggregate, not a window: rows are combined before the shuffle, so a key with very many
    rows sends few of them.
    """
    everything = F.struct(*[F.col(c) for c in df.columns])
    best = df.groupBy(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]).agg(F.min_by(everything, ordered(*order, F.xxhash64(*df.columns))).alias("_row"))
    return best.select("_row.*")


def having_distinct(df: DataFrame, key: str, value: str, least: int) -> DataFrame:
    """Keys with so many distinct values at least."""
    return df.groupBy(key).agg(F.count_distinct(value).alias("n")).where(F.col("n") >= least).select(key)


def flagged(df: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """df with a boolean column: is its key among keys?"""
    known = keys.select(F.col(key).alias("_known")).distinct()
    return df.join(known, df[key] == F.col("_known"), "left").withColumn(name, F.col("_known").isNotNull()).drop("_known")


def split_by(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows for which condition holds, and all others; a null condition does not hold."""
    holds = F.coalesce(condition, F.lit(False))
    return df.where(holds), df.where(~holds)


def union_all(frames: list[DataFrame], missing: bool = False) -> DataFrame:
    """By name; with missing, columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=missing), frames)


def tagged_union(frames: dict[str, DataFrame], name: str, missing: bool = False) -> DataFrame:
    """Union with a column that names each row's frame, and its position in <name>_order."""
    return union_all([df.withColumns({name: F.lit(tag), f"{name}_order": F.lit(i)}) for i, (tag, df) in enumerate(frames.items())], missing)


def without_done(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not among those that are done."""
    return df.join(done.select(*keys).distinct(), keys, "left_anti")


def filled_from(df: DataFrame, prior: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Blank or null columns taken from an earlier table."""
    old = prior.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_old_{c}") for c in columns])
    joined = df.join(old, df[key] == F.col("_key"), "left")
    full = {c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_old_{c}"), F.lit("")) for c in columns}
    return joined.withColumns(full).select(*df.columns)


def pivot_counts(df: DataFrame, index: str, on: str, values: list[str], counted: str) -> DataFrame:
    """Distinct values of counted by index and on, as one column a value; 0 where there is none."""
    return df.groupBy(index).pivot(on, values).agg(F.count_distinct(counted)).fillna(0)


def ordinal_rank(group: str | list[str], *order) -> Column:
    return F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long")


def top(df: DataFrame, n: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(n)


def seeded_order(*keys: str, seed: str = "0") -> Column:
    """A fixed pseudo-random order of keys, the same in any engine that has sha256."""
    return F.sha2(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in keys]), 256)


def sample(df: DataFrame, n: int, keys: list[str], seed: str = "0") -> DataFrame:
    return df.orderBy(seeded_order(*keys, seed=seed), *keys).limit(n)


def stratified_sample(df: DataFrame, strata: list[str], n: int, keys: list[str], seed: str = "0") -> DataFrame:
    """n rows of each stratum. The n smallest of a part of a stratum are taken before the shuffle by
    stratum, so a large stratum is not sorted in one task."""
    near = F.conv(F.left(seeded_order(*keys, seed=seed), F.lit(3)), 16, 10).cast("int")
    parts = df.withColumns({"_order": seeded_order(*keys, seed=seed), "_part": near})
    first = parts.withColumn("_n", F.row_number().over(Window.partitionBy(*strata, "_part").orderBy("_order", *keys))).where(F.col("_n") <= n)
    return first.withColumn("_n", F.row_number().over(Window.partitionBy(*strata).orderBy("_order", *keys))).where(F.col("_n") <= n).drop("_order", "_part", "_n")


def exploded_text(df: DataFrame, column: str, separator: str = "|", name: str | None = None) -> DataFrame:
    """A row for each item of a joined text; items are trimmed and blanks dropped."""
    name = name or column
    items = F.transform(F.split(F.col(column), f"\\Q{separator}\\E"), lambda x: F.trim(x))
    return df.withColumn(name, F.explode(items)).where(F.col(name) != "")
