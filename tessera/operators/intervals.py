"""Analytics of things that begin and end: active stock by month, status as of a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from .relational import ordinal_rank, union_all

UNKNOWN = "(unknown)"


def active_months(df: DataFrame, created: str, ended: str, as_of) -> DataFrame:
    """df with month: a row for each month start, up to that of as_of, at which a thing is active,
    that is created on or before it and not ended by it.

    The months of a row follow from its own dates, so there is no join with a calendar.
    """
    return df.withColumn("month", F.explode(D.months(D.next_month_start(created), last_month(ended, as_of))))


def last_month(ended: str, as_of) -> Column:
    """The last month start before the end and not after as_of."""
    last = F.coalesce(F.date_sub(F.col(ended), 1), F.to_date(F.lit("9999-12-31")))
    return D.month_start(F.least(as_of, last))


def running_counts(df: DataFrame, low: str, high: str, keys: list[str]) -> DataFrame:
    """keys, month, count: for each value of keys and month, the rows with low <= month <= high.

    Rows become a step up at low and a step down after high, which are summed by month before
    anything else; so the work follows the rows, not rows times months. Running sums are taken over
    the months of a value, and the months between two steps are filled in.
    """
    steps = F.explode(F.array(F.struct(F.col(low).alias("month"), F.lit(1).alias("step")), F.struct(F.add_months(F.col(high), 1).alias("month"), F.lit(-1).alias("step"))))
    summed = df.where(F.col(low) <= F.col(high)).select(*keys, steps.alias("s")).groupBy(*keys, "s.month").agg(F.sum("s.step").alias("step"))
    by = Window.partitionBy(*keys).orderBy("month")
    counted = summed.select(*keys, "month", F.sum("step").over(by).alias("count"), F.lead("month").over(by).alias("next")).where("count > 0")
    return counted.select(*keys, F.explode(D.months("month", F.add_months("next", -1))).alias("month"), "count")


def _cell(dimension: str):
    return lambda x: F.struct(F.lit(dimension).alias("dimension"), x.alias("group_value"))


def stock_by_date(df: DataFrame, as_of, plain: list[str], listed: list[str] = (), created: str = "creation_date", ended: str = "termination_date") -> DataFrame:
    """date, dimension, group_value, count, rank.

    plain: dimensions with one value (blank or null: unknown). listed: dimensions of values joined by
    bars, each of which counts. The year of creation is a further dimension, vintage_year, ranked
    by the year itself; other values rank by their sum over all dates, ties by value.
    """
    rows = df.withColumns({created: D.iso_date(created), ended: D.iso_date(ended)}).where(F.col(created).isNotNull())
    value = {c: F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit(UNKNOWN)) for c in plain}
    value["vintage_year"] = F.year(created).cast("string")
    single = [F.struct(F.lit(c).alias("dimension"), v.alias("group_value")) for c, v in value.items()]
    several = [F.transform(F.filter(F.transform(F.split(F.coalesce(F.col(c), F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != ""), _cell(c)) for c in listed]
    cells = F.concat(F.array(*single), *several)
    dated = rows.select(D.next_month_start(created).alias("low"), last_month(ended, as_of).alias("high"), F.explode(cells).alias("cell"))
    counted = running_counts(dated.select("low", "high", "cell.dimension", "cell.group_value"), "low", "high", ["dimension", "group_value"])
    totals = counted.groupBy("dimension", "group_value").agg(F.sum("count").alias("total"))
    by_total = ordinal_rank("dimension", F.desc("total"), "group_value")
    ranks = totals.select(F.col("dimension").alias("_d"), F.col("group_value").alias("_v"), F.when(F.col("dimension") == "vintage_year", F.expr("try_cast(group_value AS bigint)")).otherwise(by_total).alias("rank"))
    joined = counted.join(ranks, (F.col("dimension") == F.col("_d")) & (F.col("group_value") == F.col("_v")), "left")
    return joined.select(D.iso_text("month").alias("date"), "dimension", "group_value", F.col("count").cast("long").alias("count"), "rank").orderBy("dimension", "rank", "date", "group_value")


def status_as_of(df: DataFrame, as_of, created: str = "creation_date", ended: str = "termination_date", last_event: str = "last_event_date", status: str = "status") -> DataFrame:
    """df with as_of_status on a date; what did not exist yet is left out.

    An end date decides. Without one: Unknown if it is known to have ended some time; if its fate
    is unknown, Ongoing up to its last event and Unknown after; else Ongoing.
    """
    c, t, e = D.iso_date(created), D.iso_date(ended), D.iso_date(last_event)
    fate = F.lower(F.trim(F.coalesce(F.col(status), F.lit(""))))
    return df.where(c.isNotNull() & (c <= as_of)).withColumn(
        "as_of_status",
        F.when(t <= as_of, "Terminated").when(t > as_of, "Ongoing").when(fate == "terminated", "Unknown").when((fate == "unknown") & ~F.coalesce(e >= as_of, F.lit(False)), "Unknown").otherwise("Ongoing"),
    )


def stock_of(frames: list[DataFrame], as_of, plain: list[str], listed: list[str] = ()) -> DataFrame:
    return stock_by_date(union_all(frames, missing=True), as_of, plain, listed)
