"""Dates: lenient parsing, month grids and bounds. No function reads the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import col


def iso_date(c) -> Column:
    """A date of the form yyyy-MM-dd; anything else, a blank too, is null."""
    c = F.trim(col(c).cast("string"))
    return F.when(c.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(c, "yyyy-MM-dd"))


def iso_text(c) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")


def month_start(c) -> Column:
    return F.trunc(col(c), "MM")


def next_month_start(c) -> Column:
    """The date itself on the first of a month, else the first of the next month."""
    c = col(c)
    return F.when(c == month_start(c), c).otherwise(F.add_months(month_start(c), 1))


def months(low, high) -> Column:
    """Month starts from low to high, both month starts; empty if high is before low or either is null."""
    low, high = col(low), col(high)
    return F.when(low <= high, F.sequence(low, F.when(low <= high, high), F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))


def half_months(c) -> Column:
    """Bounds of the two halves of a month: the 1st to 15th and the rest."""
    first = month_start(c)
    return F.array(F.struct(first.alias("lo"), F.date_add(first, 14).alias("hi")), F.struct(F.date_add(first, 15).alias("lo"), F.last_day(first).alias("hi")))


def midpoint(low, high) -> Column:
    return F.date_add(col(low), F.floor(F.date_diff(col(high), col(low)) / 2).cast("int"))


def around(c, days: int) -> Column:
    return F.struct(F.date_sub(col(c), days).alias("lo"), F.date_add(col(c), days).alias("hi"))


def bucket_start(year, first: int = 2001, width: int = 5) -> Column:
    """First year of a bucket; floors below first too, where div would truncate."""
    return (F.floor((col(year) - first) / width) * width + first).cast("long")
