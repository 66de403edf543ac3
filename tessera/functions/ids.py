"""Identifiers, names and paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def padded(c, width: int = 10) -> Column:
    """Left zeros up to width; a longer identifier stays whole, unlike with lpad."""
    c = col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def unpadded(c) -> Column:
    """No leading zeros, but one digit at least; null if it is not all digits."""
    c = F.trim(col(c))
    bare = F.regexp_replace(c, "^0+", "")
    return F.when(c.rlike("^[0-9]+$"), F.when(bare == "", "0").otherwise(bare))


def accession_digits(c) -> Column:
    """An accession number without dashes; null unless that leaves 18 digits."""
    bare = F.replace(F.trim(col(c)), F.lit("-"), F.lit(""))
    return F.when(bare.rlike("^[0-9]{18}$"), bare)


def accession_dashed(c) -> Column:
    bare = accession_digits(c)
    return F.concat(F.substring(bare, 1, 10), F.lit("-"), F.substring(bare, 11, 2), F.lit("-"), F.substring(bare, 13, 6))


def accession_year(c, pivot: int = 70) -> Column:
    """Year of an accession number; two digits above pivot belong to the 1900s."""
    two = F.substring(accession_digits(c), 11, 2).cast("int")
    return F.when(two > pivot, two + 1900).otherwise(two + 2000)


def slug(c, joint: str = "-", dropped: str = "", width: int | None = None, default: str | None = None) -> Column:
    """Small letters and digits with joint between them.

    dropped: characters that vanish instead of separating. width: longest result. default: for an
    empty result.
    """
    c = F.trim(F.lower(col(c)))
    if dropped:
        c = F.translate(c, dropped, "")
    c = F.regexp_replace(c, "[^a-z0-9]+", joint)
    c = F.regexp_replace(c, f"^{joint}+|{joint}+$", "")
    if width is not None:
        c = F.left(c, F.lit(width))
    return c if default is None else F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def slug_hyphen(c) -> Column:
    return slug(c, "-")


def slug_company(c) -> Column:
    return slug(c, "_", dropped=",.&'/()")


def slug_short(c) -> Column:
    return slug(c, "_", width=60, default="exhibit")


def basename(c) -> Column:
    return F.element_at(F.split(col(c), "/"), -1)


def directory_key(c, digits: int = 10) -> Column:
    """The digits after the last underscore of a directory name, or blank."""
    return F.coalesce(F.regexp_extract(col(c), f"_([0-9]{{{digits}}})$", 1), F.lit(""))


def archive_path(entity, accession, name) -> Column:
    """Relative path of a filed document."""
    return F.concat_ws("/", unpadded(entity), accession_digits(accession), col(name))


def blank(c) -> Column:
    """The trimmed text, blank for null."""
    return F.coalesce(F.trim(col(c).cast("string")), F.lit(""))


def piped(array) -> Column:
    """A list as text: items trimmed, blanks dropped, joined by a bar; blank for null."""
    items = F.filter(F.transform(col(array), lambda x: F.trim(x.cast("string"))), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.array_join(items, "|"), F.lit(""))


def first_filled(*columns) -> Column:
    """The first that is neither null nor blank, else blank."""
    return F.coalesce(*[F.nullif(F.trim(col(c)), F.lit("")) for c in columns], F.lit(""))


def query_key(*columns) -> Column:
    """16 hexadecimal digits that name a query, from its JSON form."""
    return F.left(F.sha2(F.to_json(F.struct(*columns)), 256), F.lit(16))
