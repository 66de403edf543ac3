"""Text functions. Patterns run in Java's dialect with Unicode classes where white space matters."""

from __future__ import annotations

import html
import re
from html.entities import html5

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from .ids import col


def spaced(c) -> Column:
    """No-break spaces as spaces, so that patterns agree in every dialect."""
    return F.translate(col(c), " ", " ")


def as_re2(pattern: str) -> str:
    """A pattern with the word boundaries and white space that RE2 knows: those of ASCII, with form feed but without
    vertical tab. Java's own boundaries are of Unicode before JDK 19. Inside brackets, only white space is allowed. A boundary beside a letter
    of the pattern needs one look only."""
    pattern = re.sub(r"\\b(?=[A-Za-z0-9](?![?*{]))", r"(?<!\\w)", pattern)
    pattern = re.sub(r"(?<!\\)([A-Za-z0-9])\\b", r"\1(?!\\w)", pattern)
    return pattern.replace(r"\b", r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))").replace(r"\s", r"[ \t\n\f\r]")


def first_group(c, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null, not blank, if there is none."""
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def matches(c, pattern: str) -> Column:
    """Null-safe rlike."""
    return F.coalesce(col(c).rlike(pattern), F.lit(False))


def n_matches(c, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(col(c), F.lit(pattern)), F.lit(0)).cast("long")


def n_patterns(c, patterns) -> Column:
    """How many of the patterns match at all."""
    return sum((matches(c, p).cast("long") for p in patterns), F.lit(0).cast("long"))


#: Spaces of any kind (Unicode's Zs), for the ends of a text.
SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


def words(c) -> Column:
    """Words between white space; empty for a blank text. Spaces of any kind at the ends go."""
    return F.filter(F.split(F.btrim(col(c), F.lit(SPACES)), r"\s+"), lambda x: x != "")


def n_capital(c) -> Column:
    """How many words begin with a capital; null for null."""
    return F.size(F.filter(words(c), lambda x: x.rlike(r"^\p{Lu}")))


def capital_share(c) -> Column:
    """Share of words that begin with a capital; null without words."""
    own = words(c)
    return F.when(F.size(own) > 0, n_capital(c) / F.size(own))


def all_capitals(c) -> Column:
    c = col(c)
    return (c == F.upper(c)) & c.rlike(r"\p{L}")


def mode_text(array) -> Column:
    """The most frequent item of an array, the first seen if several; null if empty."""
    array = col(array)
    counted = F.transform(F.array_distinct(array), lambda x: F.struct(F.size(F.filter(array, lambda y: y == x)).alias("n"), (-F.array_position(array, x)).alias("at"), x.alias("item")))
    return F.array_max(counted)["item"]


def by_value(f, kind: str):
    """A function of columns that applies f to each value, by Arrow batches. The type is parsed at
    the call, when there is a session."""

    def applied(c) -> Column:
        @F.pandas_udf(kind)
        def run(values: pd.Series) -> pd.Series:
            return values.map(f)

        return run(col(c))

    return applied


def by_text(f, kind: str):
    """Like by_value, for long texts: only one text of an Arrow batch at a time is a Python string."""

    def applied(c) -> Column:
        to = to_arrow_type(DataType.fromDDL(kind))

        @F.arrow_udf(kind)
        def run(values: pa.Array) -> pa.Array:
            return pa.array((f(x.as_py()) for x in values), to)

        return run(col(c))

    return applied


def by_record(f, kind: str):
    """Like by_value, for an f that gives a dict of the fields of a struct. It is declared not to be
    deterministic, so that no use of a field, above all in a filter, has f applied once more."""

    def applied(c) -> Column:
        @F.pandas_udf(kind)
        def run(values: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([f(x) for x in values]) if len(values) else pd.DataFrame([f("")]).iloc[:0]

        return run.asNondeterministic()(col(c))

    return applied


#: Character references decoded.
unescaped = by_value(lambda x: None if x is None else html.unescape(x), "string")


def closed_references(text: str) -> str:
    """Character references that end with a semicolon decoded; one that is cut short stays."""
    return re.sub(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|([A-Za-z][A-Za-z0-9]*));", lambda m: m[0] if m[1] and m[1] + ";" not in html5 else html.unescape(m[0]), text)


unescaped_if_closed = by_value(lambda x: None if x is None else closed_references(x), "string")


def percent(part, whole, digits: int = 1) -> Column:
    """A share as text; blank without a whole."""
    return F.when(col(whole) != 0, F.concat(F.format_number(100.0 * col(part) / col(whole), digits), F.lit("%"))).otherwise("")


def grouped(n) -> Column:
    """A whole number with commas between thousands."""
    return F.format_number(col(n).cast("bigint"), 0)


def without_scripts(c) -> Column:
    return F.regexp_replace(col(c), r"(?is)<(script|style)[^>]*>.*?</\1>", " ")


def without_tags(c) -> Column:
    """The first half of lines_of_html: scripts and tags go, references are as they were."""
    c = F.regexp_replace(without_scripts(c), r"(?i)</?(p|div|tr|h[1-6]|li|br|table)[^>]*>", "\n")
    return F.regexp_replace(c, r"(?s)<[^>]+>", " ")


#: White space of Unicode, as Java's patterns have it.
WHITE = SPACES + "\t\n\x0b\x0c\r\x85\u2028\u2029"


def lines_of_rest(text: str) -> str:
    """The second half of lines_of_html, in Python."""
    text = re.sub(r"[ \t]+", " ", html.unescape(text))
    return re.sub(r"\n{3,}", "\n\n", text).strip(WHITE)


def lines_of_html(c, decoded=unescaped) -> Column:
    """Text of a page with a line for each block: scripts go, block tags become line ends, other
    tags spaces; references are decoded after that, so a decoded "<" stays. decoded: how."""
    c = F.regexp_replace(F.regexp_replace(decoded(without_tags(c)), r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def flat_html(c, width: int | None = 600) -> Column:
    """Text of a page on one line, references as they are, and no more than width characters."""
    c = F.trim(F.regexp_replace(F.regexp_replace(without_scripts(c), "<[^>]+>", " "), r"\s+", " "))
    return c if width is None else F.left(c, F.lit(width))


def flat_html_without_references(c) -> Column:
    """Text of a page on one line, scripts too; named and decimal references become spaces."""
    c = F.regexp_replace(F.regexp_replace(col(c), "<[^>]+>", " "), "(?i)&(?:[a-z]+|#[0-9]+);", " ")
    return F.trim(F.regexp_replace(c, r"\s+", " "))
