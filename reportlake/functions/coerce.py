"""Cells of reports, which are all text, as typed columns. Built-in expressions only; nothing here raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the cell that means nothing. A dimension keeps the words None, null and - as they are.
EMPTY_MARK = "^N/A$"
#: What Python's float() takes, short of underscores, nan and infinities.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
#: The same, but a minus only before zero. No marker of a null (N/A, null, None, NULL, -) matches either.
COUNT = r"^(?:[+]?([0-9]+\.?[0-9]*|\.[0-9]+)|-(0+\.?0*|\.0+))([eE][+-]?[0-9]+)?$"
DAY = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}$"


#: Unicode white space.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def trimmed(c: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.btrim(c, F.lit(SPACES))


def _bare(c: Column, signs: str) -> Column:
    for s in signs:
        c = F.replace(c, F.lit(s), F.lit(""))
    return c


# Each cell is one chain of calls without branches: Spark evaluates what a branch repeats once more for every mention.


def to_text(c: Column) -> Column:
    """A dimension: trimmed; blank for null and for empty markers."""
    return F.coalesce(F.regexp_replace(trimmed(c), EMPTY_MARK, ""), F.lit(""))


def to_number(c: Column) -> Column:
    """A rate or an amount: separators, percent and dollar signs go, percents are not scaled; null if unreadable."""
    value = F.regexp_extract(trimmed(_bare(c, ",%$")), NUMBER, 0).try_cast("double")
    return F.get(F.filter(F.array(value), lambda v: F.abs(v) < float("inf")), F.lit(0))


def to_count(c: Column) -> Column:
    """A non-negative whole number, cut at the point; null if unreadable, negative or over 2**63 - 1."""
    return F.regexp_extract(_bare(trimmed(c), ","), COUNT, 0).try_cast("double").try_cast("bigint")


def to_day(c: Column) -> Column:
    """A yyyy-MM-dd date; null for anything else, which fails the whole report."""
    return F.regexp_extract(trimmed(c), DAY, 0).try_cast("date")
