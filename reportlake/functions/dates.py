"""Date and chunk arithmetic as columns. Chunks are anchored to day 1 of year 1, not to 1970."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: ordinal of 1970-01-01 counted from 0001-01-01 = 1.
EPOCH_ORDINAL = 719163


def ordinal(day: Column) -> Column:
    return F.unix_date(day) + EPOCH_ORDINAL


def from_ordinal(n: Column) -> Column:
    return F.date_from_unix_date((n - EPOCH_ORDINAL).cast("int"))


def chunk_index(day: Column, chunk_days: int | Column) -> Column:
    return F.floor(ordinal(day) / F.lit(chunk_days)).cast("int")


def days_between(first: Column, last: Column) -> Column:
    """All days from first to last; an empty array if they are the wrong way round or null."""
    none = F.array().cast("array<date>")
    return F.coalesce(F.when(first <= last, F.sequence(first, last)), none)


def length(first: Column, last: Column) -> Column:
    return F.datediff(last, first) + 1


def first_of_previous_month(day: Column) -> Column:
    return F.trunc(F.add_months(day, -1), "MM")


def duration_ms(start: Column, end: Column) -> Column:
    """Milliseconds from start to end, never negative."""
    return F.greatest(F.timestamp_diff("MILLISECOND", start, end), F.lit(0))
