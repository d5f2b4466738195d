"""Names of media sources, compared without case and punctuation, and of tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_name(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def prefixes(c: Column) -> Column:
    """All beginnings of a name, itself included: turns a prefix join into an equi-join."""
    none = F.array().cast("array<string>")
    return F.coalesce(F.when(F.length(c) > 0, F.transform(F.sequence(F.lit(1), F.length(c)), lambda n: F.substring(c, F.lit(1), n))), none)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def qualified(name: str) -> str:
    """A quoted ``table`` or ``database.table``; anything else is an error."""
    parts = name.split(".")
    if len(parts) > 2 or not all(p.strip() for p in parts):
        raise ValueError(f"not a table name: {name!r}")
    return ".".join(quoted(p.strip()) for p in parts)
