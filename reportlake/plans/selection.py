"""Which extracts a run is about."""

from __future__ import annotations

import fnmatch
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def selected(extracts: DataFrame, select: str = "*", exclude: str = "", name: str = "name", path: str | None = None, tags: str | None = None) -> DataFrame:
    """Rows that any selector matches and no exclusion does.

    Selectors are split at commas and spaces: ``*`` for all, ``tag:x`` for a tag (column of arrays), else a glob over
    the name or the path.
    """
    return extracts.where(_any(select, name, path, tags) & ~_any(exclude, name, path, tags))


def _any(selectors: str, name: str, path: str | None, tags: str | None) -> Column:
    out = F.lit(False)
    for s in re.split(r"[,\s]+", selectors):
        if s.startswith("tag:"):
            out |= F.coalesce(F.array_contains(tags, s[4:]), F.lit(False)) if tags else F.lit(False)
        elif s:
            pattern = fnmatch.translate(s).replace(r"\z", r"\Z")
            for c in filter(None, (name, path)):
                out |= F.coalesce(F.col(c).rlike("^" + pattern), F.lit(False))
    return out
