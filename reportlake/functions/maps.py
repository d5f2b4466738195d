"""Map columns of events."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_map(pairs: Sequence[tuple[str, Column]], value_type: str) -> Column:
    """name -> value; a null value leaves the name out, of a repeated name the last value that is not null holds."""
    if not pairs:
        return F.create_map().cast(f"map<string,{value_type}>")
    latest: dict[str, Column] = {}
    for name, value in pairs:
        latest[name] = F.coalesce(value, latest[name]) if name in latest else value
    built = F.map_from_arrays(F.array(*[F.lit(n) for n in latest]), F.array(*[v.cast(value_type) for v in latest.values()]))
    return F.map_filter(built, lambda _, v: v.isNotNull())


def paired_map(pairs: Column, read: Callable[[Column], Column], value_type: str) -> Column:
    """name -> value of an array of (name, cell), under the rules of ``event_map``."""
    valued = F.transform(pairs, lambda p: F.struct(p["name"].alias("key"), read(p["cell"]).cast(value_type).alias("value")))
    held = F.filter(valued, lambda p: p["value"].isNotNull())
    # Of a repeated name the last value; headers repeat one seldom, so the search is behind a comparison of sizes.
    once = F.transform(F.array_distinct(F.transform(held, lambda p: p["key"])), lambda k: F.element_at(F.filter(held, lambda p: p["key"] == k), -1))
    built = F.when(F.size(F.array_distinct(F.transform(pairs, lambda p: p["name"]))) == F.size(pairs), F.map_from_entries(held)).otherwise(F.map_from_entries(once))
    return F.coalesce(built, F.create_map().cast(f"map<string,{value_type}>"))


def looked_up(events: Column, name: str, default: object = 0) -> Column:
    """The value of an event, or the default where the map lacks it."""
    return F.coalesce(F.try_element_at(events, F.lit(name)), F.lit(default))
