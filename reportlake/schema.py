"""Schemas: the destination of normalised reports, the load ledger and the locks.

Dimensions are never null (blank instead), metrics are null when missing, map columns hold no null values.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportlake.functions.names import quoted

# The destination's columns in their contractual order.
DIMENSIONS = ("agency", "media_source", "campaign", "campaign_name", "campaign_id", "adset", "adset_id", "adgroup", "adgroup_id", "country")
COUNTS = ("impressions", "clicks", "installs", "sessions", "loyal_users")
METRICS = ("impressions", "clicks", "ctr", "installs", "conversion_rate", "sessions", "loyal_users", "loyal_users_rate", "total_revenue", "total_cost", "roi", "arpu", "average_ecpi")
MAPS = {"event_unique_users": "bigint", "event_counter": "bigint", "event_sales": "double", "extra": "string"}
SORT_KEY = ("app_id", "date", "media_source", "campaign", "adset_id", "adgroup_id", "country")
#: The grain at which a rebuild replaces rows.
COVERAGE = ("date", "_extract", "app_id")
GRANULARITIES = {"month": "yyyyMM", "day": "yyyyMMdd"}


def _fields() -> list[T.StructField]:
    text = lambda n: T.StructField(n, T.StringType(), False)
    out = [text("app_id"), T.StructField("date", T.DateType(), False), text("report_type"), text("category"), T.StructField("is_retargeting", T.IntegerType(), False)]
    out += [text(n) for n in (*DIMENSIONS, "currency")]
    out += [T.StructField(n, T.LongType() if n in COUNTS else T.DoubleType(), True) for n in METRICS]
    kinds = {"bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}
    out += [T.StructField(n, T.MapType(T.StringType(), kinds[k], False), False) for n, k in MAPS.items()]
    return [*out, text("_extract"), text("_run_id"), T.StructField("_loaded_at", T.TimestampNTZType(), False)]


DESTINATION = T.StructType(_fields())
COLUMN_NAMES = tuple(DESTINATION.names)

LEDGER = "run_id string, extract string, app_id string, report_type string, from_date date, to_date date, chunk_days int, is_long tinyint, status string, rows bigint, api_calls int, http_status int, started_at timestamp_ntz, finished_at timestamp_ntz, duration_ms bigint, error string, skip_reason string, engine_version string"
LOCKS = "lock_key string, run_id string, status string, owner string, started_at timestamp_ntz, updated_at timestamp_ntz, timeout_seconds int"


def partition_id(day: Column | str, granularity: str = "month") -> Column:
    """Integer partition id of a date: 202609 by month, 20260901 by day."""
    return F.date_format(day, GRANULARITIES[granularity]).cast("int")


def pid_of(day: date, granularity: str = "month") -> int:
    """``partition_id`` of one day, on the driver."""
    return int(f"{day.year:04d}{day.month:02d}" + (f"{day.day:02d}" if granularity == "day" else ""))


def alter_text(table: str, found: T.StructType, expected: T.StructType = DESTINATION) -> str | None:
    """The statement that adds a table's missing columns; None if it has all. ``table`` is a quoted name."""
    there = {f.name for f in found}
    missing = [f"{f.name if f.name.isidentifier() else quoted(f.name)} {f.dataType.simpleString()}" for f in expected if f.name not in there]
    return f"ALTER TABLE {table} ADD COLUMNS ({', '.join(missing)})" if missing else None


def schema_problems(found: T.StructType, expected: T.StructType = DESTINATION, table: str = "t") -> list[str]:
    """Missing and mistyped columns of a table; columns beyond the expected ones are fine."""
    types = {f.name: f.dataType for f in found}
    out = []
    for f in expected:
        if f.name not in types:
            out.append(f"missing column {f.name}: {alter_text(table, found, T.StructType([f]))}")
        elif not _alike(types[f.name], f.dataType):
            out.append(f"column {f.name} is {types[f.name].simpleString()}, expected {f.dataType.simpleString()}")
    return out


def _alike(a: T.DataType, b: T.DataType) -> bool:
    return a.simpleString() == b.simpleString()
