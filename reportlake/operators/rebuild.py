"""Idempotent partition rebuild: partition := (old rows outside the coverage) + fresh rows.

Rows are never deduplicated: k equal rows stay k rows. Rebuilding twice with the same input gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.functions.dates import days_between
from reportlake.schema import COVERAGE


def kept_rows(old: DataFrame, coverage: DataFrame, keys: Sequence[str] = COVERAGE) -> DataFrame:
    """Old rows that no coverage key replaces; an empty coverage keeps all."""
    return old.join(coverage.select(*keys).distinct(), list(keys), "left_anti").select(*old.columns)


def rebuilt(old: DataFrame, coverage: DataFrame, fresh: DataFrame, keys: Sequence[str] = COVERAGE) -> DataFrame:
    """The new state, with ``is_fresh``."""
    kept = kept_rows(old, coverage, keys).withColumn("is_fresh", F.lit(False))
    return kept.unionByName(fresh.withColumn("is_fresh", F.lit(True)))


def actions(old: DataFrame, state: DataFrame, pid: str = "pid") -> DataFrame:
    """Per partition: rows kept and fresh, and what happens: replace, drop (it becomes empty) or noop."""
    was = old.groupBy(pid).agg(F.count("*").alias("n_old"))
    now = state.groupBy(pid).agg(F.count_if(~F.col("is_fresh")).alias("kept"), F.count_if("is_fresh").alias("fresh"))
    both = was.join(now, pid, "full").select(pid, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_old", "kept", "fresh")])
    action = F.when(F.col("kept") + F.col("fresh") > 0, "replace").when(F.col("n_old") > 0, "drop").otherwise("noop")
    return both.withColumn("action", action)


def covered_days(jobs: DataFrame) -> DataFrame:
    """(date, _extract, app_id) for every day of successful jobs (_extract, app_id, from_date, to_date)."""
    return jobs.select(F.explode(days_between(F.col("from_date"), F.col("to_date"))).alias("date"), "_extract", "app_id").distinct()


def guarded(coverage: DataFrame, existing: DataFrame, fresh: DataFrame, jobs: DataFrame, per_day: bool = False) -> DataFrame:
    """Coverage with ``guarded``: days that an empty answer must not erase.

    A day is guarded if it has rows now and its whole job brought none (``per_day``: if the day brought none). All
    counts come from one aggregation each.
    """
    keys = list(COVERAGE)
    has = existing.join(coverage.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.count("*").alias("n_existing"))
    day_fresh = fresh.groupBy(*keys).agg(F.count("*").alias("n_fresh"))
    spans = jobs.select("_extract", "app_id", "from_date", "to_date", F.explode(days_between(F.col("from_date"), F.col("to_date"))).alias("date"))
    if not per_day:
        job = ["_extract", "app_id", "from_date", "to_date"]
        total = spans.join(day_fresh, keys, "left").groupBy(*job).agg(F.coalesce(F.sum("n_fresh"), F.lit(0)).alias("n_fresh"))
        day_fresh = spans.join(total, job).select(*keys, "n_fresh")
    out = coverage.join(has, keys, "left").join(day_fresh, keys, "left")
    empty = (F.coalesce("n_existing", F.lit(0)) > 0) & (F.coalesce("n_fresh", F.lit(0)) == 0)
    return out.select(*keys, empty.alias("guarded"))
