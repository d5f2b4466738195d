"""What a run did, from its ledger rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAILURES = 10


def totals(loads: DataFrame) -> DataFrame:
    """One row per extract and one (null) for all: jobs by status, rows, calls, and the days they span."""
    each = [F.count_if(F.col("status") == s).alias(s) for s in ("success", "failed", "skipped")]
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("rows", "api_calls")]
    done = loads.where("status <> 'running'")
    return done.rollup("extract").agg(*each, *sums, F.min("from_date").alias("from_date"), F.max("to_date").alias("to_date"))


def to_json(loads: DataFrame, run_id: str) -> str:
    """The run as one document: status, totals per extract, and the first failures."""
    mine = loads.where(F.col("run_id") == run_id)
    by = {r["extract"]: r.asDict() for r in totals(mine).collect()}
    failed = mine.where("status = 'failed'").orderBy("from_date", "extract", "app_id").limit(FAILURES)
    failures = [r.asDict() for r in failed.select("extract", "app_id", "from_date", "to_date", "error").collect()]
    whole = by.pop(None, {})
    return json.dumps({"run_id": run_id, "ok": not failures, "total": whole, "extracts": list(by.values()), "failures": failures}, default=str)
