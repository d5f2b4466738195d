"""A plan carried out: its jobs met with the reports that have landed, and loaded wave by wave."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.operators.load import Landed, load_waves
from reportlake.operators.store import Destination, held
from reportlake.plans.windows import aligned_waves
from reportlake.sources.scan import LEVELS, landed_files

OUTCOME = "extract string, app_id string, report_type string, from_date date, to_date date, wave int, state string, status string, rows bigint, reason string"


def matched(plan: DataFrame, files: DataFrame) -> DataFrame:
    """The plan's jobs with ``path`` and ``state``: landed, missing, or unasked for a report of no job.

    ``plan``: the five columns that name a landed report, and any others. Of several files of one job the last
    written holds, of those of one moment the last by path. One full join on all five columns.
    """
    last = files.groupBy(*LEVELS).agg(F.max_by(F.struct("path", "bytes"), F.struct("modified", "path")).alias("_f"))
    last = last.select(*LEVELS, "_f.path", "_f.bytes", F.lit(True).alias("_there"))
    met = plan.withColumn("_asked", F.lit(True)).join(last, list(LEVELS), "full")
    state = F.when(F.col("_asked").isNull(), "unasked").when(F.col("_there").isNull(), "missing").otherwise("landed")
    return met.withColumn("state", state).drop("_asked", "_there")


def asked_files(spark: SparkSession, plan: DataFrame, root: str) -> DataFrame:
    """The listing of a root, of the plan's days and extracts only; the filters reach the listing."""
    span = plan.agg(F.min("from_date").alias("a"), F.max("to_date").alias("b"), F.collect_set("extract").alias("e")).first()
    files = landed_files(spark, root)
    if span["a"] is None:
        return files.where("false")
    return files.where(F.col("extract").isin(span["e"]) & (F.col("to_date") >= F.lit(span["a"])) & (F.col("from_date") <= F.lit(span["b"])))


def jobs_of(plan: DataFrame) -> DataFrame:
    """``plan_jobs``' rows as jobs: ``extract`` for its name, a report type, the wave of ``aligned_waves``."""
    kind = F.coalesce("report_type", F.lit("daily")) if "report_type" in plan.columns else F.lit("daily")
    named = plan.withColumnRenamed("name", "extract").withColumn("report_type", kind)
    optional = [c for c in ("category", "is_retargeting") if c in plan.columns]
    return aligned_waves(named).select(*LEVELS, "wave", "currency", "chunk_days", "is_long", *optional)


def carry_out(spark: SparkSession, plan: DataFrame, root: str, table: Destination, ledger: str, run_id: str, now: datetime, unasked: bool = False, **options: object) -> DataFrame:
    """Loads what has landed of a plan (``plan_jobs``) below ``root``: a row a job, (state, status, rows, reason).

    Waves run in the order of their days. A job without a report fails as ``no report has landed``, and so holds back
    the later chunks of its pair; rows take the app's currency where their report names none. With ``unasked``
    the whole root is listed, and reports of no job are told too. The driver holds a row a job, as the plan's scheduler must; no row of a report.
    ``options`` are those of ``load_wave``.
    """
    # Read once, from the ledger and the app list: for the longest chunk, the days asked for and the jobs, which the driver holds afterwards.
    mine = None if held(plan) else plan.persist()
    try:
        jobs = jobs_of(plan)
        files = landed_files(spark, root) if unasked else asked_files(spark, jobs, root)
        rows = matched(jobs, files).orderBy("wave", *LEVELS).collect()
    finally:
        if mine is not None:
            mine.unpersist()
    waves: dict[int, list[Landed]] = {}
    for r in rows:
        if r["state"] != "unasked":
            waves.setdefault(r["wave"], []).append(_landed(r.asDict()))
    results = load_waves(spark, waves.values(), table, ledger, run_id, now, **options)
    told = {(w, i): v for w, result in zip(waves, results) for i, v in result.items()}
    nth: dict[int, int] = {}
    out = []
    for r in rows:
        given: Sequence = (None, None, None)
        if r["state"] != "unasked":
            given = told[r["wave"], nth.setdefault(r["wave"], 0)]
            nth[r["wave"]] += 1
        out.append((*(r[c] for c in LEVELS), r["wave"], r["state"], *given))
    return spark.createDataFrame(out, OUTCOME)


def _landed(r: dict) -> Landed:
    days = (r["from_date"], r["to_date"])
    return Landed(r["path"], r["extract"], r["app_id"], r["report_type"], *days, r.get("category") or "standard", bool(r.get("is_retargeting")), r["currency"], r["chunk_days"], r["is_long"])
