"""Waves of landed reports into the destination: parse, guard, rebuild, then the ledger.

Reports are read together, one scan for all files, so a wave of a thousand files is a few jobs. The
ledger's success rows are written after the rebuild: a crash in between pulls the days again instead of skipping them.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator, Sequence
from contextlib import ExitStack, contextmanager, nullcontext
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.functions.dates import duration_ms
from reportlake.operators.ledger import Locks, append
from reportlake.operators.parse import Context, parse_scan
from reportlake.operators.rebuild import covered_days, guarded
from reportlake.operators.store import Destination, PartialRebuild
from reportlake.schema import LEDGER, pid_of
from reportlake.sources.scan import LEVELS, reports_at


@dataclass(frozen=True)
class Landed:
    """A report that has landed, and what was asked for; without a path it has not landed."""

    path: str | None
    extract: str
    app_id: str
    report_type: str
    from_date: date
    to_date: date
    category: str = "standard"
    is_retargeting: bool = False
    currency: str | None = None
    chunk_days: int = 2
    is_long: bool = False
    api_calls: int = 1


#: Longest error text in the ledger.
EXCERPT = 300


#: Why a job without a file fails.
NOT_LANDED = "no report has landed"


def read_wave(spark: SparkSession, jobs: Sequence[Landed], run_id: str, loaded_at: datetime, keep_unknown: bool = False) -> DataFrame:
    """Destination rows with ``job`` (its place in ``jobs``).

    One scan reads all files, each by its own header. Rows carry ``_nth``, their place in the file, ``_day``, the date's cell as
    it came, and ``problem``, why a file cannot be read (its only row then).
    """
    landed = [(i, j) for i, j in enumerate(jobs) if j.path]
    places = spark.createDataFrame([(i, j.path, j.extract, j.app_id, j.report_type, j.category, j.is_retargeting, j.from_date, j.to_date, j.currency) for i, j in landed], "job int, path string, _e string, _a string, _t string, _c string, _r boolean, _from date, _to date, _hint string")
    scanned = reports_at(spark, [j.path for _, j in landed]).drop(*LEVELS).withColumnsRenamed({"nth": "_nth"}).withColumn("_day", F.col("date"))
    context = Context(F.col("_a"), F.col("_t"), F.col("_c"), F.col("_r"), F.col("_e"), run_id, loaded_at)
    # Files differ in size, and a large one is read by one task: what its cells say is worked out by row, not by file.
    dealt = scanned.join(F.broadcast(places), "path").drop("path").repartition("job", "_nth")
    return parse_scan(dealt, context, F.col("_hint"), keep_unknown, carry=("job", "_from", "_to", "_nth", "_day", "problem"))


def _after_failures(jobs: Sequence[Landed], failed: Iterable[int]) -> dict[int, str]:
    """Jobs of which an earlier chunk of the same pair failed: loading them would let the watermark pass a hole."""
    holes: dict[tuple[str, str], date] = {}
    for i in failed:
        pair = (jobs[i].extract, jobs[i].app_id)
        holes[pair] = min(jobs[i].from_date, holes.get(pair, date.max))
    return {i: "earlier chunk failed" for i, j in enumerate(jobs) if j.from_date > holes.get((j.extract, j.app_id), date.max)}


@contextmanager
def prepared(tables: Iterable[Destination], locks: Locks, now: datetime, seconds: int = 3600, force: bool = False) -> Iterator[None]:
    """Locks all tables of a run, in the order of their names, and creates or checks each; all are given back at the end.

    A table that is held or does not fit stops the run, and what was locked before it is given back.
    """
    with ExitStack() as stack:
        for table in sorted(tables, key=lambda t: t.name):
            stack.enter_context(locks.held(f"table:{table.name}", now, seconds, force))
            table.ensure()
        yield


def load_wave(spark: SparkSession, jobs: Sequence[Landed], table: Destination, ledger: str, run_id: str, now: datetime, exclude: Iterable[str] = (), allow_empty: bool = False, keep_unknown: bool = False, per_day: bool = False, locks: Locks | None = None, lock_seconds: int = 3600) -> dict[int, tuple[str, int, str | None]]:
    """Loads the reports and returns (status, rows, reason) by job: success, skipped or failed.

    The ledger gets a row of every job before (running) and after. A report that cannot be read, or has not landed, fails
    alone; a partition that cannot be replaced fails the jobs with days in it, an error before that all; chunks behind a failed one of their pair are skipped. With ``locks`` the
    table is locked meanwhile; without, the caller sees to it that no other run rebuilds it.
    """
    with prepared([table], locks, now, lock_seconds) if locks else nullcontext():
        table.ensure()
        begin = time.monotonic()
        _log(spark, jobs, dict.fromkeys(range(len(jobs)), ("running", 0, None)), ledger, run_id, now, None)
        result = _load(spark, jobs, table, run_id, now, tuple(exclude), allow_empty, keep_unknown, per_day)
        _log(spark, jobs, result, ledger, run_id, now, now + timedelta(seconds=time.monotonic() - begin))
        return result


def load_waves(spark: SparkSession, waves: Iterable[Sequence[Landed]], table: Destination, ledger: str, run_id: str, now: datetime, **options: object) -> list[dict[int, tuple[str, int, str | None]]]:
    """Wave after wave; pairs of which a chunk failed are skipped in all later waves."""
    failed: set[tuple[str, str]] = set()
    out = []
    for jobs in waves:
        stuck = [i for i, j in enumerate(jobs) if (j.extract, j.app_id) in failed]
        free = [i for i in range(len(jobs)) if i not in set(stuck)]
        result = dict.fromkeys(stuck, ("skipped", 0, "earlier chunk failed"))
        if stuck:
            _log(spark, [jobs[i] for i in stuck], {k: result[i] for k, i in enumerate(stuck)}, ledger, run_id, now, now, calls=False)
        if free:
            got = load_wave(spark, [jobs[i] for i in free], table, ledger, run_id, now, **options)
            result |= {i: got[k] for k, i in enumerate(free)}
        failed |= {(jobs[i].extract, jobs[i].app_id) for i, r in result.items() if r[0] == "failed"}
        out.append(dict(sorted(result.items())))
    return out


def _load(spark: SparkSession, jobs: Sequence[Landed], table: Destination, run_id: str, now: datetime, exclude: tuple[str, ...], allow_empty: bool, keep_unknown: bool, per_day: bool) -> dict[int, tuple[str, int, str | None]]:
    rows = read_wave(spark, jobs, run_id, now, keep_unknown).persist()
    try:
        inside, out = F.col("date").between(F.col("_from"), F.col("_to")), F.col("media_source").isin(*exclude)
        bad = F.col("date").isNull() & F.col("problem").isNull()
        first_bad = F.when(bad, F.col("_nth"))
        told = [F.max("problem").alias("problem"), F.count_if(bad).alias("bad"), F.count_if(inside & ~out).alias("n"), F.min(first_bad).alias("line"), F.min_by("_day", first_bad).alias("cell")]
        counts = rows.groupBy("job").agg(*told).collect()  # a row a job
        errors = {i: NOT_LANDED for i, j in enumerate(jobs) if not j.path}
        errors |= {r["job"]: r["problem"] or f"row {r['line']}: {r['cell'] or ''!r} is no date ({r['bad']} such rows)" for r in counts if r["problem"] or r["bad"]}
        kept = {r["job"]: r["n"] for r in counts}
        result = {i: ("failed", 0, e) for i, e in errors.items()}
        result |= {i: ("skipped", 0, why) for i, why in _after_failures(jobs, errors).items() if i not in errors}
        good = [i for i in range(len(jobs)) if i not in result]
        if good:
            asked = spark.createDataFrame([(jobs[i].extract, jobs[i].app_id, jobs[i].from_date, jobs[i].to_date, kept.get(i, 0)) for i in good], "_extract string, app_id string, from_date date, to_date date, n bigint")
            fresh = rows.where(inside & ~out & ~F.col("job").isin(list(result))).select(*[f.name for f in table.schema])
            try:
                result |= _rebuild(jobs, good, kept, table, asked, fresh, allow_empty, per_day)
            except Exception as e:  # whatever stops the rebuild fails its jobs, whose calls are spent
                result |= {i: ("failed", 0, f"rebuild: {e}") for i in good}
        return result
    finally:
        rows.unpersist()


def _rebuild(jobs: Sequence[Landed], good: list[int], kept: dict[int, int], table: Destination, asked: DataFrame, fresh: DataFrame, allow_empty: bool, per_day: bool) -> dict[int, tuple[str, int, str | None]]:
    coverage = covered_days(asked)
    # Only an answer that may be empty can meet the guard, so old rows are read for it in the partitions of such jobs alone.
    doubtful = asked.where(F.lit(not allow_empty) & (F.lit(per_day) | (F.col("n") == 0)))
    existing = table.rows(table.touched(covered_days(doubtful))).select("date", "_extract", "app_id")
    marked = guarded(coverage, existing, fresh, asked, per_day).persist()
    broken: dict[int, str] = {}
    try:
        held = set() if allow_empty else {tuple(r) for r in marked.where("guarded").select("_extract", "app_id", "date").collect()}
        table.rebuild(marked.where(F.lit(allow_empty) | ~F.col("guarded")).drop("guarded"), fresh)
    except PartialRebuild as e:  # partitions are swapped one by one: jobs of those that were are loaded
        broken = e.failed
    finally:
        marked.unpersist()
    result = {}
    for i in good:
        j = jobs[i]
        days = [j.from_date + timedelta(d) for d in range((j.to_date - j.from_date).days + 1)]
        stuck = kept.get(i, 0) == 0 and any((j.extract, j.app_id, d) in held for d in days)
        lost = next((p for p in sorted({pid_of(d, table.granularity) for d in days}) if p in broken), None)
        if lost is not None and not stuck:
            result[i] = ("failed", 0, f"rebuild of partition {lost}: {broken[lost]}")
        else:
            result[i] = ("skipped", 0, "empty answer over existing rows") if stuck else ("success", kept.get(i, 0), None)
    return result


def _log(spark: SparkSession, jobs: Sequence[Landed], result: dict[int, tuple[str, int, str | None]], ledger: str, run_id: str, start: datetime, end: datetime | None, calls: bool = True) -> None:
    rows = spark.createDataFrame([_entry(j, *result[i], run_id, start, end, calls) for i, j in enumerate(jobs)], LEDGER)
    append(rows.withColumn("duration_ms", F.when(F.col("finished_at").isNotNull(), duration_ms(F.col("started_at"), F.col("finished_at")))), ledger)


def _entry(j: Landed, status: str, n: int, reason: str | None, run_id: str, start: datetime, end: datetime | None, calls: bool) -> tuple:
    reason = reason[:EXCERPT] if reason else None
    error, skip = (reason, None) if status == "failed" else (None, reason)
    spent = j.api_calls if calls and j.path and status != "running" else 0
    return (run_id, j.extract, j.app_id, j.report_type, j.from_date, j.to_date, j.chunk_days, int(j.is_long), status, n, spent, None, start, end, None, error, skip, "1")
