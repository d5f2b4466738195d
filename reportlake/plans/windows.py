"""Which days to pull for every pair, and in which chunks and waves: DataFrames from the ledger's watermarks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reportlake.functions.dates import chunk_index, first_of_previous_month, from_ordinal, length, ordinal
from reportlake.operators.ledger import watermarks


def pairs_of(extracts: DataFrame, apps: DataFrame, default_exclude: Sequence[str] = ()) -> DataFrame:
    """One row per enabled extract and app of its choice, with the extract's columns, app_id and the app's currency.

    ``extracts``: name, platforms, apps, exclude_apps (arrays; null or empty: all, all, none), enabled (null: yes), and
    any others; ``apps``: id, platform, currency. Exclusions are the defaults and the extract's own, each once.
    """
    every = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    wanted = F.when(every("platforms"), F.array(F.lit("*"))).otherwise(F.array_distinct(F.transform("platforms", F.lower)))
    none = F.array().cast("array<string>")
    barred = F.array_distinct(F.concat(F.array(*map(F.lit, default_exclude)).cast("array<string>"), F.coalesce("exclude_apps", none)))
    asked = extracts.where(F.coalesce("enabled", F.lit(True))).withColumn("exclude_apps", barred).withColumn("_p", F.explode(wanted))
    # Apps answer to their platform and to "all", so that the pairs come from an equi-join.
    known = apps.select(F.col("id").alias("app_id"), F.coalesce("currency", F.lit("")).alias("currency"), F.explode(F.array(F.lower("platform"), F.lit("*"))).alias("_p"))
    met = asked.join(known, "_p").drop("_p")
    return met.where((every("apps") | F.array_contains("apps", F.col("app_id"))) & ~F.array_contains("exclude_apps", F.col("app_id")))


def plan_jobs(extracts: DataFrame, apps: DataFrame, loads: DataFrame, today: date, default_exclude: Sequence[str] = (), **options: object) -> DataFrame:
    """Extracts x apps x chunks: every job of a run. Start (null: the first of last month), lookback and chunk_days are
    columns of ``extracts``."""
    pairs = pairs_of(extracts, apps, default_exclude)
    marks = watermarks(loads).withColumnRenamed("extract", "name")
    windows = with_windows(pairs.join(marks, ["name", "app_id"], "left"), today, F.coalesce("start", first_of_previous_month(F.lit(today))), F.col("lookback"), **options)
    return with_chunks(windows, F.col("chunk_days"))


def with_windows(pairs: DataFrame, today: date, start: date | Column, lookback: int | Column, include_today: bool = True, first: date | None = None, last: date | None = None, full: bool = False) -> DataFrame:
    """Adds from_date and to_date to rows with a ``watermark`` (null: never loaded); empty windows go.

    The start is ``first`` if given; ``start`` on a full pull or without watermark; else the earlier of the rolling
    window's start and the days before the watermark that still settle. Never before ``start``.
    """
    end = today if include_today else today - timedelta(days=1)
    end = min(end, last) if last else end
    if first:
        begin = F.lit(first)
    elif full:
        begin = F.lit(start)
    else:
        rolling = F.least(F.date_sub(F.lit(today), lookback), F.date_sub("watermark", lookback - 1))
        begin = F.when(F.col("watermark").isNull(), F.lit(start)).otherwise(rolling)
    out = pairs.withColumns({"from_date": F.greatest(begin, F.lit(start)), "to_date": F.lit(end)})
    return out.where("from_date <= to_date")


def with_chunks(windows: DataFrame, chunk_days: int | Column, long_from: int = 3) -> DataFrame:
    """One row per chunk: wave (the chunk's index), its days clipped to the window, and whether it is a long call."""
    if isinstance(chunk_days, int) and chunk_days < 1:
        raise ValueError(f"chunk_days is at least 1, not {chunk_days}")
    every = F.sequence(chunk_index(F.col("from_date"), chunk_days), chunk_index(F.col("to_date"), chunk_days))
    out = windows.withColumn("wave", F.explode(every))
    begin, end = from_ordinal(F.col("wave") * chunk_days), from_ordinal((F.col("wave") + 1) * chunk_days - 1)
    out = out.withColumns({"from_date": F.greatest("from_date", begin), "to_date": F.least("to_date", end)})
    return out.withColumns({"days": length(F.col("from_date"), F.col("to_date"))}).withColumn("is_long", F.col("days") >= long_from)


def aligned_waves(jobs: DataFrame, chunk_days: str = "chunk_days") -> DataFrame:
    """Jobs of unequal chunk lengths with waves by date: the chunk's last day decides, in buckets of the longest length.

    Chunks of one length keep their index. A job in an earlier wave ends before every job in a later one does, so no
    job runs before one that lies wholly before it, and a wave spans less than two of the longest chunks.
    """
    longest = jobs.agg(F.max(chunk_days)).first()[0]
    if longest is None:
        return jobs
    # Of a chunk that the window cut short, the day at which it would have ended.
    end = (F.floor(ordinal(F.col("from_date")) / F.col(chunk_days)) + 1) * F.col(chunk_days) - 1
    return jobs.withColumn("wave", F.floor(end / F.lit(longest)).cast("int"))


def waves(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("wave").agg(F.count("*").alias("jobs"), F.count_if("is_long").alias("long_jobs"), F.min("from_date").alias("from_date"), F.max("to_date").alias("to_date"))


def paced(jobs: DataFrame, interval_seconds: int, app_budget: int, account_budget: int | None = None, reserve: int = 0) -> DataFrame:
    """Adds the earliest second of dispatch (one call per key and interval) and whether the long budgets hold it: the
    app's, and the account's without its ``reserve``. Waves come first, then extracts and apps by name."""
    key = W.partitionBy("app_id", "report_type").orderBy("wave", "extract")
    app = W.partitionBy("app_id", "is_long").orderBy("wave", "extract", "report_type")
    nth = F.row_number().over(app)
    out = jobs.withColumns({"not_before": (F.row_number().over(key) - 1) * interval_seconds, "in_budget": ~F.col("is_long") | (nth <= app_budget)})
    if account_budget is None:
        return out
    # Ranks over the whole account: within each wave, behind all long calls of the waves before (a row a wave).
    before = F.coalesce(F.sum("n").over(W.orderBy("wave").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    waves_ = jobs.groupBy("wave").agg(F.count_if("is_long").alias("n")).select("wave", before.alias("_before"))
    nth = F.col("_before") + F.row_number().over(W.partitionBy("wave", "is_long").orderBy("extract", "app_id", "report_type"))
    held = ~F.col("is_long") | (nth <= account_budget - reserve)
    return out.join(waves_, "wave").withColumn("in_budget", F.col("in_budget") & held).drop("_before")


def estimate(jobs: DataFrame, interval_seconds: int, seconds_per_call: int = 2) -> DataFrame:
    """One row: calls, the busiest key's calls, and the least seconds that pacing and calls take."""
    per_key = jobs.groupBy("app_id", "report_type").agg(F.count("*").alias("n"))
    out = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("calls"), F.coalesce(F.max("n"), F.lit(0)).alias("busiest"))
    return out.withColumn("seconds", F.greatest(F.col("busiest") * interval_seconds, F.col("calls") * seconds_per_call))


def budget_flags(jobs: DataFrame, used: DataFrame, app_budget: int, account_budget: int, reserve: int = 0) -> DataFrame:
    """Long calls that a plan would have made at its end, against the budgets less the reserve: (app_id, calls, budget,
    exceeds), a row for every app with long jobs and one without an app for the account.

    ``used``: (app_id, calls) made so far today, the account's total in the row without an app (``ledger.long_calls``).
    """
    planned = jobs.where("is_long").rollup("app_id").agg(F.count("*").alias("n"), F.grouping("app_id").alias("_all"))
    spent = used.select("app_id", F.col("calls").alias("_used"))
    met = planned.join(spent, planned["app_id"].eqNullSafe(spent["app_id"]), "left").select(planned["app_id"], "n", "_all", F.coalesce("_used", F.lit(0)).alias("_used"))
    budget = F.when(F.col("_all") == 1, account_budget).otherwise(app_budget) - reserve
    calls = F.col("n") + F.col("_used")
    return met.select("app_id", calls.alias("calls"), budget.alias("budget"), (calls > budget).alias("exceeds"))


def render(jobs: DataFrame, used: DataFrame, interval_seconds: int, app_budget: int, account_budget: int, reserve: int = 0) -> list[str]:
    """The plan as text: extracts, budgets with EXCEEDS where one is passed, and the least time."""
    name = "name" if "name" in jobs.columns else "extract"
    by = jobs.groupBy(name).agg(F.count_distinct("app_id").alias("apps"), F.min("from_date").alias("a"), F.max("to_date").alias("b"), F.count("*").alias("n"), F.count_if("is_long").alias("l"))
    lines = [f"{r[name]}: apps={r['apps']} window={r['a']}..{r['b']} chunks={r['n']} long_calls={r['l']}" for r in by.orderBy(name).collect()]
    flags = budget_flags(jobs, used, app_budget, account_budget, reserve).orderBy(F.asc_nulls_first("app_id")).collect()
    told = lambda r: f"{'account' if r['app_id'] is None else 'app ' + r['app_id']} long calls: {r['calls']} / {r['budget']}" + " EXCEEDS" * r["exceeds"]
    lines += [told(r) for r in flags]
    whole = estimate(jobs if "report_type" in jobs.columns else jobs.withColumn("report_type", F.lit("daily")), interval_seconds).first()
    return [*lines, f"total calls: {whole['calls']} ({sum(r['calls'] for r in flags if r['app_id'] is None)} long with those made); at least {whole['seconds'] / 60:.1f} min"]
