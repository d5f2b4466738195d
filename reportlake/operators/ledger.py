"""The load ledger (append only) and rows of locks (the latest of a key holds), read by Spark."""

from __future__ import annotations

import json
import re
import secrets
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reportlake.files import files_at
from reportlake.operators.locks import LockHeld, Locks
from reportlake.schema import LEDGER

__all__ = ["LockHeld", "Locks", "active_locks", "append", "compact", "contiguous_watermarks", "ensure", "latest", "long_calls", "new_run_id", "read_loads", "recent", "sweep", "watermarks"]


def watermarks(loads: DataFrame) -> DataFrame:
    """Per (extract, app_id): the last day of its successful loads. Pairs without any have no row."""
    return loads.where("status = 'success'").groupBy("extract", "app_id").agg(F.max("to_date").alias("watermark"))


def contiguous_watermarks(loads: DataFrame, start: Column) -> DataFrame:
    """Like ``watermarks``, but only up to the first day from ``start`` on that no successful load covers."""
    spans = loads.where("status = 'success'").select("extract", "app_id", "from_date", "to_date").where(F.col("to_date") >= start)
    pair = W.partitionBy("extract", "app_id").orderBy("from_date", "to_date").rowsBetween(W.unboundedPreceding, -1)
    reach = F.coalesce(F.max("to_date").over(pair), F.date_sub(start, 1))
    gaps = spans.withColumn("gap", F.col("from_date") > F.date_add(reach, 1)).withColumn("holes", F.sum(F.col("gap").cast("int")).over(pair.rowsBetween(W.unboundedPreceding, 0)))
    return gaps.where("holes = 0").groupBy("extract", "app_id").agg(F.max("to_date").alias("watermark"))


def long_calls(loads: DataFrame, since: Column) -> DataFrame:
    """Calls of long loads per app since a moment, and their total as the row without an app."""
    long_ = loads.where((F.col("is_long") == 1) & (F.col("status") != "running") & (F.col("started_at") >= since))
    return long_.rollup("app_id").agg(F.coalesce(F.sum("api_calls"), F.lit(0)).alias("calls"))


def recent(loads: DataFrame, n: int, *ties: str) -> DataFrame:
    """The last ``n`` loads, newest first."""
    return loads.orderBy(F.desc("started_at"), *ties).limit(n)


def latest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of every key, by a max over structs: partial aggregates, no sort of whole keys."""
    rest = [c for c in rows.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(key).agg(best.alias("_r")).select(key, "_r.*")


def active_locks(locks: DataFrame, now: Column) -> DataFrame:
    """Held locks with age and staleness. Collapses before it filters: a released key must not show its old row."""
    held = latest(locks, "lock_key", "updated_at", "run_id").where("status = 'running'")
    age = F.timestamp_diff("SECOND", F.col("updated_at"), now)
    return held.withColumns({"age_seconds": age, "stale": age > F.col("timeout_seconds")})


def append(rows: DataFrame, path: str) -> None:
    """Adds rows to a ledger or lock folder; earlier rows are never touched."""
    rows.coalesce(1).write.mode("append").parquet(path)


def ensure(spark: SparkSession, path: str, schema: str = LEDGER) -> None:
    """Makes an empty ledger or lock folder, so that it can be read before the first row."""
    append(spark.createDataFrame([], schema), path)


#: Folders of a ledger that Spark's readers pass over: lists of what holds, and merged files.
MANIFESTS, MERGED = "_manifests", "_merged"


def _state(spark: SparkSession, path: str) -> tuple[int, list[str], set[str], list[str]]:
    """The last manifest's number, the merged files it names, the names of files merged so far, and all other files."""
    files = files_at(spark, path)
    numbers = sorted(int(n.split(".")[0]) for n in files.names(MANIFESTS) if re.fullmatch(r"\d+\.json", n))
    last = numbers[-1] if numbers else 0
    told = json.loads(files.read(f"{MANIFESTS}/{last:012d}.json")[0]) if last else {"merged": [], "gone": []}
    gone = set(told["gone"])
    return last, told["merged"], gone, sorted(n for n in files.names("") if n[0] not in "._" and n not in gone)


def read_loads(spark: SparkSession, path: str, schema: str = LEDGER) -> DataFrame:
    """All rows of a ledger: merged files, and what has been added since."""
    _, merged, _, fresh = _state(spark, path)
    names = [*merged, *fresh]
    return spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in names]) if names else spark.createDataFrame([], schema)


def compact(spark: SparkSession, path: str, schema: str = LEDGER, rows_per_file: int = 5_000_000) -> bool:
    """Merges the files of a ledger into few; False if there was nothing to merge or another merge came first.

    Appends go on meanwhile: a file that is not named as merged is read beside the merged ones. The manifest is created
    exclusively, so of two merges one holds. Readers that have planned keep the old files until ``sweep``.
    """
    last, merged, gone, fresh = _state(spark, path)
    if not fresh or len(fresh) + len(merged) < 2:
        return False
    rows = spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in (*merged, *fresh)])
    folder = f"{MERGED}/{uuid.uuid4().hex}"
    rows.repartition(max(1, -(-rows.count() // rows_per_file))).write.parquet(f"{path}/{folder}")
    files = files_at(spark, path)
    told = {"merged": [f"{folder}/{n}" for n in sorted(files.names(folder)) if n[0] not in "._"], "gone": sorted(gone | set(fresh))}
    if files.create(f"{MANIFESTS}/{last + 1:012d}.json", json.dumps(told)):
        return True
    for name in told["merged"]:
        files.delete(name)
    return False


def sweep(spark: SparkSession, path: str) -> int:
    """Deletes files that have been merged, and says how many; run it when no query reads them."""
    files, (last, merged, gone, _) = files_at(spark, path), _state(spark, path)
    # Only what an earlier manifest names: a merge that is still being written has none yet.
    earlier = sorted(n for n in files.names(MANIFESTS) if re.fullmatch(r"\d+\.json", n))[:-1]
    replaced = {m for n in earlier for m in json.loads(files.read(f"{MANIFESTS}/{n}")[0])["merged"]} - set(merged)
    there = [n for n in files.names("") if n in gone] + sorted(replaced)
    for name in there:
        files.delete(name)
    if last and gone:  # what is gone need not be named any longer
        if files.create(f"{MANIFESTS}/{last + 1:012d}.json", json.dumps({"merged": merged, "gone": []})):
            for n in earlier:
                files.delete(f"{MANIFESTS}/{n}")
    return len(there)


def new_run_id(now: datetime) -> str:
    """Sorts by time; six random hexadecimal digits tell runs of one second apart."""
    return f"{now:%Y%m%dT%H%M%SZ}-{secrets.token_hex(3)}"
