"""Advisory locks by exclusive creation of files.

A lock's state is the file of its highest generation. Every change (taking it, taking over a stale one, giving it back)
creates the next generation's file, which must not exist: of any number of runs that have seen the same state, one succeeds,
and the others look again. So no two runs hold a lock, whatever the order of their steps.

Local and shared folders link a finished file to its name, which fails if the name is taken. Other stores create the file
through Hadoop without overwriting, which is atomic on HDFS and on stores with conditional creation; a file that is not
written to its end counts as held until ``UNFINISHED`` seconds old.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta
from typing import Any
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.files import files_at
from reportlake.schema import LOCKS

UNFINISHED = 600


class LockHeld(RuntimeError):
    """Another run holds the lock."""


class Locks:
    """The locks below a folder, as one run sees them."""

    def __init__(self, spark: SparkSession, path: str, run_id: str, owner: str) -> None:
        self.spark, self.path, self.run_id, self.owner = spark, path.rstrip("/"), run_id, owner
        self.files = files_at(spark, self.path)

    def rows(self) -> DataFrame:
        """The last states of all locks, with ``generation``: all but the latest may be gone."""
        if not self.keys():
            return self.spark.createDataFrame([], f"{LOCKS}, generation bigint")
        return self.spark.read.schema(f"{LOCKS}, generation bigint").option("recursiveFileLookup", True).json(self.path)

    def active(self, now: datetime) -> DataFrame:
        """Held locks of all keys, with age and staleness."""
        last = self.rows().groupBy("lock_key").agg(F.max_by(F.struct("*"), "generation").alias("r")).select("r.*").where("status = 'running'")
        age = F.timestamp_diff("SECOND", F.col("updated_at"), F.lit(now).cast("timestamp_ntz"))
        return last.withColumns({"age_seconds": age, "stale": age > F.col("timeout_seconds")})

    def keys(self) -> list[str]:
        return sorted(unquote(n) for n in self.files.names("") if not n.startswith("."))

    def _generations(self, key: str) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in self.files.names(quote(key, safe="")) if re.fullmatch(r"\d+\.json", n))

    def _name(self, key: str, generation: int) -> str:
        return f"{quote(key, safe='')}/{generation:012d}.json"

    def _latest(self, key: str) -> tuple[int, dict | None]:
        """The highest generation and its state; None if nobody has ever held the key."""
        while found := self._generations(key):
            try:
                text, written = self.files.read(self._name(key, found[-1]))
            except FileNotFoundError:
                continue  # a later one has come, and this one is gone
            try:
                row = json.loads(text)
            except ValueError:
                row = {"lock_key": key, "run_id": None, "status": "running", "owner": None, "started_at": written.replace(tzinfo=None).isoformat(), "timeout_seconds": UNFINISHED}
                row["updated_at"] = row["started_at"]
            return found[-1], row
        return 0, None

    def _next(self, key: str, generation: int, status: str, now: datetime, timeout: int) -> bool:
        """Makes the state after ``generation``; False if it is not the last any more."""
        at = now.isoformat()
        row = {"lock_key": key, "run_id": self.run_id, "status": status, "owner": self.owner, "started_at": at, "updated_at": at, "timeout_seconds": timeout, "generation": generation + 1}
        if not self.files.create(self._name(key, generation + 1), json.dumps(row)):
            return False
        found = self._generations(key)
        if found[-1] > generation + 1:  # so old a state that its successor had been cleared away
            self.files.delete(self._name(key, generation + 1))
            return False
        for old in found:
            if old < generation:
                self.files.delete(self._name(key, old))
        return True

    def holder(self, key: str, now: datetime) -> dict | None:
        """Who holds the key, with age and staleness by the holder's own timeout."""
        _, row = self._latest(key)
        if row is None or row["status"] != "running":
            return None
        row = row | {c: datetime.fromisoformat(row[c]) for c in ("started_at", "updated_at")}
        age = int((now - row["updated_at"]).total_seconds())
        return row | {"age_seconds": age, "stale": age > row["timeout_seconds"]}

    def acquire(self, key: str, now: datetime, timeout: int, force: bool = False) -> bool:
        """Takes a free or stale lock (``force``: any), or renews its own; False if another run holds it."""
        while True:
            generation, row = self._latest(key)
            if row and row["status"] == "running" and row["run_id"] != self.run_id and not force:
                age = (now - datetime.fromisoformat(row["updated_at"])).total_seconds()
                if int(age) <= row["timeout_seconds"]:
                    return False
            if self._next(key, generation, "running", now, timeout):
                return True

    def release(self, key: str, now: datetime, force: bool = False) -> bool:
        """Gives the lock back; only the run that holds it may, or anyone with ``force``. False if none was held."""
        while True:
            generation, row = self._latest(key)
            if not row or row["status"] != "running" or (row["run_id"] != self.run_id and not force):
                return False
            if self._next(key, generation, "released", now, row["timeout_seconds"]):
                return True

    @contextmanager
    def held(self, key: str, now: datetime, timeout: int, force: bool = False) -> Iterator[Any]:
        """Holds the lock inside; an error if another run has it. It is given back whatever happens inside."""
        if not self.acquire(key, now, timeout, force):
            holder = self.holder(key, now) or {}
            raise LockHeld(f"{key} is held by run {holder.get('run_id')} of {holder.get('owner')} for {holder.get('age_seconds')} seconds")
        begin = time.monotonic()
        try:
            yield
        finally:
            self.release(key, now + timedelta(seconds=time.monotonic() - begin))
