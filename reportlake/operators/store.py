"""The destination as a partitioned Parquet table whose partitions are swapped by location.

A rebuild writes all touched partitions in one job into a new version folder, then points each partition there:
readers that have planned a query keep the old files. ``vacuum`` deletes versions that no partition points to.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportlake.functions.names import qualified
from reportlake.operators.rebuild import rebuilt
from reportlake.schema import COVERAGE, DESTINATION, GRANULARITIES, SORT_KEY, partition_id, schema_problems


#: Rows of one task of a rebuild, which it sorts, and of the file it writes.
ROWS_PER_SLICE = 250_000


def held(rows: DataFrame) -> bool:
    """Whether rows come from the cache already."""
    return rows.is_cached or "InMemoryRelation" in rows._jdf.queryExecution().withCachedData().toString()


class PartialRebuild(RuntimeError):
    """Some partitions point to their new files (``done``), others could not be made to (``failed``: error by partition)."""

    def __init__(self, done: list[tuple[int, int, int, str]], failed: dict[int, str]) -> None:
        super().__init__("; ".join(f"partition {p}: {e}" for p, e in failed.items()))
        self.done, self.failed = done, failed


class Destination:
    def __init__(self, spark: SparkSession, name: str, root: str, granularity: str = "month", schema: T.StructType = DESTINATION, day: str = "date", keys: Sequence[str] = COVERAGE, sort: Sequence[str] = SORT_KEY, rows_per_slice: int = ROWS_PER_SLICE) -> None:
        if granularity not in GRANULARITIES:
            raise ValueError(f"granularity is {' or '.join(GRANULARITIES)}, not {granularity!r}")
        self.spark, self.name, self.root, self.granularity = spark, qualified(name), root.rstrip("/"), granularity
        self.schema, self.day, self.keys, self.sort, self.rows_per_slice = schema, day, tuple(keys), tuple(sort), rows_per_slice

    def ensure(self) -> None:
        """Creates the table, or checks its columns and granularity; never alters it."""
        if "." in self.name:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.name.split('.')[0]}")
        if not self.spark.catalog.tableExists(self.name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            self.spark.sql(f"CREATE TABLE {self.name} ({columns}, pid INT) USING parquet PARTITIONED BY (pid) LOCATION '{self.root}/table' TBLPROPERTIES ('granularity' = '{self.granularity}')")
            return
        problems = schema_problems(self.spark.table(self.name).schema, self.schema, self.name)
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        if found.get("granularity") != self.granularity:
            problems.append(f"partitioned by {found.get('granularity')}, expected {self.granularity}")
        if problems:
            raise ValueError(f"{self.name}: " + "; ".join(problems))

    def partitions(self) -> set[int]:
        return {int(r[0].split("=")[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()}

    def touched(self, coverage: DataFrame) -> list[int]:
        """Ids of the partitions that covered days fall in."""
        pid = partition_id(self.day, self.granularity).alias("pid")
        return sorted(r[0] for r in coverage.select(pid).distinct().collect())

    def rows(self, pids: Sequence[int] | None = None) -> DataFrame:
        out = self.spark.table(self.name)
        return out if pids is None else out.where(F.col("pid").isin(*pids) if pids else F.lit(False))

    def count(self, *conditions: Column | str) -> int:
        """Rows that meet all conditions; those on ``pid`` prune."""
        rows = self.rows()
        for c in conditions:
            rows = rows.where(c)
        return rows.count()

    def drop_partition(self, pid: int) -> bool:
        """Drops a partition; False if there is none."""
        there = pid in self.partitions()
        if there:
            self._swap(pid, "drop", "")
            self.spark.catalog.refreshTable(self.name)
        return there

    def rebuild(self, coverage: DataFrame, fresh: DataFrame) -> list[tuple[int, int, int, str]]:
        """Replaces the covered keys by ``fresh``: (partition, kept, fresh, action) of every partition touched.

        Fresh rows in a partition that the coverage does not touch are an error: they would not replace anything. If
        partitions cannot be pointed to their new files, the others still are, and ``PartialRebuild`` names both.
        """
        names = [f.name for f in self.schema]
        pid = partition_id(self.day, self.granularity).alias("pid")
        keyed = coverage.select(*dict.fromkeys((self.day, *self.keys))).distinct()
        # Read once: its rows are counted, sampled for the ranges, and written from here; a coverage made of them reads them here too.
        mine = None if held(fresh) else fresh.persist()
        # Read once: its keys tell the partitions, and then which old rows stay.
        covered = coverage if held(coverage) else keyed.persist()
        try:
            touched = self.touched(covered)
            came = self._came(fresh, touched)
            n = sum(r["n"] for r in came)
            if not touched and not n:
                return []
            if stray := [r for r in came if r["stray"]]:
                first = min((r["pid"] for r in stray if r["pid"] is not None), default=None)
                raise ValueError(f"{sum(r['n'] for r in stray)} fresh rows outside the covered partitions, the first in {first}")
            here = self.partitions()
            there = [p for p in touched if p in here]
            # Of partitions that the table lacks nothing is read: where it has none of them, the fresh rows meet no coverage.
            state = rebuilt(self.rows(there).select(*names), covered, fresh.select(*names), self.keys).withColumn("pid", pid)
            version = f"{self.root}/versions/{uuid.uuid4().hex}"
            old = self.rows(there).count() if there else 0
            counts = self._write(state, there, version, n + old) if there or n else {}
        finally:
            if covered is not coverage:
                covered.unpersist()
            if mine is not None:
                mine.unpersist()
        fresh_in = {r["pid"]: r["n"] for r in came if r["pid"] is not None}
        done, failed = [], {}
        for p in touched:
            kept, new = counts.get(p, 0), fresh_in.get(p, 0)
            action = "replace" if kept + new else "drop" if p in here else "noop"
            try:
                self._swap(p, action, version)
                done.append((p, kept, new, action))
            except Exception as e:  # one partition's failure leaves the others as they are told
                failed[p] = str(e)
        self.spark.catalog.refreshTable(self.name)
        if failed:
            raise PartialRebuild(done, failed)
        return done

    def slices(self, rows: int) -> int:
        """Tasks, and about as many files, that rows are written by."""
        return max(1, -(-rows // self.rows_per_slice))

    def _came(self, fresh: DataFrame, touched: Sequence[int]) -> list[Row]:
        """Fresh rows by partition, and whether it is ``stray``: not one of those touched. A row a partition."""
        stray = ~F.col("pid").isin(*touched) if touched else F.lit(True)
        pid = partition_id(self.day, self.granularity).alias("pid")
        return fresh.select(pid).groupBy("pid").agg(F.count("*").alias("n")).withColumn("stray", stray).collect()

    def _write(self, state: DataFrame, there: Sequence[int], version: str, rows: int) -> dict[int, int]:
        """Writes the new state, and counts the kept rows of the partitions that are there as they pass, so that nothing is read again.

        It is dealt by ranges of partition and sort key, whose bounds Spark samples: an app that fills most of a
        partition is cut at its days, sources and so on, and at last by a hash of the row.
        """
        plain = [f"`{f.name}`" for f in self.schema if not isinstance(f.dataType, T.MapType)]
        by = ["pid", *self.sort, F.xxhash64(*plain)]
        dealt = state.repartitionByRange(self.slices(rows), *by).sortWithinPartitions("pid", *self.sort)
        # Every row pays for every expression, so there are none for partitions that have no rows to keep.
        counted = [F.count_if((F.col("pid") == p) & ~F.col("is_fresh")).alias(str(p)) for p in there]
        seen = Observation()
        watched = dealt.observe(seen, *counted) if counted else dealt
        watched.drop("is_fresh").write.partitionBy("pid").parquet(version)
        return {p: seen.get[str(p)] for p in there}

    def _swap(self, p: int, action: str, version: str) -> None:
        if action == "replace":
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS PARTITION (pid = {p})")
            self.spark.sql(f"ALTER TABLE {self.name} PARTITION (pid = {p}) SET LOCATION '{version}/pid={p}'")
        elif action == "drop":
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (pid = {p})")

    def vacuum(self) -> int:
        """Deletes the version folders that no partition points to, and says how many; run it when no query reads them."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        used = set()
        for p in self.partitions():
            told = self.spark.sql(f"DESCRIBE FORMATTED {self.name} PARTITION (pid = {p})").where("col_name = 'Location'")
            used |= {r["data_type"].rstrip("/").rsplit("/", 2)[1] for r in told.collect()}  # the partition's, and the table's
        root = jvm.org.apache.hadoop.fs.Path(f"{self.root}/versions")
        store = root.getFileSystem(conf)
        old = [f.getPath() for f in store.listStatus(root) if f.getPath().getName() not in used] if store.exists(root) else []
        for path in old:
            store.delete(path, True)
        return len(old)
