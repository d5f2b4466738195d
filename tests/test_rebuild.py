"""The store: rebuild, drop, noop, guard, idempotence; ledger and locks; plans; stream."""

import uuid
from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reportlake.operators import ledger, rebuild
from reportlake.operators.store import Destination
from reportlake.plans import checks, windows
from reportlake.schema import LEDGER, LOCKS
from reportlake.streaming.incremental import landed, late_counts, rebuild_from_stream

ROW = "date date, _extract string, app_id string, media_source string, event_counter map<string,bigint>"


@pytest.fixture
def make(spark, tmp_path):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(ROW)
    made = []

    def build(granularity="month", name=None):
        t = Destination(spark, name or f"t{uuid.uuid4().hex}", f"file://{tmp_path}/dest", granularity, schema, sort=("app_id", "date"))
        t.ensure()
        made.append(t)
        return t

    yield build
    for t in made:
        spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def rows(spark, *values):
    return spark.createDataFrame([(date.fromisoformat(d), e, a, m, {}) for d, e, a, m in values], ROW)


def cover(spark, *values):
    return spark.createDataFrame([(date.fromisoformat(d), e, a) for d, e, a in values], "date date, _extract string, app_id string")


def state(t):
    return sorted(map(tuple, t.rows().select(F.col("date").cast("string"), "_extract", "app_id", "media_source").collect()))


OLD = [("2026-09-01", "fb", "app1", "old"), ("2026-09-01", "fb", "app2", "old"), ("2026-09-02", "fb", "app1", "old"), ("2026-09-01", "std", "app1", "old"), ("2026-09-01", "std", "app1", "old"), ("2026-08-31", "fb", "app1", "old")]


def loaded(spark, t):
    first = rows(spark, *OLD)
    t.rebuild(first.select("date", "_extract", "app_id").distinct(), first)
    return t


def test_only_covered_keys_change_and_again_is_the_same(spark, make):
    t = loaded(spark, make())
    fresh = rows(spark, ("2026-09-01", "fb", "app1", "new"))
    for _ in range(2):
        assert t.rebuild(cover(spark, ("2026-09-01", "fb", "app1")), fresh) == [(202609, 4, 1, "replace")]
        assert state(t) == sorted([("2026-09-01", "fb", "app1", "new"), *OLD[1:]])


def test_covered_without_fresh_ends_empty_and_drop_and_noop(spark, make):
    t = loaded(spark, make())
    none = rows(spark, OLD[0]).where("false")
    assert t.rebuild(cover(spark, ("2026-08-31", "fb", "app1"), ("2026-07-01", "fb", "app1")), none) == [(202607, 0, 0, "noop"), (202608, 0, 0, "drop")]
    assert state(t) == sorted(OLD[:5]) and t.partitions() == {202609}
    assert t.rebuild(cover(spark), none) == []


def test_month_straddling_duplicates_and_maps(spark, make):
    t = make()
    both = rows(spark, ("2026-08-31", "e", "a", "x"), ("2026-08-31", "e", "a", "x"), ("2026-09-01", "e", "a", "x")).withColumn("event_counter", F.create_map(F.lit("k"), F.lit(1).cast("long")))
    assert t.rebuild(cover(spark, ("2026-08-31", "e", "a"), ("2026-09-01", "e", "a")), both) == [(202608, 0, 2, "replace"), (202609, 0, 1, "replace")]
    assert len(state(t)) == 3 and {tuple(r[0].items()) for r in t.rows().select("event_counter").collect()} == {(("k", 1),)}


def test_day_grain_is_isolated(spark, make):
    t = loaded(spark, make("day"))
    t.rebuild(cover(spark, ("2026-09-02", "fb", "app1")), rows(spark, OLD[0]).where("false"))
    assert t.partitions() == {20260831, 20260901}


def test_stray_rows_and_mismatches_are_errors(spark, make):
    t = loaded(spark, make())
    with pytest.raises(ValueError, match="outside"):
        t.rebuild(cover(spark, ("2026-09-01", "fb", "app1")), rows(spark, ("2026-10-01", "fb", "app1", "x")))
    with pytest.raises(ValueError, match="partitioned by month"):
        make("day", t.name.strip("`"))
    with pytest.raises(ValueError, match="granularity"):
        Destination(spark, "x", "/tmp", "week")


def watched(spark, frame):
    """The rows, and how many have been read of them."""
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return frame.mapInArrow(passed, frame.schema), seen


def test_coverage_is_read_once(spark, make):
    t = loaded(spark, make())
    keys, seen = watched(spark, cover(spark, ("2026-09-01", "fb", "app1"), ("2026-09-01", "fb", "app1"), ("2026-09-02", "fb", "app1")))
    assert t.rebuild(keys, rows(spark, ("2026-09-01", "fb", "app1", "new"))) == [(202609, 3, 1, "replace")] and seen.value == 3


def test_coverage_made_of_the_fresh_rows_reads_them_once(spark, make):
    t = loaded(spark, make())
    fresh, seen = watched(spark, rows(spark, ("2026-09-01", "fb", "app1", "new"), ("2026-10-01", "fb", "app1", "new")))
    assert t.rebuild(fresh.select("date", "_extract", "app_id").distinct(), fresh) == [(202609, 4, 1, "replace"), (202610, 0, 1, "replace")] and seen.value == 2


def test_rows_are_watched_only_for_partitions_that_are_there(spark, make, monkeypatch):
    t, frame, given = make(), type(spark.range(0)), []
    observe = frame.observe
    monkeypatch.setattr(frame, "observe", lambda self, seen, *e: given.append(len(e)) or observe(self, seen, *e))
    assert loaded(spark, t).partitions() == {202608, 202609} and given == []
    t.rebuild(cover(spark, ("2026-09-01", "fb", "app1"), ("2026-10-01", "fb", "app1")), rows(spark, ("2026-10-01", "fb", "app1", "x")))
    assert given == [1] and len(state(t)) == 6


def test_null_keys_and_repeated_rows(spark, make):
    t, day = make(), date(2026, 9, 1)
    old = spark.createDataFrame([(day, None, "a", "x", None), (day, None, "a", "x", None), (day, "e", None, None, {}), (day, "e", "a", "x", {})], ROW)
    keys = old.select("date", "_extract", "app_id")
    t.rebuild(keys, old)
    # A null key covers nothing, so its rows stay; a fresh row without a day has no partition and is in none.
    fresh = spark.createDataFrame([(day, "e", None, "y", {}), (day, "e", "a", "y", {}), (day, "e", "a", "y", {}), (None, "e", "a", "y", {})], ROW)
    assert t.rebuild(keys, fresh) == [(202609, 3, 3, "replace")]
    stored = t.rows().groupBy("_extract", "app_id", "media_source").agg(F.count("*").alias("n")).collect()
    assert sorted(map(str, map(tuple, stored))) == sorted(map(str, [(None, "a", "x", 2), ("e", None, None, 1), ("e", None, "y", 1), ("e", "a", "y", 2)]))
    with pytest.raises(ValueError, match="1 fresh rows outside the covered partitions, the first in None"):
        t.rebuild(keys.where("false"), fresh.where("date is null"))


def test_pruning_by_partition(spark, make):
    t = loaded(spark, make())
    plan = t.rows([202609])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "pid" in plan.split("PartitionFilters: [")[1]


def test_guard(spark):
    jobs = spark.createDataFrame([("e", "a", date(2026, 9, 1), date(2026, 9, 2)), ("e", "b", date(2026, 9, 1), date(2026, 9, 2))], "_extract string, app_id string, from_date date, to_date date")
    old = rows(spark, ("2026-09-01", "e", "a", "x"), ("2026-09-01", "e", "b", "x"), ("2026-09-02", "e", "b", "x"))
    fresh = rows(spark, ("2026-09-01", "e", "b", "y"))
    coverage = rebuild.covered_days(jobs)
    assert coverage.count() == 4
    found = lambda **o: {(str(r[0]), r[2]) for r in rebuild.guarded(coverage, old, fresh, jobs, **o).where("guarded").collect()}
    assert found() == {("2026-09-01", "a")}
    assert found(per_day=True) == {("2026-09-01", "a"), ("2026-09-02", "b")}


def test_ledger(spark):
    base = ("r", "e", "app1", "t", date(2026, 9, 1), date(2026, 9, 3), 3, 1, "success", 5, 2, 200, datetime(2026, 9, 4, 1), datetime(2026, 9, 4, 2), 1, None, None, "0")
    running = (*base[:8], "running", *base[9:])
    later = (*base[:4], date(2026, 9, 6), date(2026, 9, 7), *base[6:])
    other = (*base[:2], "app2", *base[3:8], "failed", 0, 1, *base[11:])
    loads = spark.createDataFrame([base, running, later, other], LEDGER)
    assert [tuple(r) for r in ledger.watermarks(loads).collect()] == [("e", "app1", date(2026, 9, 7))]
    assert [r["watermark"] for r in ledger.contiguous_watermarks(loads, F.lit(date(2026, 9, 1))).collect()] == [date(2026, 9, 3)]
    calls = {r["app_id"]: r["calls"] for r in ledger.long_calls(loads, F.lit(datetime(2026, 9, 4))).collect()}
    assert calls == {"app1": 4, "app2": 1, None: 5}
    assert ledger.watermarks(loads.where("false")).isEmpty()


def test_locks(spark):
    at = lambda h: datetime(2026, 9, 1, h)
    locks = spark.createDataFrame([("t", "r1", "running", "o", at(1), at(1), 3600), ("t", "r1", "released", "o", at(1), at(2), 3600), ("u", "r2", "running", "o", at(1), at(1), 60)], LOCKS)
    assert [(r["lock_key"], r["age_seconds"], r["stale"]) for r in ledger.active_locks(locks, F.lit(at(3)).cast("timestamp_ntz")).collect()] == [("u", 7200, True)]


TODAY, START = date(2026, 9, 22), date(2026, 1, 1)


@pytest.mark.parametrize(
    ("mark", "options", "expected"),
    [
        (None, {}, (START, TODAY)),
        ("2026-09-21", {}, (date(2026, 9, 19), TODAY)),
        ("2026-09-01", {}, (date(2026, 8, 30), TODAY)),
        ("2026-09-21", {"full": True}, (START, TODAY)),
        ("2026-09-21", {"include_today": False}, (date(2026, 9, 19), date(2026, 9, 21))),
        ("2026-09-21", {"first": date(2025, 1, 1)}, (START, TODAY)),
        ("2026-09-21", {"last": date(2026, 9, 1)}, None),
    ],
)
def test_windows(spark, mark, options, expected):
    pairs = spark.createDataFrame([("e", date.fromisoformat(mark) if mark else None)], "extract string, watermark date")
    got = windows.with_windows(pairs, TODAY, START, 3, **options).collect()
    assert [(r["from_date"], r["to_date"]) for r in got] == ([expected] if expected else [])


@settings(max_examples=20, deadline=None)
@given(st.dates(date(2000, 1, 1), date(2030, 1, 1)), st.integers(0, 40), st.integers(1, 9))
def test_every_day_is_in_one_chunk(spark, first, days, n):
    last = date.fromordinal(first.toordinal() + days)
    got = windows.with_chunks(spark.createDataFrame([(first, last)], "from_date date, to_date date"), n).orderBy("wave").collect()
    listed = [d for r in got for d in range(r["from_date"].toordinal(), r["to_date"].toordinal() + 1)]
    assert listed == list(range(first.toordinal(), last.toordinal() + 1))
    assert all(r["wave"] == r["from_date"].toordinal() // n == r["to_date"].toordinal() // n for r in got)


def test_prefix_owners(spark):
    names = spark.createDataFrame([("Face-Book",), ("facebook ads",), ("google",), ("--",), (None,)], "n string")
    assert [tuple(r) for r in checks.owner_overlaps(names, "n").collect()] == [("Face-Book", "facebook ads")]


def test_stream_rebuilds(spark, make, tmp_path):
    t = make()
    source = tmp_path / "landing"
    for media in ("first", "second"):
        rows(spark, ("2026-09-01", "e", "a", media)).write.mode("append").parquet(str(source))
        q = rebuild_from_stream(landed(spark, str(source), ROW), t, str(tmp_path / "checkpoint"))
        q.awaitTermination(120)
    assert state(t) == [("2026-09-01", "e", "a", "second")]


def test_late_counts(spark, tmp_path):
    spark.createDataFrame([("a", datetime(2026, 1, 1, 0, 1)), ("a", datetime(2026, 1, 1, 0, 2)), ("b", datetime(2026, 1, 1, 1, 0))], "k string, ts timestamp").write.parquet(str(tmp_path / "in"))
    counted = late_counts(landed(spark, str(tmp_path / "in"), "k string, ts timestamp"), "ts", "k", "10 minutes", "5 minutes")
    q = counted.writeStream.format("memory").queryName("late").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r["k"], r["n"]) for r in spark.table("late").collect()} == {("a", 2)}
