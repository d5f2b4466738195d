"""Waves of landed files end to end, locks, selection, summary."""

import json
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from reportlake.operators import ledger, load
from reportlake.operators.load import Landed, load_wave, load_waves, prepared, read_wave
from reportlake.operators.store import Destination
from reportlake.plans.selection import selected
from reportlake.plans.summary import to_json

NOW = datetime(2026, 9, 5, 8)
HEAD = "Date,Country,Media Source (pid),Campaign (c),Installs,buy (Event counter),buy (Sales in EUR)\n"


@pytest.fixture
def lake(spark, tmp_path):
    t = Destination(spark, f"d{uuid.uuid4().hex}", f"file://{tmp_path}/dest")
    t.ensure()
    yield t, f"file://{tmp_path}/ledger", tmp_path
    spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def land(folder, name, body):
    path = folder / f"{name}.csv"
    path.write_text(body)
    return f"file://{path}"


def wave(folder, tag, a, b="", c=None):
    d1, d2 = date(2026, 9, 1), date(2026, 9, 2)
    jobs = [Landed(land(folder, f"{tag}a", HEAD + a), "std", "app1", "daily", d1, d2), Landed(land(folder, f"{tag}b", HEAD + b), "std", "app2", "daily", d1, d2)]
    return jobs + ([Landed(land(folder, f"{tag}c", c), "fb", "app1", "daily", d1, d2)] if c is not None else [])


def state(t):
    return sorted((r["app_id"], str(r["date"]), r["media_source"], r["installs"], r["event_sales"].get("buy"), r["currency"]) for r in t.rows().collect())


def test_waves(spark, lake):
    t, loads, folder = lake
    first = wave(folder, "1", "2026-09-01,US,x,c,5,1,9.5\n2026-09-02,US,x,c,6,,\n2026-10-09,US,late,c,1,1,1\n", "2026-09-01,DE,y,c,7,2,3\n", "Date,Country\nbad,US\n")
    assert load_wave(spark, first, t, loads, "r1", NOW, exclude=["none"]) == {0: ("success", 2, None), 1: ("success", 1, None), 2: ("failed", 0, "row 2: 'bad' is no date (1 such rows)")}
    one = [("app1", "2026-09-01", "x", 5, 9.5, "EUR"), ("app1", "2026-09-02", "x", 6, None, "EUR"), ("app2", "2026-09-01", "y", 7, 3.0, "EUR")]
    assert state(t) == one
    load_wave(spark, first, t, loads, "r2", NOW)
    assert state(t) == one  # again changes nothing
    second = wave(folder, "2", "2026-09-01,US,x,c,50,1,1\n", "")
    assert load_wave(spark, second, t, loads, "r3", NOW) == {0: ("success", 1, None), 1: ("skipped", 0, "empty answer over existing rows")}
    assert state(t) == [("app1", "2026-09-01", "x", 50, 1.0, "EUR"), one[2]]
    assert load_wave(spark, second, t, loads, "r4", NOW, allow_empty=True)[1] == ("success", 0, None)
    assert state(t) == [("app1", "2026-09-01", "x", 50, 1.0, "EUR")]
    marks = {(r["extract"], r["app_id"]): r["watermark"] for r in ledger.watermarks(ledger.read_loads(spark, loads)).collect()}
    assert marks == {("std", "app1"): date(2026, 9, 2), ("std", "app2"): date(2026, 9, 2)}
    doc = json.loads(to_json(ledger.read_loads(spark, loads), "r1"))
    assert not doc["ok"] and doc["total"]["success"] == 2 and doc["failures"][0]["extract"] == "fb"


def test_ledger_rows_before_and_after(spark, lake):
    t, loads, folder = lake
    ledger.ensure(spark, loads)
    assert ledger.read_loads(spark, loads).count() == 0
    load_wave(spark, wave(folder, "1", "2026-09-01,US,x,c,5,1,9\n", c="Country\nUS\n"), t, loads, "r", NOW)
    rows = ledger.read_loads(spark, loads).collect()
    assert sorted(r["status"] for r in rows) == ["failed", "running", "running", "running", "success", "success"]
    assert all((r["finished_at"] is None) == (r["status"] == "running") == (r["duration_ms"] is None) for r in rows)
    assert all(r["duration_ms"] >= 0 and r["api_calls"] == 1 for r in rows if r["status"] != "running")


def test_row_number_of_a_bad_date(spark, lake):
    t, loads, folder = lake
    jobs = wave(folder, "1", "2026-09-01,US,x,c,5,,\n2026-09-02,US,x,c,5,,\n2026-9-3,US,x,c,5,,\nlater,US,x,c,1,,\n")
    got = load_wave(spark, jobs, t, loads, "r", NOW)
    assert got[0] == ("failed", 0, "row 4: '2026-9-3' is no date (2 such rows)") and got[1][0] == "success"


def test_a_failed_chunk_holds_back_later_chunks_of_its_pair(spark, lake):
    t, loads, folder = lake
    job = lambda name, body, app, day: Landed(land(folder, name, HEAD + body), "std", app, "daily", date(2026, 9, day), date(2026, 9, day))
    good = lambda day: f"2026-09-0{day},US,x,c,{day},,\n"
    waves = [[job("a1", "never,US,x,c,1,,\n", "app1", 1), job("b1", good(1), "app2", 1), job("a2", good(2), "app1", 2)], [job("a3", good(3), "app1", 3), job("b2", good(2), "app2", 2)]]
    got = load_waves(spark, waves, t, loads, "r", NOW)
    assert [[r[0] for r in w.values()] for w in got] == [["failed", "success", "skipped"], ["skipped", "success"]]
    assert [(s[0], s[3]) for s in state(t)] == [("app2", 1), ("app2", 2)]
    rows = ledger.read_loads(spark, loads)
    assert {(r["app_id"], str(r["watermark"])) for r in ledger.watermarks(rows).collect()} == {("app2", "2026-09-02")}
    assert rows.where("status = 'skipped' AND skip_reason = 'earlier chunk failed'").count() == 2


def test_a_rebuild_error_fails_its_jobs(spark, lake, monkeypatch):
    t, loads, folder = lake
    monkeypatch.setattr(t, "rebuild", lambda *a: 1 / 0)
    got = load_wave(spark, wave(folder, "1", "2026-09-01,US,x,c,5,,\n"), t, loads, "r", NOW)
    assert [r[0] for r in got.values()] == ["failed", "failed"] and got[0][2].startswith("rebuild: division")
    assert ledger.read_loads(spark, loads).where("status = 'failed' AND api_calls = 1").count() == 2


def test_the_table_is_locked_meanwhile(spark, lake):
    t, loads, folder = lake
    mine, other = (ledger.Locks(spark, f"file://{folder}/locks", r, "me") for r in ("r1", "r2"))
    assert other.acquire(f"table:{t.name}", NOW, 600)
    jobs = wave(folder, "1", "2026-09-01,US,x,c,5,,\n")
    with pytest.raises(ledger.LockHeld, match="r2"):
        load_wave(spark, jobs, t, loads, "r1", NOW, locks=mine)
    assert state(t) == []
    later = NOW + timedelta(seconds=5)
    assert other.release(f"table:{t.name}", later)
    load_wave(spark, jobs, t, loads, "r1", later + timedelta(seconds=5), locks=mine)
    assert len(state(t)) == 1 and mine.holder(f"table:{t.name}", later) is None


def test_tables_of_a_run_are_locked_together(spark, lake):
    t, _, folder = lake
    other = Destination(spark, f"e{uuid.uuid4().hex}", f"file://{folder}/other")
    mine, theirs = (ledger.Locks(spark, f"file://{folder}/locks", r, "me") for r in ("r1", "r2"))
    with prepared([t, other], mine, NOW):
        assert all(mine.holder(f"table:{x.name}", NOW)["run_id"] == "r1" for x in (t, other))
        assert other.rows().count() == 0
    assert theirs.acquire(f"table:{other.name}", NOW, 600)
    with pytest.raises(ledger.LockHeld), prepared([t, other], mine, NOW):
        raise AssertionError
    assert mine.holder(f"table:{t.name}", NOW) is None
    spark.sql(f"DROP TABLE {other.name}")


def test_guard_by_day_and_vacuum(spark, lake):
    t, loads, folder = lake
    load_wave(spark, wave(folder, "1", "2026-09-01,US,x,c,5,,\n2026-09-02,US,x,c,6,,\n"), t, loads, "r1", NOW)
    load_wave(spark, wave(folder, "2", "2026-09-01,US,x,c,7,,\n"), t, loads, "r2", NOW, per_day=True)
    assert [(s[1], s[3]) for s in state(t)] == [("2026-09-01", 7), ("2026-09-02", 6)]
    plan = t.rows(t.touched(spark.sql("SELECT DATE '2026-09-01' AS date")))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pid" in plan
    assert t.vacuum() == 1 and len(state(t)) == 2 and t.vacuum() == 0


def test_the_guard_reads_only_what_it_can_hold_back(spark, lake, monkeypatch):
    """Old rows are read for it in partitions of jobs that brought nothing; where all brought rows (and none is asked by the day) in none."""
    t, loads, folder = lake
    months = [(date(2026, 9, 1), date(2026, 9, 2)), (date(2026, 10, 1), date(2026, 10, 2))]

    def jobs(tag, *bodies):
        return [Landed(land(folder, f"{tag}{k}", HEAD + b), "std", f"app{k}", "daily", *days) for k, (days, b) in enumerate(zip(months, bodies))]

    full = ["2026-09-01,US,x,c,1,,\n", "2026-10-01,US,x,c,2,,\n"]
    load_wave(spark, jobs("a", *full), t, loads, "r1", NOW)
    read, guard = [], load.guarded
    monkeypatch.setattr(load, "guarded", lambda coverage, existing, *a: read.append(existing.count()) or guard(coverage, existing, *a))
    assert [r[0] for r in load_wave(spark, jobs("b", *full), t, loads, "r2", NOW).values()] == ["success"] * 2 and read == [0]
    assert load_wave(spark, jobs("c", full[0], ""), t, loads, "r3", NOW) == {0: ("success", 1, None), 1: ("skipped", 0, "empty answer over existing rows")} and read == [0, 1]
    assert [r[0] for r in load_wave(spark, jobs("d", *full), t, loads, "r4", NOW, per_day=True).values()] == ["success"] * 2 and read == [0, 1, 2]
    assert t.rows().agg(F.sum("installs")).first()[0] == 3
    # Jobs that overlap: the empty one's days are guarded, but the other's answer replaces those that it covers too.
    two = [Landed(land(folder, "e0", HEAD), "std", "app0", "daily", *months[0]), Landed(land(folder, "e1", HEAD + "2026-09-03,US,y,c,5,,\n"), "std", "app0", "daily", date(2026, 9, 1), date(2026, 9, 3))]
    assert load_wave(spark, two, t, loads, "r5", NOW) == {0: ("skipped", 0, "empty answer over existing rows"), 1: ("success", 1, None)}
    assert {r["installs"] for r in t.rows([202609]).collect()} == {5}


def test_run_ids_sort_by_time():
    a, b = ledger.new_run_id(NOW), ledger.new_run_id(datetime(2026, 9, 5, 9))
    assert a < b and a.startswith("20260905T080000Z-") and len(a) == len(b) == 23


def test_broken_reports_fail_alone(spark, lake):
    t, loads, folder = lake
    jobs = wave(folder, "1", "2026-09-01,US,x,c,5,1,9\n", c="Country\nUS\n")
    jobs.append(Landed(land(folder, "empty", ""), "e", "app1", "daily", date(2026, 9, 1), date(2026, 9, 1)))
    got = load_wave(spark, jobs, t, loads, "r", NOW)
    assert [got[i][0] for i in range(4)] == ["success", "success", "failed", "failed"] and len(state(t)) == 1


def test_locks(spark, tmp_path):
    at = lambda m: datetime(2026, 9, 1, 8, m)
    a, b = (ledger.Locks(spark, f"file://{tmp_path}/locks", r, "me") for r in ("r1", "r2"))
    assert a.acquire("t", at(0), 600) and not b.acquire("t", at(5), 600)
    assert not b.release("t", at(6)) and b.acquire("t", at(11), 600)  # stale after the holder's own timeout
    assert not a.acquire("t", at(12), 600) and a.acquire("t", at(13), 600, force=True)
    assert a.release("t", at(14)) and not a.release("t", at(15)) and a.holder("t", at(16)) is None


def test_selection(spark):
    df = spark.createDataFrame([("a_one", "x/a.yml", ["daily"]), ("b_two", "y/b.yml", None), (None, None, ["daily"])], "name string, path string, tags array<string>")
    names = lambda *s: {r["name"] for r in selected(df, *s, path="path", tags="tags").collect()}
    assert names("*") == {"a_one", "b_two"} and names("tag:daily") == {"a_one", None}
    assert names("y/* a_*", "tag:daily") == {"b_two"} and names("[ab]_t?o") == {"b_two"}


def test_rows_of_one_large_report_are_dealt(spark, tmp_path):
    """Cells are worked out by row: no task has all of a report, though one task reads its file."""
    path = land(tmp_path, "big", HEAD + "".join(f"2026-09-01,US,s{i},c,1,1,1\n" for i in range(4000)))
    jobs = [Landed(path, "std", "app1", "daily", date(2026, 9, 1), date(2026, 9, 2))]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = read_wave(spark, jobs, "r", NOW)
        most = rows.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert most[1] == 4000 and most[0] < 2000


def test_a_rebuild_of_a_large_report_has_several_tasks(lake):
    assert lake[0].slices(1_500_000) >= 6
