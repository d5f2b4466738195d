"""Ledger merges, complete app lists, budgets of a plan, table changes, replayed streams."""

import json
import uuid
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportlake.operators import ledger
from reportlake.plans import windows
from reportlake.schema import DESTINATION, alter_text
from reportlake.sources import landing

SMALL = "run_id string, rows bigint"


def add(folder, first, n=1):
    for k in range(first, first + n):
        pq.write_table(pa.table({"run_id": [f"r{k}"], "rows": pa.array([k], pa.int64())}), folder / f"part-{uuid.uuid4().hex}.parquet")


def held(spark, path):
    return sorted(r["rows"] for r in ledger.read_loads(spark, path, SMALL).collect())


def test_a_thousand_appends_are_merged(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}"
    add(tmp_path, 0, 1000)
    before = ledger.read_loads(spark, path, SMALL)  # a reader that has planned
    create = ledger.files_at(spark, path).create

    def during(self, name, text):
        add(tmp_path, 1000, 5)  # appends before the manifest is there
        return create(name, text)

    with monkeypatch.context() as m:
        m.setattr(type(ledger.files_at(spark, path)), "create", during)
        assert ledger.compact(spark, path, SMALL)
    add(tmp_path, 1005, 3)
    assert held(spark, path) == list(range(1008))
    assert len(ledger.read_loads(spark, path, SMALL).inputFiles()) == 1 + 8
    assert before.count() == 1000
    assert ledger.sweep(spark, path) == 1000 and held(spark, path) == list(range(1008))
    assert ledger.compact(spark, path, SMALL) and not ledger.compact(spark, path, SMALL)
    assert len(ledger.read_loads(spark, path, SMALL).inputFiles()) == 1
    assert ledger.sweep(spark, path) == 8 + 1 and held(spark, path) == list(range(1008)) and ledger.sweep(spark, path) == 0
    add(tmp_path, 1008)
    assert held(spark, path) == list(range(1009))


def test_of_two_merges_one_holds(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}"
    add(tmp_path, 0, 4)
    state, seen = ledger._state, ledger._state(spark, path)
    assert ledger.compact(spark, path, SMALL)
    monkeypatch.setattr(ledger, "_state", lambda *a: seen)
    assert not ledger.compact(spark, path, SMALL)
    monkeypatch.setattr(ledger, "_state", state)
    assert held(spark, path) == [0, 1, 2, 3] and ledger.sweep(spark, path) == 4 and held(spark, path) == [0, 1, 2, 3]


def test_empty_ledgers(spark, tmp_path):
    assert held(spark, f"file://{tmp_path}/none") == [] and not ledger.compact(spark, f"file://{tmp_path}/none", SMALL)
    assert ledger.sweep(spark, f"file://{tmp_path}/none") == 0


def page(folder, ids, total, offset=None, name=None):
    folder = folder / (f"offset={offset}" if offset is not None else ".")
    folder.mkdir(parents=True, exist_ok=True)
    items = [{"id": i, "attributes": {"name": i, "platform": "ios", "currency": None}} for i in ids]
    (folder / (name or f"{uuid.uuid4().hex}.json")).write_text(json.dumps({"data": items, "meta": {"total_items": total}}))


def apps(spark, folder):
    return [r["id"] for r in landing.read_app_pages(spark, f"file://{folder}").collect()]


def test_complete_lists(spark, tmp_path):
    for k in range(3):
        page(tmp_path / "a", [f"{k}{c}" for c in "xyz"[: 3 - k]], 6, offset=(0, 3, 5)[k])
    page(tmp_path / "a", ["1x", "1y"], 6, offset=3)  # came twice
    assert apps(spark, tmp_path / "a") == ["0x", "0y", "0z", "1x", "1y", "2x"]
    page(tmp_path / "b", ["b", "a"], 3)
    page(tmp_path / "b", ["c"], 3)
    page(tmp_path / "b", ["c"], 3)
    assert apps(spark, tmp_path / "b") == ["a", "b", "c"]
    page(tmp_path / "c", ["a"], None)
    assert apps(spark, tmp_path / "c") == ["a"]
    page(tmp_path / "d", [], 0, offset=0)
    assert apps(spark, tmp_path / "d") == []


@pytest.mark.parametrize(
    ("pages", "told"),
    [
        ([("ab", 5, 0), ("e", 5, 4)], "3 of 5 items; hole from 2 to 4"),
        ([("ab", 3, 0)], "2 of 3 items; hole from 2 to 3"),
        ([("b", 2, 1)], "1 of 2 items; hole from 0 to 1"),
        ([("ab", 3, 0), ("bc", 3, 1)], "overlap from 1 to 2"),
        ([("ab", 3, None)], "2 of 3 items"),
        ([("abc", 2, None)], "3 of 2 items"),
        ([("a", 2, 0), ("b", 3, 1)], "pages disagree on the number of items: 2 and 3"),
    ],
)
def test_incomplete_lists(spark, tmp_path, pages, told):
    for ids, total, offset in pages:
        page(tmp_path / "p", ids, total, offset)
    with pytest.raises(ValueError, match=f"not complete: {told}"):
        apps(spark, tmp_path / "p")


def test_budgets_of_a_plan(spark):
    day = date(2026, 9, 1)
    rows = [("e", "a", day, day, True)] * 3 + [("e", "b", day, day, True), ("f", "b", day, date(2026, 9, 9), False)]
    jobs = spark.createDataFrame(rows, "name string, app_id string, from_date date, to_date date, is_long boolean")
    used = spark.createDataFrame([("b", 4), ("z", 9), (None, 13)], "app_id string, calls bigint")
    got = {r["app_id"]: (r["calls"], r["budget"], r["exceeds"]) for r in windows.budget_flags(jobs, used, 5, 17, reserve=1).collect()}
    assert got == {"a": (3, 4, False), "b": (5, 4, True), None: (17, 16, True)}
    assert windows.render(jobs, used, 65, 5, 17, 1) == [
        "e: apps=2 window=2026-09-01..2026-09-01 chunks=4 long_calls=4",
        "f: apps=1 window=2026-09-01..2026-09-09 chunks=1 long_calls=0",
        "account long calls: 17 / 16 EXCEEDS",
        "app a long calls: 3 / 4",
        "app b long calls: 5 / 4 EXCEEDS",
        "total calls: 5 (17 long with those made); at least 3.2 min",
    ]
    assert windows.budget_flags(jobs.where("not is_long"), used, 5, 17).where("app_id is not null").isEmpty()


def test_alter_text_runs(spark):
    name = f"`u{uuid.uuid4().hex}`"
    had = T.StructType([f for f in DESTINATION if f.name not in ("roi", "extra")])
    assert alter_text(name, DESTINATION) is None
    spark.sql(f"CREATE TABLE {name} ({', '.join(f'{f.name} {f.dataType.simpleString()}' for f in had)}) USING parquet")
    text = alter_text(name, spark.table(name).schema)
    assert text == f"ALTER TABLE {name} ADD COLUMNS (roi double, extra map<string,string>)"
    spark.sql(text)
    assert alter_text(name, spark.table(name).schema) is None
    spark.sql(f"DROP TABLE {name}")


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    from reportlake.operators.store import Destination
    from reportlake.streaming.incremental import forget_last_commit, landed, rebuild_from_stream

    schema = T.StructType.fromDDL("date date, _extract string, app_id string, n bigint")
    t = Destination(spark, f"v{uuid.uuid4().hex}", f"file://{tmp_path}/dest", schema=schema, sort=("app_id",))
    t.ensure()
    source, checkpoint = f"file://{tmp_path}/in", f"file://{tmp_path}/checkpoint"
    assert not forget_last_commit(spark, checkpoint)
    batches = []
    rebuild, t.rebuild = t.rebuild, lambda *a: batches.append(1) or rebuild(*a)
    for n in (1, 2):
        spark.createDataFrame([(date(2026, 9, 1), "e", "a", n), (date(2026, 9, n), "e", "b", n)], schema).write.mode("append").parquet(source)
        rebuild_from_stream(landed(spark, source, schema), t, checkpoint).awaitTermination(120)
    state = lambda: sorted((r["app_id"], str(r["date"]), r["n"]) for r in t.rows().collect())
    want = [("a", "2026-09-01", 2), ("b", "2026-09-01", 1), ("b", "2026-09-02", 2)]
    assert state() == want and len(batches) == 2
    assert forget_last_commit(spark, checkpoint)
    rebuild_from_stream(landed(spark, source, schema), t, checkpoint).awaitTermination(120)
    assert state() == want and len(batches) == 3
    spark.sql(f"DROP TABLE {t.name}")


def test_ledger_rows_of_waves_survive_a_merge(spark, tmp_path):
    path = f"file://{tmp_path}/ledger"
    ledger.ensure(spark, path)
    day = datetime(2026, 9, 1)
    for k in range(3):
        row = ("r", "e", f"a{k}", "t", day.date(), day.date(), 2, 0, "success", k, 1, None, day, day, 0, None, None, "1")
        ledger.append(spark.createDataFrame([row], ledger.LEDGER), path)
    ledger.compact(spark, path)
    assert ledger.watermarks(ledger.read_loads(spark, path)).count() == 3
    assert ledger.read_loads(spark, path).agg(F.sum("rows")).first()[0] == 3
