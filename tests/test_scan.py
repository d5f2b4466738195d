"""The data source of landed reports: listing, push-down, records, waves over odd files."""

import json
import uuid
from datetime import date, datetime
from urllib.parse import quote

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from reportlake.operators.load import Landed, load_wave
from reportlake.operators.parse import Context, parse_scan
from reportlake.operators.store import Destination
from reportlake.sources import scan
from reportlake.sources.landing import read_report

D1, D2 = date(2026, 9, 1), date(2026, 9, 2)


def land(root, body, extract="std", app="app1", kind="daily", first=D1, last=D2, name="r.csv"):
    values = (extract, app, kind, first, last)
    folder = root.joinpath(*(f"{k}={quote(str(v), safe=' ')}" for k, v in zip(scan.LEVELS, values)))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(body.encode() if isinstance(body, str) else body)
    return f"file://{folder}/{name}"


@pytest.fixture
def root(tmp_path):
    for e in ("std", "fb"):
        for a in ("app1", "app/2", "app 3"):
            for d in range(1, 6):
                land(tmp_path / "in", f"Date,Clicks\n2026-09-0{d},{d}\n", e, a, "daily", date(2026, 9, d), date(2026, 9, d))
    land(tmp_path / "in", "x", name="_SUCCESS")
    (tmp_path / "in" / "other").mkdir()
    (tmp_path / "in" / "extract=std" / "app_id=").mkdir()
    return tmp_path / "in"


def test_listing(spark, root):
    files = scan.landed_files(spark, f"file://{root}")
    rows = files.collect()
    assert len(rows) == 30 and {r["app_id"] for r in rows} == {"app1", "app/2", "app 3"} and all(r["bytes"] == 25 and r["modified"] for r in rows)
    assert scan.landed_files(spark, f"file://{root}/none").collect() == []


def test_filters_are_pushed_into_the_listing(spark, root):
    rows = scan.landed_reports(spark, f"file://{root}").where("extract = 'std' AND app_id IN ('app1', 'app/2') AND to_date >= DATE'2026-09-03' AND from_date < DATE'2026-09-05' AND nth > 0")
    assert sorted((r["app_id"], r["clicks"]) for r in rows.collect()) == [("app/2", "3"), ("app/2", "4"), ("app1", "3"), ("app1", "4")]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    above = "".join(x for x in plan.splitlines() if "Filter " in x)
    assert "nth" in above and not any(c in above for c in scan.LEVELS)


def test_only_folders_that_pass_are_walked(root, monkeypatch):
    seen = []

    real = scan.store

    def store(path):
        files, inner = real(path)

        class Wrapped:
            def get_file_info(self, selector):
                seen.append(selector.base_dir)
                return files.get_file_info(selector)

        return Wrapped(), inner

    monkeypatch.setattr(scan, "store", store)
    reader = scan.Reader({"path": f"file://{root}"})
    left = list(reader.pushFilters([ds.EqualTo(("extract",), "fb"), ds.EqualTo(("clicks",), "1"), ds.Not(ds.EqualTo(("app_id",), "app1")), ds.LessThan(("to_date",), date(2026, 9, 3)), ds.IsNotNull(("extract",))]))
    assert [f.attribute for f in left] == [("clicks",)]
    files = [f for p in reader.partitions() for f in p.files]
    assert len(files) == 4 and {(f.extract, f.app_id) for f in files} == {("fb", "app/2"), ("fb", "app 3")}
    assert len(seen) == 1 + 1 + 2 + 2 + 10 + 4  # root, extract, apps, types, first days, last days


def test_packing():
    files = [scan.File(str(i), bytes=b) for i, b in enumerate([5, 5, 100, 1, 1, 30])]
    assert [[f.path for f in p.files] for p in scan.packed(files, 12)] == [["0", "1"], ["2"], ["3", "4"], ["5"]]
    assert len(scan.packed([scan.File("x")] * 1000, 1 << 20)) == 16  # empty files are not free


ODD = b'\xef\xbb\xbf\r\n \n"Date","Media Source (pid)","My\nMetric","Clicks",Clicks\r\n2026-09-01,"a ""b""\nc",m,5,6\r\n\r\n  \r\n2026-09-02,x\r\n2026-09-02,y,m,7,8,9,10\r\n2026-09-01,\xff,m,1,"2,000"'


def test_odd_file_by_any_reader(spark, tmp_path):
    path = land(tmp_path, ODD)
    names, raw = read_report(spark, path)
    assert names == ["Date", "Media Source (pid)", "My\nMetric", "Clicks", "Clicks"]
    want = [["2026-09-01", 'a "b"\nc', "m", "5", "6"], ["2026-09-01", "�", "m", "1", "2,000"], ["2026-09-02", "x", "", "", ""], ["2026-09-02", "y", "m", "7", "8"]]
    assert sorted(list(r) for r in raw.collect()) == want
    rows = scan.reports_at(spark, [path])
    parsed = parse_scan(rows, Context("a", "t", "standard", False, "e", "r", datetime(2026, 9, 3), None), F.lit("EUR"), keep_unknown=True, carry=["nth", "notes"])
    got = sorted((r["nth"], r["media_source"], r["clicks"], r["extra"].get("My\nMetric"), r["currency"]) for r in parsed.collect())
    assert got == [(2, 'a "b"\nc', 6, "m", "EUR"), (3, "x", None, "", "EUR"), (4, "y", 8, "m", "EUR"), (5, "�", 2000, "m", "EUR")]
    assert {r["notes"] for r in rows.collect()} == {"unknown headers: My\nMetric; several columns for clicks"}


@pytest.mark.parametrize(
    ("body", "problem"),
    [("", scan.EMPTY), ("\n \r\n", scan.EMPTY), ("Country\nUS\n", scan.NO_DATE), ("Date", None), ("Date,Clicks\n", None), (b"\xef\xbb\xbf", scan.EMPTY), (",,\n", scan.EMPTY)],
)
def test_files_without_rows(spark, tmp_path, body, problem):
    rows = scan.reports_at(spark, [land(tmp_path, body)]).collect()
    assert [r["problem"] for r in rows] == ([problem] if problem else [])


def test_waves_over_odd_files(spark, tmp_path):
    t = Destination(spark, f"s{uuid.uuid4().hex}", f"file://{tmp_path}/dest")
    line = "Date,Clicks" + ",unused" * 3 + "\n" + "2026-09-01,1,,,\n" * 70_000
    bodies = {"quoted": ODD, "blank": "\n\nDate,Clicks\n2026-09-01,4\n", "one": "Date,Clicks", "large": line, "empty": "\n"}
    jobs = [Landed(land(tmp_path / k, b), k, "app", "daily", D1, D2) for k, b in bodies.items()]
    got = load_wave(spark, jobs, t, f"file://{tmp_path}/ledger", "r", datetime(2026, 9, 3))
    assert [got[i][:2] for i in range(5)] == [("success", 4), ("success", 1), ("success", 0), ("success", 70_000), ("failed", 0)]
    sums = {r[0]: r[1] for r in t.rows().groupBy("_extract").agg(F.sum("clicks")).collect()}
    assert sums == {"quoted": 6 + 8 + 2000, "blank": 4, "large": 70_000}
    spark.sql(f"DROP TABLE {t.name}")


def test_event_pairs(spark, tmp_path):
    head = "Date,buy (Event counter),win (Event counter),buy (Event counter),buy (Sales in EUR),buy (Sales in USD)\n"
    path = land(tmp_path, head + "2026-09-01,1,2,3,4,5\n2026-09-01,1,N/A,-,$4,\n2026-09-01,,,,,\n")
    rows = parse_scan(scan.reports_at(spark, [path]), Context("a", "t", "standard", False, "e", "r", datetime(2026, 9, 3)), F.lit(None), carry=["nth"]).orderBy("nth").collect()
    assert [r["event_counter"] for r in rows] == [{"buy": 3, "win": 2}, {"buy": 1}, {}]
    assert [r["event_sales"] for r in rows] == [{"buy": 5.0}, {"buy": 4.0}, {}] and {r["currency"] for r in rows} == {""}


cell = st.text(st.sampled_from('ab ,"\n\r\té'), max_size=5)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(cell, min_size=3, max_size=3), max_size=8))
def test_records_come_back_as_written(tmp_path_factory, rows):
    import csv

    path = tmp_path_factory.mktemp("csv") / "r.csv"
    with path.open("w", newline="") as f:
        writer = csv.writer(f, quoting=csv.QUOTE_ALL)
        writer.writerows([["h1", "h2", "h3"], *rows])
    got = [(int(n), [c[i].as_py() for c in columns]) for numbers, columns in scan.records(str(path), 3) for i, n in enumerate(numbers)]
    assert scan.first_record(str(path)) == ["h1", "h2", "h3"] and sorted(got) == [(i + 2, r) for i, r in enumerate(rows)]


def test_plain_paths_and_options(spark, root):
    assert scan.landed_reports(spark, str(root)).where("extract = 'fb'").count() == 15
    some = [r["path"] for r in scan.landed_files(spark, str(root)).where("app_id = 'app1'").collect()]
    assert scan.reports_at(spark, some).where("extract IS NULL").count() == 10
    assert json.loads(json.dumps(some)) == some and scan.reports_at(spark, []).count() == 0


def test_what_a_reading_task_holds_is_bounded(tmp_path, monkeypatch):
    """Blocks are small and batches short, whatever the file's size; a record that no small block holds comes all the same, once."""
    monkeypatch.setattr(scan, "BLOCK", 4096)
    monkeypatch.setattr(scan, "BATCH", 50)
    long = "z" * 20_000
    body = [f"2026-09-01,a{i},b" if i % 7 else f"2026-09-01,a{i}" if i % 2 else " " for i in range(900)]
    body[600] = f'2026-09-01,"{long}\n",b'
    (tmp_path / "r.csv").write_text("Date,Media Source (pid),Country\n" + "\n".join(body) + "\n")
    got = list(scan.records(f"file://{tmp_path}/r.csv", 3))
    assert max(len(n) for n, _ in got) <= 50 and all(len(n) == len(c) for n, columns in got for c in columns)
    read = sorted((int(n), *(c[i].as_py() for c in columns)) for n, columns in got for i, n in enumerate(n))
    cells = [(x.split(",") + [""])[:3] for x in body if x.strip()]
    want = [(k + 2, *c) for k, c in enumerate(["2026-09-01", f"{long}\n", "b"] if long in "".join(c) else c for c in cells)]
    assert [r[0] for r in read] == [w[0] for w in want] and read == want


def test_the_batches_of_a_report_are_short(tmp_path):
    (tmp_path / "r.csv").write_text("Date,Clicks,Own\n" + "2026-09-01,1,x\n" * 100_000)
    sizes = [b.num_rows for b in scan.report(scan.File(f"file://{tmp_path}/r.csv"))]
    assert sum(sizes) == 100_000 and max(sizes) <= 16_384
