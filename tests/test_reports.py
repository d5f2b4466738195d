"""Parsing of reports: headers, cells, fixtures of every shape."""

from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reportlake.functions import coerce, maps
from reportlake.functions.names import qualified
from reportlake.operators.parse import Context, parse_report
from reportlake.schema import COLUMN_NAMES, DESTINATION, partition_id, schema_problems
from reportlake.sources.headers import read_header, report_format
from reportlake.sources.landing import pick_apps, read_app_pages, read_report

CONTEXT = Context("app1", "partners_by_date_report", "standard", False, "standard", "run1", datetime(2026, 9, 23, 8, 0))
DIM = "Date,Country,Agency/PMD (af_prt),Media Source (pid)"
MET = "Impressions,Clicks,CTR,Installs,Conversion Rate,Sessions,Loyal Users,Loyal Users/Installs,Total Revenue,Total Cost,ROI,ARPU,Average eCPI"
FB = "Campaign Name,Campaign Id,Adset Name,Adset Id,Adgroup Name,Adgroup Id"


def events(name, currency="USD"):
    return f"{name} (Unique users),{name} (Event counter),{name} (Sales in {currency})"


def parsed(spark, tmp_path, body, context=CONTEXT, **options):
    path = tmp_path / "report.csv"
    path.write_bytes(body.encode() if isinstance(body, str) else body)
    headers, raw = read_report(spark, f"file://{path}")
    return parse_report(headers, raw, context, **options)


def test_standard(spark, tmp_path):
    body = f"{DIM},Campaign (c),{MET},{events('af_purchase')}\n"
    body += "2026-09-01,US,agency,google,brand,\"12,000\",300,2.5%,40,1.1,90,10,0.25,$99.5,50,1.9,2.4,1.25,3,5,99.5\n"
    body += "2026-09-02,US,,None,None,N/A,N/A,N/A,100,,,,,,,,,,,,\n\n"
    p = parsed(spark, tmp_path, body)
    assert p.rows.columns == list(COLUMN_NAMES)
    assert [f.dataType.simpleString() for f in p.rows.schema] == [f.dataType.simpleString() for f in DESTINATION]
    a, b = p.rows.orderBy("date").collect()
    assert (a["date"], a["impressions"], a["ctr"], a["total_revenue"], a["event_counter"], a["event_sales"]) == (date(2026, 9, 1), 12000, 2.5, 99.5, {"af_purchase": 5}, {"af_purchase": 99.5})
    assert (b["campaign"], b["media_source"], b["impressions"], b["installs"], b["event_counter"], b["agency"]) == ("None", "None", None, 100, {}, "")
    assert (p.format, p.currency, p.unknown) == ("standard", "USD", [])
    assert a["currency"] == "USD" and a["_extract"] == "standard" and a["_loaded_at"] == CONTEXT.loaded_at


def test_facebook_and_fallback(spark, tmp_path):
    both = parsed(spark, tmp_path, f"Date,Campaign (c),{FB}\n2026-09-01,c,n,1,a,2,g,3\n")
    assert both.format == "facebook" and both.rows.first()["campaign"] == "c"
    only = parsed(spark, tmp_path, f"Date,{FB}\n2026-09-01,n,1,a,2,g,3\n").rows.first()
    assert (only["campaign"], only["adset"], only["adgroup_id"]) == ("n", "a", "3")


def test_absent_columns_header_only_and_unknown(spark, tmp_path):
    r = parsed(spark, tmp_path, "Date,Media Source (pid)\n2026-09-01,x\n").rows.first()
    assert r["country"] == "" and r["roi"] is None and r["extra"] == {}
    assert parsed(spark, tmp_path, f"{DIM}\n").counts() == (0, 0, 0)
    odd = f"{DIM},Mystery Metric\n2026-09-01,US,,x, 42 \n"
    assert parsed(spark, tmp_path, odd).rows.first()["extra"] == {}
    kept = parsed(spark, tmp_path, odd, keep_unknown=True)
    assert kept.rows.first()["extra"] == {"Mystery Metric": "42"} and "Mystery Metric" in kept.warnings[0]


def test_mark_quotes_ragged_and_repeated(spark, tmp_path):
    body = b"\xef\xbb\xbf" + b'Date,Clicks,clicks,Campaign (c)\n2026-09-01,1,"2,000","a ""b""\nc"\n2026-09-02,3\n2026-09-03,1,2,z,extra\n'
    p = parsed(spark, tmp_path, body)
    rows = p.rows.orderBy("date").collect()
    assert [r["clicks"] for r in rows] == [2000, None, 2] and rows[0]["campaign"] == 'a "b"\nc' and rows[1]["campaign"] == ""
    assert any("several columns for clicks" in w for w in p.warnings)


def test_currency(spark, tmp_path):
    two = parsed(spark, tmp_path, f"Date,{events('a', 'EUR')},{events('b', 'USD')}\n2026-09-01,1,1,2,1,1,3\n")
    assert two.currency == "" and two.warnings and two.rows.first()["event_sales"] == {"a": 2.0, "b": 3.0}
    hint = Context("a", "r", "c", True, "e", "r", datetime(2026, 1, 1), "GBP")
    assert parsed(spark, tmp_path, f"Date,{events('a', 'EUR')}\n2026-09-01,1,1,2\n", hint).currency == "EUR"
    assert parsed(spark, tmp_path, "Date\n2026-09-01\n", hint).currency == "GBP"


def test_bad_date_missing_date_and_empty(spark, tmp_path):
    with pytest.raises(ValueError, match="1 rows"):
        parsed(spark, tmp_path, f"{DIM}\nnot-a-date,US,,x\n").counts()
    with pytest.raises(ValueError, match="no Date"):
        parsed(spark, tmp_path, "Country\nUS\n")
    with pytest.raises(ValueError, match="empty report"):
        parsed(spark, tmp_path, " \n")


def test_drop_counters_are_disjoint_and_duplicates_stay(spark, tmp_path):
    body = f"{DIM}\n" + "2026-09-01,US,,x\n" * 2 + "2026-09-01,US,,bad\n2026-08-01,US,,bad\n2026-08-01,US,,x\n"
    p = parsed(spark, tmp_path, body, days=(date(2026, 9, 1), date(2026, 9, 2)), exclude=["bad"])
    assert p.counts() == (2, 2, 1) and p.rows.count() == 2


def test_headers():
    assert read_header(" Media Source (pid) ").column == "media_source"
    h = read_header("a (b) (Sales in EUR)")
    assert (h.kind, h.event, h.currency, h.exact) == ("event", "a (b)", "EUR", True)
    assert read_header("x (unique USERS)").exact is False and read_header("nothing").kind == "unknown"
    assert report_format(["adset id"]) == "facebook"


CASES = {"12,000": (12000, 12000.0), " 12.9 ": (12, 12.9), "-3": (None, -3.0), "N/A": (None, None), "5d": (None, None), "1_000": (None, None), "nan": (None, None), "inf": (None, None), "2.83%": (None, 2.83), "$1,204.50": (None, 1204.5), "1e400": (None, None), "18446744073709551615": (None, 18446744073709551615.0), " 7 ": (7, 7.0)}


def test_cells(spark):
    df = spark.createDataFrame([(k,) for k in CASES] + [(None,)], "v string")
    got = {r[0]: (r[1], r[2]) for r in df.select("v", coerce.to_count(F.col("v")), coerce.to_number(F.col("v"))).collect()}
    assert got == CASES | {None: (None, None)}


def test_days_and_texts(spark):
    df = spark.createDataFrame([("2026-09-01",), ("2026-9-1",), ("2026",), ("20260901",), ("2026-02-30",), (None,), (" None ",), ("N/A",)], "v string")
    rows = df.select(coerce.to_day(F.col("v")), coerce.to_text(F.col("v"))).collect()
    assert [r[0] for r in rows] == [date(2026, 9, 1)] + [None] * 7
    assert [r[1] for r in rows[-3:]] == ["", "None", ""]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 10**12), min_size=1, max_size=20))
def test_counts_round_trip(spark, values):
    df = spark.createDataFrame([(f"{v:,}", v) for v in values], "s string, v long")
    assert df.where(coerce.to_count(F.col("s")) != F.col("v")).isEmpty()


def test_maps(spark):
    one = spark.range(1).select(maps.event_map([("a", F.lit(1)), ("b", F.lit(None)), ("a", F.lit(2)), ("c", F.lit(5)), ("c", F.lit(None))], "bigint").alias("m"))
    assert one.first()[0] == {"a": 2, "c": 5}
    assert one.select(maps.looked_up(F.col("m"), "zzz")).first()[0] == 0


def test_names_and_partitions(spark):
    assert qualified("db.t`x") == "`db`.`t``x`"
    with pytest.raises(ValueError):
        qualified("a.b.c")
    row = spark.sql("SELECT DATE '2026-09-05' AS d").select(partition_id("d"), partition_id("d", "day")).first()
    assert tuple(row) == (202609, 20260905)


def test_schema_problems():
    assert schema_problems(DESTINATION) == []
    from pyspark.sql import types as T

    found = T.StructType([f for f in DESTINATION if f.name != "roi"] + [T.StructField("mine", T.StringType())])
    assert len(schema_problems(found)) == 1 and "ADD COLUMNS (roi double)" in schema_problems(found)[0]


def test_app_pages(spark, tmp_path):
    page = '{{"data": [{}], "meta": {{"total_items": 3}}}}'
    app = '{{"id": "{}", "attributes": {{"name": "n", "platform": "{}", "currency": "EUR", "time_zone": "UTC"}}}}'
    (tmp_path / "1.json").write_text(page.format(app.format("b", "ios") + "," + app.format("a", "Android")))
    (tmp_path / "2.json").write_text(page.format(app.format("c", "android")))
    apps = read_app_pages(spark, str(tmp_path))
    assert [r["id"] for r in apps.collect()] == ["a", "b", "c"]
    assert [r["id"] for r in pick_apps(apps, ["ANDROID"], exclude=["c"]).collect()] == ["a"]
    assert pick_apps(apps, only=["b", "zz"]).count() == 1


def test_all_unicode_white_space_is_trimmed(spark):
    from pyspark.sql import functions as F

    from reportlake.functions.coerce import trimmed

    cells = [f"{chr(c)}a{chr(c)}b{chr(c)}{chr(c)}" for c in range(0x3001) if not 0xD800 <= c < 0xE000] + ["", " 　", "x"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    assert df.where(trimmed(F.col("c")) != F.regexp_replace("c", r"(?U)^\s+|\s+$", "")).collect() == []


def test_days_are_real_dates(spark):
    from pyspark.sql import functions as F

    from reportlake.functions.coerce import to_day

    good = {"2024-02-29": "2024-02-29", " 2024-12-31 ": "2024-12-31", "0001-01-01": "0001-01-01"}
    bad = ["2023-02-29", "2024-13-01", "2024-00-10", "2024-01-32", "0000-01-01", "2024-1-1", "2024-01-01T00:00", "12024-01-01", "", None]
    df = spark.createDataFrame([(c,) for c in [*good, *bad]], "c string")
    got = {r["c"]: r["d"] for r in df.select("c", to_day(F.col("c")).cast("string").alias("d")).collect()}
    assert got == good | dict.fromkeys(bad)
