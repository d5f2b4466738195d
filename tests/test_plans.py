"""Planning of extracts x apps x chunks, checks across extracts, app lists."""

import re
from collections import Counter
from datetime import date

from pyspark.sql import functions as F

from reportlake.plans import checks, windows
from reportlake.schema import LEDGER
from reportlake.sources import landing, scan

APPS = [("a1", "android", "USD"), ("a2", "iOS", None), ("a3", "Android", "EUR"), ("a4", None, "EUR")]
EXTRACT = "name string, platforms array<string>, apps array<string>, exclude_apps array<string>, enabled boolean, start date, lookback int, chunk_days int"


def apps(spark):
    return spark.createDataFrame(APPS, "id string, platform string, currency string")


def test_pairs_of_extracts_and_apps(spark):
    rows = [("all", None, None, None, None, None, 2, 2), ("phones", ["ANDROID", "android"], [], ["a1", "zz"], True, None, 2, 2), ("one", ["ios", "android"], ["a2", "a4", "a1"], None, True, None, 2, 2), ("off", None, None, None, False, None, 2, 2)]
    got = windows.pairs_of(spark.createDataFrame(rows, EXTRACT), apps(spark), default_exclude=["a1", "zz"])
    assert sorted((r["name"], r["app_id"], r["currency"]) for r in got.collect()) == [("all", "a2", ""), ("all", "a3", "EUR"), ("all", "a4", "EUR"), ("one", "a2", ""), ("phones", "a3", "EUR")]
    assert {tuple(r["exclude_apps"]) for r in got.where("name = 'phones'").collect()} == {("a1", "zz")}  # each once, defaults first


def test_jobs_start_with_last_month_and_go_on_from_the_watermark(spark):
    extracts = spark.createDataFrame([("x", None, ["a1", "a3"], None, None, None, 3, 10)], EXTRACT)
    done = ("r", "x", "a1", "daily", date(2026, 9, 1), date(2026, 9, 20), 10, 1, "success", 1, 1, None, None, None, None, None, None, "1")
    jobs = windows.plan_jobs(extracts, apps(spark), spark.createDataFrame([done], LEDGER), date(2026, 9, 22)).collect()
    spans = lambda a: sorted((r["from_date"], r["to_date"]) for r in jobs if r["app_id"] == a)
    # Never loaded: from the first of last month; else the earlier of the rolling window and the settling days.
    assert spans("a3")[0][0] == date(2026, 8, 1) and spans("a3")[-1][1] == date(2026, 9, 22)
    assert spans("a1")[0][0] == date(2026, 9, 18) and all(a <= b for a, b in spans("a1"))
    days = [d for a, b in spans("a3") for d in range(a.toordinal(), b.toordinal() + 1)]
    assert days == list(range(date(2026, 8, 1).toordinal(), date(2026, 9, 22).toordinal() + 1))


def test_checks_across_extracts(spark):
    rows = [("base", "t", None, ["Facebook Ads", "-"]), ("fb", "t", "facebook", None), ("ya", "t", "yandex_int", None), ("other", "u", "yandex_int", None), ("whole", "u", None, None)]
    df = spark.createDataFrame(rows, "name string, table string, media_source string, exclude_media_sources array<string>")
    assert sorted(tuple(r) for r in checks.double_owners(df).collect()) == [("t", "base", "ya", "yandex_int"), ("u", "whole", "other", "yandex_int")]
    chunks = spark.createDataFrame([("a", 2), ("b", 3), ("c", None)], "name string, chunk_days int")
    assert [tuple(r) for r in checks.long_chunks(chunks, 3).collect()] == [("b", 3)]


def test_owners_in_any_blocks(spark):
    """Every pair of a table once for each of its rows, whatever the blocks: names and tables that are null, repeated rows, sources of no letters."""
    schema = "name string, table string, media_source string, exclude_media_sources array<string>"
    barred = [None, [], ["Face book", None, ""], ["-"], ["YA", "fb_ads"], ["ya", "FB ads", "ya"]]
    rows = [(None if i == 4 else f"base{i}", "tu"[i % 2], None, e) for i, e in enumerate(barred * 2)] + [("base0", "t", None, None), ("lost", None, None, None), ("alone", "v", None, None)]
    sources = ["facebook", "Facebook!", "yandex", "y", "", "--", "fbads", "other"]
    rows += [(None if i == 3 else f"one{i}", "tu"[i // 8 % 2], m, ["other"]) for i, m in enumerate(sources * 4)] + [("one0", "t", "facebook", None), ("lost", None, "y", None), ("alone", "w", "y", None)]
    plain = lambda s: re.sub("[^a-z0-9]", "", s.lower())
    out = lambda x, m: any(plain(e) and plain(m) and (plain(e).startswith(plain(m)) or plain(m).startswith(plain(e))) for e in x or [] if e is not None)
    expected = Counter((t, a, b, m) for a, t, no, x in rows if no is None and t for b, u, m, _ in rows if m is not None and u == t and not out(x, m))
    df = spark.createDataFrame(rows, schema)
    assert sum(expected.values()) > 100
    for blocks in ({}, {"block": 3}, {"block": 1}):
        assert Counter(tuple(r) for r in checks.double_owners(df, **blocks).collect()) == expected


def test_owners_of_one_table_come_from_many_tasks(spark):
    """A single table with two extracts of all sources and 40,000 of one: no task makes half of its pairs."""
    base = F.col("id") < 2
    df = spark.range(40_002, numPartitions=1).select(F.col("id").alias("name"), F.lit("t").alias("table"), F.when(~base, F.lit("src")).alias("media_source"), F.when(base, F.array(F.lit("other"))).alias("exclude_media_sources"))
    made = checks.double_owners(df).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in made) == 80_000 and max(r["count"] for r in made) < 40_000


def test_apps_by_table_or_list(spark):
    ids = lambda df: sorted(r["id"] for r in df.collect())
    some = spark.createDataFrame([("a1",), ("a3",), ("a1",)], "id string")
    assert ids(landing.pick_apps(apps(spark), ["ANDROID"])) == ["a1", "a3"]
    assert ids(landing.pick_apps(apps(spark), exclude=some)) == ["a2", "a4"] and ids(landing.pick_apps(apps(spark), only=some)) == ["a1", "a3"]
    jobs = spark.createDataFrame([("a1",), ("a2",), ("zz",)], "app_id string")
    assert sorted((r["app_id"], r["currency"]) for r in landing.with_currency(jobs, apps(spark)).collect()) == [("a1", "USD"), ("a2", ""), ("zz", "")]


def test_first_record(tmp_path):
    bodies = {"a": b"x,y\n1,2\n", "b": b"", "c": 'ä,"b\nc"\n'.encode(), "d": b"\xef\xbb\xbf\n  \nx\n", "e": b"one", "f": b"\xff,y"}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    assert [scan.first_record(f"file://{tmp_path}/{n}") for n in bodies] == [["x", "y"], [], ["ä", "b\nc"], ["x"], ["one"], ["\ufffd", "y"]]
