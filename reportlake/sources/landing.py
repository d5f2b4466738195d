"""Landed files: report bodies (CSV), pages of the app list (JSON)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reportlake.sources.scan import first_record, reports_at

def read_report(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """Headers, and all records as text columns c0, c1, ... in their order.

    Columns are named by place, so that repeated headers stay apart. A byte order mark goes; a file without a
    header is an error. Short records are filled with blanks, cells beyond the header are dropped, blank lines
    are no records.
    """
    names = spark.createDataFrame([(path,)], "p string").select(F.udf(lambda p: first_record(p), "array<string>")("p")).first()[0]
    if not names:
        raise ValueError(f"empty report: {path}")
    return names, reports_at(spark, [path], "cells").select(*[F.col("cells")[i].alias(f"c{i}") for i in range(len(names))])


def app_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of the account's app list: offset (of the folder ``offset=N`` or of ``meta``; null if neither tells), total, data.

    Equal pages of one offset count once.
    """
    attributes = "struct<name:string,platform:string,currency:string,time_zone:string>"
    schema = f"data array<struct<id:string,attributes:{attributes}>>, meta struct<total_items:bigint,offset:bigint>"
    read = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    told = F.regexp_extract(F.col("_metadata.file_path"), "/offset=([0-9]+)/", 1).try_cast("bigint")
    return read.select(F.coalesce(told, "meta.offset").alias("offset"), F.col("meta.total_items").alias("total"), F.coalesce("data", F.array().cast(f"array<struct<id:string,attributes:{attributes}>>")).alias("data")).distinct()


def page_faults(pages: DataFrame) -> DataFrame:
    """(kind, from, to) where pages do not follow each other: a ``hole`` of items that no page holds, or an ``overlap``.

    Pages without an offset tell nothing. The window is over pages, of some thousand items each.
    """
    spans = pages.where("offset IS NOT NULL").select("offset", (F.col("offset") + F.size("data")).alias("end"), "total")
    before = F.coalesce(F.max("end").over(W.orderBy("offset", "end").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    gaps = spans.select(before.alias("reach"), "offset")
    last = spans.agg(F.max("end").alias("reach"), F.max("total").alias("offset")).where("offset IS NOT NULL AND reach IS NOT NULL AND reach < offset")
    hole = F.when(F.col("offset") > F.col("reach"), "hole").otherwise("overlap")
    return gaps.where("offset <> reach").unionByName(last).select(hole.alias("kind"), F.least("offset", "reach").alias("from"), F.greatest("offset", "reach").alias("to"))


def read_app_pages(spark: SparkSession, path: str) -> DataFrame:
    """The account's apps from paged JSON responses, sorted by id: id, name, platform, currency, time_zone.

    A list that is not complete is an error: pages that disagree on ``meta.total_items``, other than so many apps, or holes
    and overlaps between page offsets. A page that came twice counts once, as does an app.
    """
    pages = app_pages(spark, path)
    app = pages.select(F.explode("data").alias("a")).select("a.id", "a.attributes.*").groupBy("id").agg(*[F.min(c).alias(c) for c in ("name", "platform", "currency", "time_zone")])
    told = pages.agg(F.min("total").alias("least"), F.max("total").alias("most")).first()
    problems = [f"{r['kind']} from {r['from']} to {r['to']}" for r in page_faults(pages).orderBy("from").limit(10).collect()]
    if told["least"] != told["most"]:
        problems.insert(0, f"pages disagree on the number of items: {told['least']} and {told['most']}")
    elif told["most"] is not None and (found := app.count()) != told["most"]:
        problems.insert(0, f"{found} of {told['most']} items")
    if problems:
        raise ValueError(f"app list {path} is not complete: " + "; ".join(problems))
    return app.orderBy("id")


def pick_apps(apps: DataFrame, platforms: Sequence[str] | None = None, exclude: Sequence[str] | DataFrame | None = None, only: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Apps of the given platforms (any case; none given: all), without the excluded, of the given ids only.

    Ids come as a list or, if they are many, as a table with a column ``id``.
    """
    if platforms:
        apps = apps.where(F.lower("platform").isin([p.lower() for p in platforms]))
    for ids, kind in ((exclude, "left_anti"), (only, "left_semi")):
        if isinstance(ids, DataFrame):
            apps = apps.join(ids.select("id"), "id", kind)
        elif ids:
            apps = apps.where(F.col("id").isin(list(ids)) if kind == "left_semi" else ~F.col("id").isin(list(ids)))
    return apps


def with_currency(rows: DataFrame, apps: DataFrame, app: str = "app_id") -> DataFrame:
    """Adds ``currency``, that of the row's app in the account's list; blank for apps it lacks or without one."""
    known = apps.select(F.col("id").alias(app), "currency")
    return rows.join(known, app, "left").withColumn("currency", F.coalesce("currency", F.lit("")))
