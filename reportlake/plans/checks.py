"""Checks across extracts: who may own the same rows, and which tables are asked for in two granularities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.functions.names import plain_name, prefixes

#: Extracts of one side in a block, so some 4,000,000 pairs of two blocks; tasks that pairs of blocks are dealt to at most.
BLOCK, MOST_TASKS = 2048, 10_000


def owner_overlaps(names: DataFrame, name: str) -> DataFrame:
    """Pairs (a, b) of different names of which one begins with the other, without case and punctuation.

    Every name is spread into its beginnings, so the prefix test is an equi-join; names of no letters match none.
    """
    plain = names.select(F.col(name).alias("n"), plain_name(F.col(name)).alias("p")).distinct()
    long_ = plain.select(F.col("n").alias("m"), F.explode(prefixes(F.col("p"))).alias("p"))
    met = plain.join(long_, "p").where("n <> m")
    return met.select(F.least("n", "m").alias("a"), F.greatest("n", "m").alias("b")).distinct()


def double_owners(extracts: DataFrame, block: int = BLOCK) -> DataFrame:
    """(table, base, other, media_source): an extract of all media sources that does not exclude one which another
    extract of the same table pulls, so that both may bring its rows.

    ``extracts``: name, table, media_source (null: all), exclude_media_sources (array). A source counts as excluded if
    its plain name begins with that of an excluded one, or the other way round.

    Either side of a table is dealt into blocks of about ``block`` extracts, and every two blocks meet in a cell of their
    own, so one large table is the work of many tasks. Within a block, extracts with the same exclusions and those with the
    same source are one row: a source is held against exclusions once, and the pairs are opened afterwards.
    """
    is_all = F.col("media_source").isNull()
    counts = extracts.groupBy("table").agg(F.count_if(is_all).alias("n"), F.count_if(~is_all).alias("m")).where("n > 0 AND m > 0")
    blocks = counts.select("table", F.ceil(F.col("n") / block).alias("n_all"), F.ceil(F.col("m") / block).alias("n_one"))
    tasks = blocks.agg(F.sum(F.col("n_all") * F.col("n_one"))).first()[0] or 1
    dealt_to = lambda n: F.coalesce(F.pmod("h", n), F.lit(0))  # noqa: E731  (never null, so that the cells of both sides are of one type)
    # Names that are null go with the others; a struct keeps them in a list.
    dealt = extracts.join(blocks, "table").withColumn("h", F.xxhash64("name"))
    plain = F.array_sort(F.array_distinct(F.filter(F.transform("exclude_media_sources", plain_name), lambda e: F.length(e) > 0)))
    all_ = dealt.where(is_all).groupBy("table", "n_one", dealt_to("n_all").alias("i"), plain.alias("excluded")).agg(F.collect_list(F.struct(F.col("name").alias("base"))).alias("bases"))
    one = dealt.where(~is_all).groupBy("table", "n_all", dealt_to("n_one").alias("j"), "media_source").agg(F.collect_list(F.struct(F.col("name").alias("other"))).alias("others"))
    cell = F.struct("table", "i", "j").alias("cell")  # one key, which stays whole where all extracts are of one table
    all_ = all_.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n_one") - 1))).select(cell, "excluded", "bases")
    one = one.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n_all") - 1))).select(cell, "media_source", plain_name(F.col("media_source")).alias("source"), "others")
    # A number of partitions is given because the rows that meet are few, however many their pairs.
    tasks = min(tasks, MOST_TASKS)
    met = one.repartition(tasks, "cell").join(all_.repartition(tasks, "cell").hint("merge"), "cell")
    source = F.col("source")
    covered = F.exists("excluded", lambda e: (F.length(source) > 0) & (e.startswith(source) | source.startswith(e)))
    free = met.where(~F.coalesce(covered, F.lit(False))).select("cell.table", "media_source", "bases", F.inline("others"))
    return free.select("table", "media_source", "other", F.inline("bases")).select("table", "base", "other", "media_source")


def long_chunks(extracts: DataFrame, long_from: int) -> DataFrame:
    """(name, chunk_days) of extracts whose chunks count against the daily budgets of long calls."""
    return extracts.where(F.col("chunk_days") >= long_from).select("name", "chunk_days")


def granularity_conflicts(extracts: DataFrame, table: str, granularity: str) -> DataFrame:
    """Tables that extracts want in more than one granularity."""
    found = extracts.groupBy(table).agg(F.sort_array(F.collect_set(granularity)).alias("granularities"))
    return found.where(F.size("granularities") > 1)


def status_totals(jobs: DataFrame, by: str, status: str = "status", rows: str = "rows") -> DataFrame:
    """Jobs by outcome and rows loaded, per extract."""
    each = [F.count_if(F.col(status) == s).alias(s) for s in ("success", "failed", "skipped")]
    return jobs.groupBy(by).agg(*each, F.sum(F.when(F.col(status) == "success", F.col(rows)).otherwise(0)).alias("rows"))
