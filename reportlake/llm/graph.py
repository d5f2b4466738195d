"""Connected components by alternating large-star and small-star steps; every round is a few equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(id, component): the smallest reachable id for every id that occurs in ``edges`` (a, b).

    Labels only shrink, edges only move to smaller ids, and the loop ends when a round changes nothing; a hub's
    edges are met by joins on narrow rows that adaptive execution can split.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e, mark, turn = scratch.save(e, f"{name}0"), None, 0
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark, turn = now, turn + 1
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # The minima are written first: only joins of two plain shuffles can be split at a hub.
        low = scratch.save(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), f"{name}{turn}m")
        big = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        big = scratch.save(big, f"{name}{turn}l")
        low = scratch.save(big.groupBy("a").agg(F.min("b").alias("m")), f"{name}{turn}n")
        near = big.join(low, "a")
        near = near.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        e = scratch.save(near, f"{name}{turn}")
        scratch.drop(f"{name}{turn - 1}", *(f"{name}{turn}{x}" for x in "lmn"))
    roots = e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
