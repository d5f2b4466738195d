"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source gets a number of blocks; a tree over the output shards splits all sources' block quotas, node by
node, by multivariate-hypergeometric draws, so that every shard holds a random, exactly accounted share; each
shard then draws its disjoint run of the source's permuted blocks and shuffles locally.

A block is a share of its source in a random but repeatable order (a hash of the document), ``BLOCKS`` of them for each
shard of the whole mix; a source has as many as its size asks for, at least one. Sources, their targets, the tree's cells (a row for each
source that a node has blocks of) and blocks are rows of tables: the driver sees sums. Sources and blocks are
broadcast up to a counted size and joined by a shuffle beyond. A source that holds a third of all rows is
spread over its blocks.

Null and blank texts have size 0; a source that has only those has target 0. A null source is a source of its
own, last in order. The order within a source is a hash of id and text, so rows without an id, or of one id and
different texts, are drawn apart; rows equal in both count each and get equal draws. Very long texts count like
others; the miss of a source's target is at most half of one document. An empty table gives an empty result. Extra
columns of any name pass through ``mix``; its own output columns replace clashing ones.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reportlake.llm.common import Scratch, n_words_of, named, shuffle_partitions, small, table, without
from reportlake.llm.merkle import placed

#: Words of a shard; from this follow the number of shards, within bounds, and of blocks.
SHARD_WORDS = 4_000_000
SHARDS = (16, 32_768)
BLOCKS = 256
WEIGHTS = (5, 2, 1)
TOTAL = Fraction(3, 2)
MOST = 2
OWN = ("size", "source_size", "target", "taken", "copies", "shards")


def targets(sizes: Sequence[int], weights: Sequence[int], total: Fraction = TOTAL, most: int = MOST) -> list[Fraction]:
    """Shares of ``total`` times all sizes by weight; none above ``most`` times its size, the excess reshared."""
    left, open_, out = total * sum(sizes), list(range(len(sizes))), [Fraction(0)] * len(sizes)
    while open_:
        w = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] > most * sizes[i] * w]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / w
            break
        for i in full:
            out[i] = Fraction(most * sizes[i])
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def split_tree(quotas: Sequence[int], shards: int, seed: int) -> list[list[int]]:
    """Block quotas per shard and source: halves the shards, drawing each half's blocks without replacement."""
    if shards == 1:
        return [list(quotas)]
    rng = np.random.default_rng([seed, shards, zlib.crc32(repr(tuple(quotas)).encode())])
    first = shards // 2
    left = hypergeometric(rng, quotas, sum(quotas) * first // shards)
    rest = [q - x for q, x in zip(quotas, left)]
    return split_tree(left, first, seed * 2 + 1) + split_tree(rest, shards - first, seed * 2 + 2)


#: What one draw of numpy's takes at most.
DRAWN = 10**9


def hypergeometric(rng: np.random.Generator, quotas: Sequence[int], draws: int) -> list[int]:
    """How many of ``draws`` blocks, drawn without replacement, are of each source; of very many blocks part by part."""
    if sum(quotas) < DRAWN:
        return [int(x) for x in rng.multivariate_hypergeometric(np.asarray(quotas, np.int64), draws, method="marginals")]
    # Beyond it every source's blocks are dealt to parts evenly, and each part gets its share of the draws.
    parts = -(-2 * sum(quotas) // DRAWN)
    out = [0] * len(quotas)
    left, done = sum(quotas), 0
    for k in range(parts):
        part = [(q * (k + 1)) // parts - (q * k) // parts for q in quotas]
        want = (draws - done) * sum(part) // left if left else 0
        got = hypergeometric(rng, part, want)
        out, left, done = [x + y for x, y in zip(out, got)], left - sum(part), done + want
    return out


#: Shards below which a node's subtree is drawn in one task, and sources that are drawn together in a larger one.
SUBTREE, BUCKET = 16, 2048


def water_level(sources: DataFrame, total: int) -> tuple[Fraction, int]:
    """(left, weight): an open source's target is ``left * w / weight``; ``sources`` has words and w.

    Rounds of one aggregation: those over ``MOST`` times their size are closed, and what they leave over is shared anew,
    until a round closes none. The driver holds the sums, in exact integers (halves count as one).
    """
    twice, number = int(2 * TOTAL * total), "decimal(38,0)"
    left, weight = twice, sources.agg(F.sum("w")).first()[0] or 0
    while weight:
        # left / 2 * w / weight > MOST * words, without fractions
        full = F.lit(left).cast(number) * F.col("w") > F.lit(2 * MOST * weight).cast(number) * F.col("words")
        got = sources.agg(F.coalesce(F.sum(F.when(full, F.col("words"))), F.lit(0)).alias("closed"), F.coalesce(F.sum(F.when(~full, F.col("w"))), F.lit(0)).alias("w")).first()
        now = (twice - 2 * MOST * int(got["closed"]), int(got["w"]))
        if now == (left, weight):
            break
        left, weight = now
    return Fraction(left, 2), weight


def split_cells(cells: DataFrame, shards: int, seed: int, scratch: Scratch) -> DataFrame:
    """(_s, shard, n): the splitting tree over cells (_s, quota), a row for each source that a node holds blocks of.

    A level halves every node's shards. Of a node with many sources, buckets of them share its draws first, then each
    bucket's sources theirs; nodes of few shards are drawn to their leaves in one task (``split_tree``).
    """

    def halve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("bucket")
        n, at = int(rows["shards"].iloc[0]), int(rows["first"].iloc[0])
        quotas = [int(q) for q in rows["quota"]]
        draws = hypergeometric(np.random.default_rng([seed, 1, at, n]), quotas, sum(quotas) * (n // 2) // n)
        return pd.DataFrame({"first": rows["first"], "bucket": rows["bucket"], "draws": np.array(draws, np.int64)})

    def deal(rows: pd.DataFrame, share: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_s")
        n, at, bucket = int(rows["shards"].iloc[0]), int(rows["first"].iloc[0]), int(rows["_s"].iloc[0]) // BUCKET
        left = np.array(hypergeometric(np.random.default_rng([seed, 2, at, n, bucket]), [int(q) for q in rows["quota"]], int(share["draws"].iloc[0])), np.int64)
        halves = [rows.assign(shards=n // 2, quota=left), rows.assign(first=at + n // 2, shards=n - n // 2, quota=rows["quota"] - left)]
        out = pd.concat(halves)
        return out[out["quota"] > 0][["_s", "first", "shards", "quota"]]

    def leaves(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_s")
        at, n = int(rows["first"].iloc[0]), int(rows["shards"].iloc[0])
        drawn = np.array(split_tree([int(q) for q in rows["quota"]], n, seed + 1 + at), np.int64).reshape(n, -1)
        shard, i = np.nonzero(drawn)
        return pd.DataFrame({"_s": rows["_s"].to_numpy()[i], "shard": (at + shard).astype(np.int32), "n": drawn[shard, i]})

    nodes = cells.where("quota > 0").select("_s", F.lit(0).alias("first"), F.lit(shards).alias("shards"), F.col("quota").cast("long"))
    width, level = shards, 0
    while width > SUBTREE:
        held = nodes.withColumn("bucket", F.floor(F.col("_s") / BUCKET).cast("long"))
        sums = held.groupBy("first", "shards", "bucket").agg(F.sum("quota").alias("quota"))
        shares = sums.groupBy("first").applyInPandas(halve, "first int, bucket long, draws long")
        nodes = held.groupBy("first", "bucket").cogroup(shares.groupBy("first", "bucket")).applyInPandas(deal, "_s long, first int, shards int, quota long")
        nodes, width, level = scratch.save(nodes, f"nodes{level}"), width - width // 2, level + 1
    return nodes.groupBy("first").applyInPandas(leaves, "_s long, shard int, n long")


def planned(sized: DataFrame, scratch: Scratch, weights: Sequence[int], shard_words: int) -> tuple[DataFrame, int]:
    """A row a source (g, _s, words, target, passes, rest, blocks), and the number of shards."""
    sources = sized.groupBy("g").agg(F.sum("size").alias("words"))
    one = sources.select("words", F.col("g").alias("name"), F.lit("").alias("g"))
    sources = scratch.save(placed(one, scratch, "order", "name").select(F.col("name").alias("g"), F.col("idx").alias("_s"), "words"), "sources")
    w = F.element_at(F.lit(list(weights)), (F.col("_s") % len(weights) + 1).cast("int"))
    sources = sources.withColumn("w", w)
    total = sources.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    shards = min(max(-(-int(TOTAL * total) // shard_words), SHARDS[0]), SHARDS[1])
    left, weight = water_level(sources, total)
    share, number = F.lit(2 * left.numerator // left.denominator).cast("decimal(38,0)") * F.col("w"), "decimal(38,0)"
    whole = F.lit(MOST) * F.col("words")
    open_ = share <= F.lit(2 * weight).cast(number) * whole.cast(number) if weight else F.lit(False)
    target = F.when(open_, share.cast("double") / F.lit(float(2 * weight or 1))).otherwise(whole.cast("double"))
    reached = [(share >= F.lit(2 * weight * k).cast(number) * F.col("words")).cast("int") for k in range(1, MOST + 1)]
    passes = F.when(F.col("words") == 0, 0).when(open_, sum(reached[1:], reached[0])).otherwise(MOST)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("words") / F.lit(max(total, 1)) * BLOCKS * shards)).cast("int")
    out = sources.select("g", "_s", "words", target.alias("target"), passes.cast("int").alias("passes"), blocks.alias("blocks"))
    return scratch.save(out.withColumn("rest", F.col("target") - F.col("passes") * F.col("words")), "plan"), shards


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", seed: int = 7, shard_words: int = SHARD_WORDS, weights: Sequence[int] = WEIGHTS, keep_text: bool = True) -> DataFrame:
    """Every row of ``docs`` with its size, its source's size and target, ``copies`` and the output ``shards`` of the copies.

    A source whose target is r whole passes and a rest takes every document r times and, for the rest, the
    leading blocks of its order and of the block after those the leading documents that still fit, so that the
    words taken miss the target by at most half a document. Without ``keep_text`` only the key and the source
    come along, and every text is read once.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    # A hash of the key and the text gives the order within a source; a null source comes last.
    order = F.xxhash64(named(key).cast("string"), named(text), F.lit(seed))
    g = F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("-"))
    sized = docs.select(named(key).alias("_key"), F.col("source").alias("_source"), g.alias("g"), n_words_of(named(text)).alias("size"), order.alias("_order"))
    sized = scratch.save(sized, "sized")
    plan, shards = planned(sized, scratch, weights, shard_words)
    plan = small(plan)
    slot = F.pmod(F.col("_order"), F.col("blocks")).cast("int")
    placed_docs = sized.join(plan.select("g", "_s", "blocks"), "g").withColumn("block", slot)
    per_block = scratch.save(placed_docs.groupBy("_s", "block").agg(F.sum("size").alias("words")), "blocks")
    # Leading blocks of each source that fit its rest whole; `edge` is the one that fits in part.
    upto = per_block.withColumn("upto", F.sum("words").over(W.partitionBy("_s").orderBy("block").rowsBetween(W.unboundedPreceding, 0)))
    cut = upto.join(plan.select("_s", "passes", "rest"), "_s").select("_s", "block", "passes", (F.col("upto") <= F.col("rest")).alias("whole"), (F.col("rest") - (F.col("upto") - F.col("words"))).alias("space"))
    cut = cut.withColumn("edge", ~F.col("whole") & (F.col("space") > 0))
    # Quotas in blocks: each pass draws all of a source's blocks, the rest those that it reaches.
    drawn = scratch.save(cut.withColumn("n", F.col("passes") + (F.col("whole") | F.col("edge")).cast("int")), "drawn")
    cells = split_cells(drawn.groupBy("_s").agg(F.sum("n").alias("quota")), shards, seed, scratch)
    # A source's block draws in permuted order; every shard takes its own run of them.
    before = F.coalesce(F.sum("n").over(W.partitionBy("_s").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = scratch.save(cells, "cells").withColumn("_at", before)
    runs = runs.select("_s", "shard", F.explode(F.sequence("_at", F.col("_at") + F.col("n") - 1)).alias("nth"))
    draw = drawn.where("n > 0").select("_s", "block", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy"))
    by = [F.xxhash64("block", "copy", F.lit(seed)), F.col("block"), F.col("copy")]
    draw = draw.withColumn("nth", F.row_number().over(W.partitionBy("_s").orderBy(*by)) - 1)
    met = draw.join(scratch.save(runs, "runs"), ["_s", "nth"])
    met = met.groupBy("_s", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("copy", "shard"))), lambda x: x["shard"]).alias("_shards"))
    # Of each edge block the leading documents: hash ranges first, then the one range where the space ends, by
    # exact hash (rows of one key share it, and go in or stay out together). The cut is one row per source.
    bound = scratch.save(drawn.where("edge").select("_s", "block", "space"), "bound")
    edge = placed_docs.join(small(bound), ["_s", "block"])
    edge = scratch.save(edge.groupBy("_s", _range(F.col("_order")).alias("part"), "_order", "space").agg(F.sum("size").alias("w")), "edge")
    upto = F.sum("w").over(W.partitionBy("_s").orderBy("part").rowsBetween(W.unboundedPreceding, 0))
    ranges = edge.groupBy("_s", "part").agg(F.sum("w").alias("w"), F.first("space").alias("space")).withColumn("upto", upto)
    ends = ranges.where("upto > space AND upto - w <= space").select("_s", "part", (F.col("space") - (F.col("upto") - F.col("w"))).alias("room"))
    last = edge.join(small(scratch.save(ends, "ends")), ["_s", "part"])
    last = last.withColumn("upto", F.sum("w").over(W.partitionBy("_s").orderBy("_order").rowsBetween(W.unboundedPreceding, 0)))
    # The document that crosses the end goes in where that misses the target by less.
    fits = (F.col("upto") <= F.col("room")) | ((F.col("upto") - F.col("w") < F.col("room")) & (2 * F.col("upto") - F.col("w") <= 2 * F.col("room")))
    cuts = last.groupBy("_s").agg(F.first("part").alias("cut_part"), F.max(F.when(fits, F.col("_order"))).alias("cut_order"))
    info = drawn.join(met, ["_s", "block"], "left").join(small(scratch.save(cuts, "cuts")), "_s", "left")
    info = info.select("_s", F.col("block").alias("_block"), "whole", "edge", "cut_part", "cut_order", "_shards")
    if keep_text:  # rows travel as structs, so their columns may have any names
        kept = without(docs, *OWN)
        base = docs.select(F.struct(*map(named, kept)).alias("_row"), g.alias("g"), n_words_of(named(text)).alias("_size"), order.alias("_order"))
    else:
        kept = [key, "source"]
        base = sized.select(F.struct(F.col("_key").alias(key), F.col("_source").alias("source")).alias("_row"), "g", F.col("size").alias("_size"), "_order")
    told = plan.select("g", "_s", F.col("words").alias("source_size"), "target", "passes", "blocks")
    out = base.join(told, "g").withColumn("_block", slot).join(small(scratch.save(info, "told")), ["_s", "_block"], "left")
    before = (_range(F.col("_order")) < F.col("cut_part")) | ((_range(F.col("_order")) == F.col("cut_part")) & (F.col("_order") <= F.col("cut_order")))
    copies = F.col("passes") + F.when(F.col("whole") | (F.col("edge") & F.coalesce(before, F.lit(False))), 1).otherwise(0)
    out = out.withColumn("copies", copies)
    return out.select(*[F.col("_row")[c].alias(c) for c in kept], F.col("_size").alias("size"), "source_size", "target", "copies", (F.col("copies") * F.col("_size")).alias("taken"), F.slice(F.coalesce("_shards", F.array().cast("array<int>")), 1, F.greatest("copies", F.lit(0))).alias("shards"))


def _range(order):
    return F.shiftrightunsigned(order, 52)


def emit(mixed: DataFrame, columns: Sequence[str], key: str = "doc_id", seed: int = 7) -> DataFrame:
    """``columns`` of the drawn rows, one for each copy, shards apart and each shuffled locally, by hash."""
    row = F.struct(*map(named, columns)).alias("_row")
    out = mixed.where("copies > 0").select(row, named(key).cast("string").alias("_key"), F.posexplode("shards").alias("_copy", "_shard"))
    out = out.withColumn("_at", F.xxhash64("_key", "_copy", F.lit(seed + 1)))
    dealt = out.repartitionById(shuffle_partitions(mixed.sparkSession), "_shard").sortWithinPartitions("_shard", "_at")
    return dealt.select(*[F.col("_row")[c].alias(c) for c in columns])


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), keep_text=False).select("doc_id", "size", "source_size", "target", "taken", "copies", "shards")
