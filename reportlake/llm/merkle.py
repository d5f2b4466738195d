"""A Merkle manifest of a dataset: a digest of every row, a tree a source, a tree over the sources, proofs.

Rows are hashed where they lie. Leaves are range-sorted by (source, id), numbered within their source, and cut
into aligned blocks of ``FANOUT ** HEIGHT``; a block's digests are one contiguous matrix of 64-byte hexadecimal rows
that is reshaped by the fanout and hashed row by row, level by level. The nodes that blocks leave are the next
tier's leaves, until a source has one, its subroot; subroots are the leaves of one more tree. On the way down the same
matrices give every node's siblings by index arithmetic, and each block gets the path above it as one row, so only
digests (64 bytes a row and level) are shuffled, a source of any size is many tasks, and no tree is in one place.

Nulls are written as ``-`` and so differ from empty text. A null source is a source of its own, before all others. Null
ids come before all others of their source; rows of one id are ordered by their digest, so equal rows are
interchangeable. Very long texts are hashed one at a time, as a whole (up to the 2 GB of a JVM string). An empty table has no root and gives an
empty result. Columns that are not asked for are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reportlake.llm.common import Scratch, named, shuffle_partitions, small, table

FANOUT = 16
#: Levels that a block of leaves spans.
HEIGHT = 2
BLOCK = FANOUT**HEIGHT
DIGEST = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value: no two rows are written alike."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, values)), 256)


def digests(column: pa.ChunkedArray) -> np.ndarray:
    """The digests of an Arrow column as a contiguous matrix of 64 bytes a row."""
    return np.array(column.to_pylist(), f"S{DIGEST}").view(np.uint8).reshape(-1, DIGEST)


def climb(leaves: np.ndarray, whole: bool) -> list[np.ndarray]:
    """The levels above ``leaves``: until one node is left if they are the ``whole`` level, else ``HEIGHT`` of them."""
    levels = [leaves]
    while len(levels[-1]) > 1 if whole else len(levels) <= HEIGHT:
        last = levels[-1]
        full = len(last) // FANOUT * FANOUT
        runs = [*last[:full].reshape(-1, FANOUT * DIGEST), *([last[full:].reshape(-1)] if full < len(last) else [])]
        levels.append(np.array([sha256(r.tobytes()).hexdigest() for r in runs], f"S{DIGEST}").view(np.uint8).reshape(-1, DIGEST))
    return levels


def siblings(levels: list[np.ndarray], i: int) -> tuple[list[str], list[str]]:
    """What stands left and right of leaf ``i`` and of its ancestors in their runs, a text a level."""
    left, right = [], []
    for level in levels[:-1]:
        first = i - i % FANOUT
        left.append(level[first:i].tobytes().decode())
        right.append(level[i + 1 : first + FANOUT].tobytes().decode())
        i //= FANOUT
    return left, right


def _in_order(block: pa.Table) -> tuple[pa.Table, list[np.ndarray]]:
    block = block.sort_by("idx")
    return block, climb(digests(block.column("digest")), block.column("n")[0].as_py() <= BLOCK)


def _blocks(nodes: DataFrame):
    return nodes.withColumn("blk", F.floor(F.col("idx") / BLOCK).cast("long")).groupBy("g", "blk")


def reduced(nodes: DataFrame) -> DataFrame:
    """The next tier (g, idx, n, digest): one node for every block of (g, idx, n, digest)."""

    def top(block: pa.Table) -> pa.Table:
        block, levels = _in_order(block)
        n = -(-block.column("n")[0].as_py() // BLOCK)
        node = levels[-1].tobytes().decode()
        return pa.table({"g": block.column("g")[:1], "idx": block.column("blk")[:1], "n": pa.array([n], pa.int64()), "digest": [node]})

    return _blocks(nodes.select("g", "idx", "n", "digest")).applyInArrow(top, "g string, idx long, n long, digest string")


def descended(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """``nodes`` with ``lefts`` and ``rights``, their siblings from their own level up to the root.

    ``paths``: the same of each block's node, (g, blk, lefts, rights); its other columns go to all nodes of the block.
    """
    above = [c for c in paths.columns if c not in ("g", "blk", "lefts", "rights")]
    texts = pa.list_(pa.string())

    def spread(block: pa.Table, path: pa.Table) -> pa.Table:
        block, levels = _in_order(block)
        up, down = path.column("lefts")[0].as_py(), path.column("rights")[0].as_py()
        own = [siblings(levels, i) for i in range(block.num_rows)]
        block = block.drop_columns(["blk"])
        for name, values, field in (("lefts", [a + up for a, _ in own], texts), ("rights", [b + down for _, b in own], texts)):
            block = block.append_column(name, pa.array(values, field))
        for name in above:
            block = block.append_column(name, pa.array([path.column(name)[0].as_py()] * block.num_rows, pa.string()))
        return block

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema] + ["lefts array<string>", "rights array<string>", *(f"`{c}` string" for c in above)]
    return _blocks(nodes).cogroup(paths.groupBy("g", "blk")).applyInArrow(spread, ", ".join(kinds))


def placed(rows: DataFrame, scratch: Scratch, name: str, *order: str) -> DataFrame:
    """``rows`` with ``idx``, their place in the order within their ``g``, and ``n``, its size.

    A range sort numbers rows within its partitions; counts by (g, partition) put the partitions one behind the other.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("g", *order)]
    dealt = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    dealt = scratch.save(dealt.withColumn("_at", F.monotonically_increasing_id()), name).withColumn("_part", F.shiftright("_at", 33))
    runs = dealt.groupBy("g", "_part").agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("g").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("g", "_part", (before - F.col("_from")).alias("_shift"), F.sum("_n").over(W.partitionBy("g")).alias("n"))
    met = dealt.join(small(scratch.save(runs, f"{name}-runs")), ["g", "_part"])
    return met.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("idx"), "n")


def grown(nodes: DataFrame, scratch: Scratch, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The tiers above saved ``nodes``, themselves first, and (g, idx, n, digest) of the one node each ``g`` comes to."""
    tiers = [nodes]
    while True:
        up = scratch.save(reduced(tiers[-1]), f"{name}{len(tiers)}")
        if up.where("n > 1").isEmpty():
            return tiers, up
        tiers.append(up)


def manifest(rows: DataFrame, key: str = "doc_id", group: str = "source", digest: str = "leaf") -> DataFrame:
    """``rows`` with ``subroot``, ``root``, and the proof of each: ``lefts`` and ``rights``, a text a level.

    ``rows`` is narrow: a digest each, what orders it in its group, and what the caller wants back.
    """
    scratch = Scratch(rows.sparkSession, "merkle")
    # A null group sorts before all others, the empty one next.
    marked = rows.select("*", F.coalesce(F.concat(F.lit("+"), named(group)), F.lit("")).alias("g"), named(digest).alias("digest"))
    # Equal rows are dealt by their place, so that any number of them is cut into blocks.
    marked = scratch.save(marked, "leaves").withColumn("_tie", F.monotonically_increasing_id())
    leaves = scratch.save(placed(marked, scratch, "ordered", key, "digest", "_tie").drop("_tie"), "nodes")
    tiers, subroots = grown(leaves, scratch, "tier")
    sources = subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest")
    sources = scratch.save(placed(sources, scratch, "sources", "name"), "subroots")
    over, roots = grown(sources, scratch, "over")
    none = F.array().cast("array<string>")
    paths = roots.select("g", F.col("idx").alias("blk"), none.alias("lefts"), none.alias("rights"), F.col("digest").alias("root"))
    for tier in over[:0:-1]:
        paths = descended(tier, paths).select("g", F.col("idx").alias("blk"), "lefts", "rights", "root")
    paths = scratch.save(descended(over[0], paths).select(F.col("name").alias("g"), F.lit(0).cast("long").alias("blk"), "lefts", "rights", F.col("digest").alias("subroot"), "root"), "paths")
    for k, tier in enumerate(tiers[:0:-1]):
        paths = scratch.save(descended(tier, paths).select("g", F.col("idx").alias("blk"), "lefts", "rights", "subroot", "root"), f"paths{k}")
    return descended(leaves, paths).select(*[named(c) for c in rows.columns], "subroot", "root", "lefts", "rights")


def proof(lefts: Column, rights: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.flatten(F.zip_with(lefts, rights, lambda a, b: F.array(a, b))), "")


def folded(leaf: Column, lefts: Column, rights: Column) -> Column:
    """The root that a leaf and its siblings come to."""
    return F.aggregate(F.arrays_zip(lefts.alias("l"), rights.alias("r")), leaf, lambda d, s: F.sha2(F.concat(s["l"], d, s["r"]), 256))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    other = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS]
    hashed = docs.select("doc_id", "source", leaf_digest([F.col(c) for c in FIELDS]).alias("leaf"), F.when(tampered, leaf_digest(other)).alias("shown"))
    out = manifest(hashed)
    fold = folded(F.coalesce("shown", "leaf"), F.col("lefts"), F.col("rights"))
    out = out.select("doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("lefts"), F.col("rights")), 256).alias("proof_sha256"), fold.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: Levels that the SQL spells out: 16 ** 8 leaves.
_LEVELS = 8
#: CRC-32 of a short ASCII text, bit by bit.
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))), 4294967295)"


def _enc(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


def oracle_op11() -> str:
    whole = " || ".join(map(_enc, FIELDS))
    other = " || ".join(_enc(f"translate(text, '{UPPER}', '{LOWER}')" if c == "text" else c) for c in FIELDS)
    steps = [
        f"d AS (SELECT doc_id, coalesce('+' || source, '') AS g, sha256({whole}) AS leaf, CASE WHEN {_CRC} % 5 = 0 THEN sha256({other}) END AS shown FROM documents)",
        "a0 AS (SELECT *, leaf AS x, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d)",
    ]

    def tree(t: str, by: str) -> None:
        # r: the runs of a level, as lists; the next level has a node a run, until a group has one.
        for k in range(_LEVELS):
            steps.append(f"{t}r{k} AS (SELECT {by}, i // {FANOUT} AS i, max(n) AS n, list(x ORDER BY i) AS xs FROM {t}{k} GROUP BY {by}, i // {FANOUT})")
            steps.append(f"{t}{k + 1} AS (SELECT {by}, i, (n + {FANOUT - 1}) // {FANOUT} AS n, CASE WHEN n = 1 THEN xs[1] ELSE sha256(array_to_string(xs, '')) END AS x FROM {t}r{k})")

    tree("a", "g")
    steps.append(f"b0 AS (SELECT '' AS h, g, x, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM a{_LEVELS})")
    tree("b", "h")
    # The way up of every leaf: its siblings so far, and what the shown leaf has been folded into.
    steps.append(f"f0 AS (SELECT a0.*, s.x AS subroot, s.i AS j, s.n AS m, r.x AS root, coalesce(shown, leaf) AS y, '' AS p FROM a0 JOIN b0 s USING (g), b{_LEVELS} r)")
    for k in range(2 * _LEVELS):
        t, at, size, key = ("a", "i", "n", "g") if k < _LEVELS else ("b", "j", "m", "h")
        level, on = k % _LEVELS, "f.g = r.g AND" if k < _LEVELS else ""
        lo, hi = f"array_to_string(r.xs[:f.{at} % {FANOUT}], '')", f"array_to_string(r.xs[f.{at} % {FANOUT} + 2:], '')"
        steps.append(f"f{k + 1} AS (SELECT f.* REPLACE (f.{at} // {FANOUT} AS {at}, (f.{size} + {FANOUT - 1}) // {FANOUT} AS {size}, CASE WHEN f.{size} = 1 THEN f.p ELSE f.p || {lo} || {hi} END AS p, CASE WHEN f.{size} = 1 THEN f.y ELSE sha256({lo} || f.y || {hi}) END AS y) FROM f{k} f JOIN {t}r{level} r ON {on} r.i = f.{at} // {FANOUT})")
    steps = [s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps]
    return "WITH " + ",\n".join(steps) + f"\nSELECT doc_id, leaf, subroot, root, sha256(p) AS proof_sha256, y AS folded_root, y = root AS verified FROM f{2 * _LEVELS}"
