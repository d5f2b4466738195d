"""Best-fit packing of tokenised documents into sequences of fixed capacity, in bulk-synchronous rounds.

1. Tasks tokenise whole texts, end each document with a separator id and cut those longer than the capacity.
2. Pieces are range-sorted by length; every piece gets its rank among the pieces of its length.
3. Pieces longer than half a sequence each open one. Then rounds: a successor sweep over sizes, from large to
   small, gives every piece the smallest gap that holds it; where several pieces want the gaps of one size, rank
   decides who gets which; gaps take as many pieces of one length as fit; gaps are updated; and so on until no
   gap holds any piece left. Then as many sequences are opened as the rest needs at least, and rounds go on.

Counts by size (at most ``capacity`` classes for pieces and for gaps, whatever the input) are all the driver
sees; the matching itself is an equi-join on (gap size, rank), whose keys are unique on the gap side.

A null or empty text is one piece of one id (the separator). Repeated rows are packed each for itself. Null ids
pass through. An empty table gives an empty result. Extra columns are ignored. Very long texts are tokenised
whole, one at a time.
"""

from __future__ import annotations

import base64
import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reportlake.llm.common import Scratch, settings, shuffle_partitions, table

CAPACITY = 1024
SEPARATOR = 2
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Fixed value: the special token's text, which the tokenizer turns into one id.
SPECIAL = "<|endoftext|>"
#: Texts of other characters go through the slower library: both split Latin text alike, which is tested.
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e¡-ɏ–—‘-”…]")


@functools.cache
def _encoder(tokenizer: str | None, ranks: str | None):
    """Function from text to ids, the same as ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    With the vocabulary's ranks at hand, common Latin text goes through tiktoken, which gives the same ids in a
    fifth of the time; everything else through tokenizers.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if tokenizer is None:
        import public_tokenizers

        tokenizer, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    whole = Tokenizer.from_file(tokenizer)
    slow = lambda text: whole.encode(text, add_special_tokens=False).ids
    if ranks is None:
        return slow
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
    return lambda text: slow(text) if UNUSUAL.search(text) or SPECIAL in text else fast(text)


def tokenise(docs: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, tokenizer: str | None = None, ranks: str | None = None, with_ids: bool = False) -> DataFrame:
    """PIECE rows of every document; with ``with_ids`` also the ids, little-endian unsigned 32-bit, as binary."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer, ranks)
        for batch in batches:
            rows = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.asarray([*encode(value.as_py() or ""), SEPARATOR], dtype="<u4")
                first = len(ids) % capacity or capacity
                for piece, begin in enumerate([0, *range(first, len(ids), capacity)]):
                    data = ids[begin : first if piece == 0 else begin + capacity]
                    rows.append((doc_id, piece, begin, len(data), zlib.crc32(data.tobytes()), data.tobytes() if with_ids else None))
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 5 + with_ids]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names[: 5 + with_ids])

    out = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return out.mapInArrow(cut, PIECE + (", ids binary" if with_ids else ""))


def _ranked(pieces: DataFrame, scratch: Scratch) -> DataFrame:
    """Range-sorts by length and adds ``rank``, from 0 within each length; equal lengths are spread by hash."""
    by = ["length", "_h", "doc_id", "piece"]
    spread = pieces.withColumn("_h", F.xxhash64("doc_id", "piece"))
    ranges = spread.repartitionByRange(shuffle_partitions(pieces.sparkSession), *by).sortWithinPartitions(*by)
    at = F.monotonically_increasing_id()
    run = scratch.save(ranges.drop("_h").withColumns({"_part": F.shiftright(at, 33), "_at": at}), "sorted")
    runs = run.groupBy("length", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("length").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    runs = runs.withColumn("_before", before).drop("_n")
    # One row per length and range: at most ranges + lengths.
    out = run.join(F.broadcast(runs), ["length", "_part"]).withColumn("rank", F.col("_at") - F.col("_first") + F.col("_before"))
    return scratch.save(out.drop("_part", "_at", "_first", "_before"), "ranked")


def sweep(left: dict[int, list[int]], gaps: dict[int, int]) -> list[tuple[int, int, int, int, int, int]]:
    """One successor sweep over size classes.

    ``left``: length -> [next rank, end]; advanced. ``gaps``: size -> count. Returns the matched runs
    (length, first rank, gap size, first gap rank, number of gaps, pieces for each gap).
    """
    flows, stack = [], []  # the stack's top is the smallest gap seen so far
    for size in sorted({*left, *gaps}, reverse=True):
        if gaps.get(size):
            stack.append([size, 0, gaps[size]])
        span = left.get(size)
        while span and span[0] < span[1] and stack:
            gap, used, count = stack[-1]
            each, n = gap // size, span[1] - span[0]
            whole = min(count - used, n // each)
            if whole:
                flows.append((size, span[0], gap, used, whole, each))
                span[0] += whole * each
                used += whole
            elif used < count:  # fewer pieces are left than one gap holds
                flows.append((size, span[0], gap, used, 1, n))
                span[0] += n
                used += 1
            stack[-1][1] = used
            if used == count:
                stack.pop()
    return flows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (doc_id, piece, length, ...) of at most ``capacity``."""
    spark = pieces.sparkSession
    scratch = Scratch(spark, "packing")
    ranked = _ranked(pieces, scratch)
    left = {r["length"]: [0, r["n"]] for r in ranked.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # Pieces over half a sequence open one each: numbered by length and rank.
    opened, counts, begin = [], {}, 0
    for length in sorted((x for x in left if 2 * x > capacity), reverse=True):
        n = left.pop(length)[1]
        opened.append((length, begin))
        if length < capacity:
            counts[capacity - length] = n
        begin += n
    large = ranked.join(F.broadcast(spark.createDataFrame(opened, "length long, _begin long")), "length")
    large = large.withColumns({"sequence_id": F.col("_begin") + F.col("rank"), "offset": F.lit(0).cast("long")}).drop("_begin")
    small = scratch.save(ranked.where(2 * F.col("length") <= capacity), "small") if left else None
    gaps = scratch.save(large.where(F.col("length") < capacity).select("sequence_id", (capacity - F.col("length")).alias("gap"), F.col("rank").alias("nth")), "gaps0")
    done, turn = [large.drop("rank")], 0
    while left:
        flows, turn = sweep(left, counts), turn + 1
        left = {k: v for k, v in left.items() if v[0] < v[1]}
        if flows:
            placed, gaps, counts = _round(small, gaps, counts, flows, capacity, scratch, turn)
            done.append(placed.drop("rank"))
        elif left:
            n = -(-sum(k * (b - a) for k, (a, b) in left.items()) // capacity)
            fresh = spark.range(n).select((F.col("id") + begin).alias("sequence_id"), F.lit(capacity).cast("long").alias("gap"), F.col("id").alias("nth"))
            gaps, begin, counts = scratch.save(gaps.unionByName(fresh), f"gaps{turn}"), begin + n, counts | {capacity: n}
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _round(small: DataFrame, gaps: DataFrame, counts: dict[int, int], flows: list, capacity: int, scratch: Scratch, turn: int) -> tuple[DataFrame, DataFrame, dict[int, int]]:
    """Joins a sweep's runs to pieces and gaps: the pieces placed, the gaps left, their counts by size."""
    spark = small.sparkSession
    # Ranks of the gaps after the round: each run moves to its new size as a whole, behind what is there.
    after: dict[int, int] = {}
    rows, used = [], dict.fromkeys(counts, 0)
    for size, rank, gap, first, n, each in flows:
        new = gap - size * each
        rows.append((size, rank, rank + n * each, gap, first, first + n, each, new, after.get(new, 0)))
        after[new] = after.get(new, 0) + n
        used[gap] = max(used[gap], first + n)
    for gap, n in counts.items():
        if used[gap] < n:  # untouched gaps keep their size
            rows.append((0, 0, 0, gap, used[gap], n, 0, gap, after.get(gap, 0)))
            after[gap] = after.get(gap, 0) + n - used[gap]
    runs = F.broadcast(spark.createDataFrame(rows, "size long, lo long, hi long, gap long, first long, last long, each long, new long, base long"))
    match = small.alias("s").join(runs.alias("f"), (F.col("s.length") == F.col("f.size")) & (F.col("s.rank") >= F.col("f.lo")) & (F.col("s.rank") < F.col("f.hi")))
    n = F.col("s.rank") - F.col("f.lo")
    match = match.select("s.*", F.col("f.gap").alias("gap"), (F.col("f.first") + F.floor(n / F.col("f.each"))).alias("nth"), (capacity - F.col("f.gap") + F.pmod(n, F.col("f.each")) * F.col("s.length")).alias("offset"))
    placed = scratch.save(match.join(gaps, ["gap", "nth"]).drop("gap", "nth"), f"placed{turn}")
    moved = gaps.alias("g").join(runs.alias("f"), (F.col("g.gap") == F.col("f.gap")) & (F.col("g.nth") >= F.col("f.first")) & (F.col("g.nth") < F.col("f.last")))
    moved = moved.where("f.new > 0").select("g.sequence_id", F.col("f.new").alias("gap"), (F.col("f.base") + F.col("g.nth") - F.col("f.first")).alias("nth"))
    after.pop(0, None)
    return placed, scratch.save(moved, f"gaps{turn}"), after


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, **options: object) -> DataFrame:
    """Tokenises and packs: PIECE columns with ``sequence_id`` and ``offset``."""
    scratch = Scratch(docs.sparkSession, "pieces")
    with settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=500):
        pieces = scratch.save(tokenise(docs, capacity=capacity, **options), "pieces")
    return pack(pieces, capacity)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
