"""Suffix-array dedup: cut every byte that lies in a 100-byte string which also starts earlier in the corpus.

Sorting all suffixes of a corpus is out of reach, so suffixes meet by content-chosen anchors. The anchor of a window
of ``LENGTH`` bytes is its ``GRAM``-byte string of the smallest hash, the first of equals; equal windows choose equal
anchors. An anchor's context is the union of the windows that choose it, at most ``LEFT`` bytes before it and
``LENGTH`` from it on. A string of LENGTH bytes or more inside the contexts of two equal anchors chooses this anchor
wherever it occurs, so an anchor's contexts hold all its occurrences. Steps:

1. Tasks find the anchors of whole texts. Anchors are counted by their hash, with partial sums, and those found once go.
2. Equal contexts of an anchor are one class, with its first occurrence and its number of occurrences.
3. The contexts of an anchor that has several classes are cut from the documents, one for each class, and dealt by the
   anchor. Each task builds an enhanced suffix array over them: the suffixes that start at the anchor and the strings
   that end before it, both sorted, with the common-prefix lengths of neighbours. A stack scan of the common prefixes
   gives the tree of their intervals. An interval of suffixes is a maximal repeat if it is left-diverse (its members
   continue differently to the left, or their contexts end) and LENGTH bytes long; it is put out with all its classes.
4. An anchor of more than ``DISTINCT`` classes goes to no single task: its windows are dealt one by one, by their own
   hash, as rows of joins and aggregates that adaptive execution splits.
5. All occurrences of a group but the first are cut. Per class only the longest stretch is needed, since all groups of
   a class hold the anchor; the occurrences meet their class by an equi-join, and the documents their own spans.

Hashes of 64 bits stand for anchors, for contexts of an anchor and, in step 4, for windows of an anchor; bytes are
compared in step 3. A task holds at most ``CONTEXTS`` contexts (``DISTINCT`` of one anchor) and one batch of texts.

Null texts are empty; texts under LENGTH bytes are kept whole; very long texts are read whole, one batch of bounded
bytes at a time. Rows of equal ids and texts share their places: copies of a row are not repeats of each other.
Different texts under one id are documents of their own, and so is each row with a null id; nulls come first. A row is
cut only at spans found in its own text. Empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.llm.common import Scratch, settings, shuffle_partitions, table

LENGTH = 100
GRAM = 32
LEFT = LENGTH - GRAM
BATCH = 1000
#: Different contexts of an anchor that one task takes (measured: 3 seconds at the worst), and contexts of several
#: anchors that it scans at a time.
DISTINCT, CONTEXTS = 32_768, 4096
BASE = np.uint64(0x9E3779B97F4A7C15)
VALUES = np.frombuffer(hashlib.shake_256(b"byte values").digest(256 * 8), np.uint64)
LOW = np.uint64(0xFFFFFFFF)
ANCHOR = "h long, context long, doc long, at int, back int, ahead int"
GROUP = "`group` long, h long, context long, doc long, at int, back int, ahead int, leads boolean"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Roller:
    """Hashes of any stretches of a byte string from running sums of its bytes times powers."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            n = max(2 * len(data), 1 << 16)
            back = np.uint64(pow(int(BASE), -1, 1 << 64))
            self.up, self.down = (np.cumprod(np.append(np.uint64(1), np.full(n - 1, x, np.uint64)), dtype=np.uint64) for x in (BASE, back))
        return np.append(np.uint64(0), np.cumsum(VALUES[data] * self.up[: len(data)], dtype=np.uint64))

    def hashes(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((sums[end] - sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64))


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    span = 1
    while span < width:
        step = min(span, width - span)
        x = np.minimum(x[:-step], x[step:])
        span += step
    return x


def anchors(data: np.ndarray, roller: Roller) -> tuple[np.ndarray, ...]:
    """Of a text's anchors: hash, hash of the context, position, bytes of the context before it and from it on."""
    n = len(data)
    if n < LENGTH:
        none = np.empty(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    sums = roller.sums(data)
    h = _mix((sums[GRAM:] - sums[:-GRAM]) * roller.down[: n - GRAM + 1] + np.uint64(GRAM))
    # The place behind the hash makes the first of equals the least; a run of windows chooses one place.
    chosen = _sliding_least((h & ~LOW) | np.arange(len(h), dtype=np.uint64), LEFT + 1) & LOW
    begin = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
    end = np.append(begin[1:], len(chosen)) - 1 + LENGTH
    at = chosen[begin].astype(np.int64)
    return h[at], _mix(roller.hashes(sums, begin, end) + (at - begin).astype(np.uint64)), at, at - begin, end - at


def _bytes(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint8) if value.is_valid else np.empty(0, np.uint8)


def _batch(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    """Arrow columns of a schema's names; unsigned numbers are read as signed."""
    names = [c.split()[0].strip("`") for c in schema.split(", ")]
    kinds = {"long": np.int64, "int": np.int32, "boolean": np.bool_}
    wanted = [kinds[c.split()[1]] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(k, copy=False)) for c, k in zip(columns, wanted)], names)


def find_anchors(docs: DataFrame) -> DataFrame:
    """ANCHOR rows of the documents (doc, data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller()
        for batch in batches:
            found = [anchors(_bytes(v), roller) for v in batch.column(1)]
            if found:
                h, context, at, back, ahead = map(np.concatenate, zip(*found))
                yield _batch(ANCHOR, h, context, np.repeat(np.asarray(batch.column(0)), [len(x[0]) for x in found]), at, back, ahead)

    return docs.select("doc", "data").mapInArrow(run, ANCHOR)


def cut_contexts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``classes`` with the bytes of their contexts, read where each class occurs first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(2).flatten().flatten()
            texts = []
            for value, asked in zip(batch.column(1), batch.column(2)):
                data = value.as_py()
                at, back, ahead = (asked.values.field(c).to_pylist() for c in ("at", "back", "ahead"))
                texts += [data[a - b : a + c] for a, b, c in zip(at, back, ahead)]
            if texts:
                doc = pa.array(np.repeat(np.asarray(batch.column(0)), [len(x) for x in batch.column(2)]))
                yield pa.RecordBatch.from_arrays([*places, doc, pa.array(texts, pa.binary())], ["h", "context", "at", "back", "ahead", "weight", "m", "doc", "data"])

    asked = classes.groupBy("doc").agg(F.collect_list(F.struct("h", "context", "at", "back", "ahead", "weight", "m")).alias("places"))
    joined = docs.join(asked.hint("merge"), "doc").select("doc", "data", "places")
    return joined.mapInArrow(run, "h long, context long, at int, back int, ahead int, weight long, m long, doc long, data binary")


def intervals(lcp: np.ndarray | list, least: int = 0) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of the intervals of sorted strings; ``lcp[i]`` is what i - 1 and i have in common.

    A stack scan: an interval closes where a neighbour has less in common. Children come before their parents.
    """
    stack: list[tuple[int, int]] = []
    for i in range(1, len(lcp) + 1):
        depth, first = (lcp[i] if i < len(lcp) else -1), i - 1
        while stack and stack[-1][0] > depth:
            common, first = stack.pop()
            yield common, first, i - 1
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def _sorted(bucket: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by bucket and bytes, and what each has in common with the one before (-1: another bucket)."""
    n, width = text.shape
    key = np.concatenate([bucket.astype(">u4").view(np.uint8).reshape(n, 4), text], axis=1)
    order = np.argsort(np.ascontiguousarray(key).view(f"S{width + 4}").ravel(), kind="stable")
    x, b = text[order], bucket[order]
    same = (x[1:] == x[:-1]) & (x[1:] > 0)
    common = np.where(same.all(axis=1), width, same.argmin(axis=1))
    return order, np.append(-1, np.where(b[1:] == b[:-1], common, -1))


def repeat_groups(left: np.ndarray, left_lcp: list, rank: np.ndarray, right_lcp: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(bytes before the anchor, bytes from it on, members) of the maximal repeats of one anchor's contexts.

    ``left``: contexts in the order of what lies before the anchor, read backwards; ``rank``: each context's place in
    the order of what lies from it on. An interval of the left order holds the suffixes that start so far before the
    anchor; those with enough in common to the right are the intervals of its right order.
    """
    most = int(right_lcp.max())
    for back, i, j in intervals(left_lcp):
        if back + most < LENGTH:
            continue
        rows = left[i : j + 1]
        child = np.append(0, np.cumsum(np.equal(left_lcp[i + 1 : j + 1], back)))
        by = np.argsort(rank[rows])
        at, rows, child = rank[rows][by], rows[by], child[by]
        common = np.minimum.reduceat(right_lcp[: at[-1] + 1], at[:-1] + 1)
        for ahead, x, y in intervals([-1, *common.tolist()], LENGTH - back):
            if _diverse(child[x : y + 1]):
                yield back, ahead, rows[x : y + 1]


def _diverse(child: np.ndarray) -> bool:
    """Whether suffixes continue differently to the left: they are of several branches there."""
    return bool((child != child[0]).any())


def scan_anchors(rows: pa.Table, every: bool = True) -> pa.RecordBatch:
    """GROUP rows of the contexts of whole anchors, which are sorted by anchor.

    Without ``every`` not of each group but of each class, led or not: the most bytes on either side in any group.
    """
    rows = rows.combine_chunks()
    h, context, doc, at, back, ahead, weight = (np.asarray(rows.column(c)) for c in ("h", "context", "doc", "at", "back", "ahead", "weight"))
    n = len(h)
    # One is added to every byte: zero is the end of a context, and UTF-8 has no 255.
    data = np.frombuffer(b"".join(rows.column("data").to_pylist()), np.uint8) + np.uint8(1)
    begin = np.append(0, np.cumsum(back + ahead))[:-1] + back
    before, after = np.arange(LEFT), np.arange(LENGTH)
    data = np.append(data, np.zeros(LENGTH, np.uint8))
    one = np.where(before < back[:, None], data[np.maximum(begin[:, None] - 1 - before, 0)], 0)
    two = np.where(after < ahead[:, None], data[begin[:, None] + after], 0)
    bucket = np.cumsum(np.append(False, h[1:] != h[:-1]))
    (left, left_lcp), (right, right_lcp) = _sorted(bucket, one), _sorted(bucket, two)
    rank = np.empty(n, np.int64)
    rank[right] = np.arange(n)
    # A context whose best neighbours on either side are too short together is in no group of several.
    best = []
    for order, lcp in ((left, left_lcp), (right, right_lcp)):
        x = np.empty(n, np.int64)
        x[order] = np.maximum(lcp, np.append(lcp[1:], -1))
        best.append(x)
    some = best[0] + best[1] >= LENGTH
    opens = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    found: list[tuple[int, int, np.ndarray]] = []
    for first, last in zip(opens.tolist(), np.append(opens[1:], n).tolist()):
        if some[first:last].any():
            part = slice(first, last)
            found += [(b, a, m + first) for b, a, m in repeat_groups(left[part] - first, left_lcp[part].tolist(), rank[part] - first, right_lcp[part])]
    whole = np.zeros(n, bool)  # members of a group that is their whole context
    for b, a, m in found:
        whole[m[(back[m] == b) & (ahead[m] == a)]] = True
    # A class of several occurrences is a leaf that is an interval by itself.
    found += [(int(back[i]), int(ahead[i]), np.array([i])) for i in np.flatnonzero((weight > 1) & ~whole)]
    size = np.array([len(m) for _, _, m in found], np.int64)
    member = np.concatenate([m for _, _, m in found]) if found else np.empty(0, np.int64)
    b, a = (np.repeat(np.array([f[k] for f in found], np.int64), size) for k in (0, 1))
    nth = np.repeat(np.arange(len(found)), size)
    by = np.lexsort((at[member], doc[member], nth))
    member, leads = member[by], np.append(True, nth[1:] != nth[:-1])[: len(member)]
    if not every and len(member):
        by = np.lexsort((leads, member))
        opens = np.flatnonzero(np.append(True, (member[by][1:] != member[by][:-1]) | (leads[by][1:] != leads[by][:-1])))
        b, a = np.maximum.reduceat(b[by], opens), np.maximum.reduceat(a[by], opens)
        member, leads = member[by][opens], leads[by][opens]
        lead = member
    else:
        lead = member[leads][nth] if len(member) else member
    name = _mix(_mix(h[lead].view(np.uint64) + doc[lead].view(np.uint64) * BASE) + (at[lead].astype(np.uint64) << np.uint64(16)) + (b * 256 + a).astype(np.uint64))
    return _batch(GROUP, name, h[member], context[member], doc[member], at[member], b, a, leads)


def scan(contexts: int = CONTEXTS, every: bool = True):
    """Step 3 over rows sorted by anchor, some ``contexts`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= contexts:
                rows = pa.Table.from_batches(held)
                h = np.asarray(rows.column("h"))
                whole = int(np.flatnonzero(h != h[-1])[-1]) + 1 if (h != h[-1]).any() else 0
                if whole:
                    yield scan_anchors(rows.slice(0, whole), every)
                    held, n = rows.slice(whole).to_batches(), n - whole
        if n:
            yield scan_anchors(pa.Table.from_batches(held), every)

    return run


WINDOW = "h long, context long, doc long, at int, weight long, back int, w long"


def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 4: every window of the contexts, with its hash."""
    roller = Roller()
    for batch in batches:
        if not batch.num_rows:
            continue
        h, context, doc, at, back, ahead, weight = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("h", "context", "doc", "at", "back", "ahead", "weight"))
        data = batch.column(batch.schema.get_field_index("data")).to_pylist()
        for k in range(0, len(h), CONTEXTS):
            part = slice(k, k + CONTEXTS)
            sums = roller.sums(np.frombuffer(b"".join(data[part]), np.uint8))
            size = (back + ahead)[part]
            begin = np.append(0, np.cumsum(size))[:-1]
            many = size - LENGTH + 1
            row = np.repeat(np.arange(len(size)), many)
            start = np.arange(len(row)) - np.repeat(np.append(0, np.cumsum(many))[:-1], many)
            w = roller.hashes(sums, begin[row] + start, begin[row] + start + LENGTH)
            yield _batch(WINDOW, *(x[part][row] for x in (h, context, doc, at, weight)), back[part][row] - start, w)


def _hot_groups(hot: DataFrame, scratch: Scratch) -> DataFrame:
    """GROUP rows of anchors with too many classes for one task: each window that occurs twice is a group."""
    found = hot.mapInArrow(windows, WINDOW)
    shared = found.groupBy("h", "w", "back").agg(F.sum("weight").alias("n"), F.min(F.struct("doc", "at")).alias("first")).where("n > 1")
    shared = scratch.save(shared.select("h", "w", "back", "first"), "shared")
    met = found.join(shared, ["h", "w", "back"])
    return met.select(F.xxhash64("h", "w", "back").alias("group"), "h", "context", "doc", "at", "back", (F.lit(LENGTH) - F.col("back")).alias("ahead"), (F.struct("doc", "at") == F.col("first")).alias("leads"))


def find_groups(docs: DataFrame, scratch: Scratch, every: bool = True) -> tuple[DataFrame, DataFrame]:
    """ANCHOR rows of the anchors found twice or more, and the GROUP rows of their maximal repeats, of documents (doc,
    data) each with a key of its own. A group's row stands for all occurrences of one class of contexts; without
    ``every`` a row may stand for a class in all its groups of one task, which is what the cuts need."""
    # Written once: the texts are not hashed again to meet the anchors that are found twice.
    found = scratch.save(find_anchors(docs), "found")
    twice = scratch.save(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "twice")
    rows = scratch.save(found.join(twice, "h").select("h", "context", "doc", "at", "back", "ahead"), "anchors")
    first = F.min(F.struct("doc", "at")).alias("f")
    same = rows.groupBy("h", "context").agg(F.count("*").alias("weight"), first, F.first("back").alias("back"), F.first("ahead").alias("ahead"))
    same = scratch.save(same.select("h", "context", "f.doc", "f.at", "back", "ahead", "weight"), "same")
    several = scratch.save(same.groupBy("h").agg(F.count("*").alias("m")).where("m > 1"), "several")
    classes = scratch.save(same.join(several, "h", "left").withColumn("m", F.coalesce("m", F.lit(1).cast("long"))), "classes")
    scratch.drop("found", "twice", "same", "several")
    # An anchor of one class is a suffix array of one leaf: its context is the group.
    name = F.xxhash64("h", "context", "doc", "at").alias("group")
    alone = classes.where("m = 1").select(name, "h", "context", "doc", "at", "back", "ahead", F.lit(True).alias("leads"))
    contexts = scratch.save(cut_contexts(docs, classes.where("m > 1")), "contexts")
    dealt = contexts.where(F.col("m") <= DISTINCT).repartition("h").sortWithinPartitions("h", "doc", "at")
    groups = alone.unionByName(dealt.mapInArrow(scan(CONTEXTS, every), GROUP))
    hot = contexts.where(F.col("m") > DISTINCT)
    if not hot.isEmpty():
        groups = groups.unionByName(_hot_groups(hot, scratch))
    groups = scratch.save(groups, "groups")
    scratch.drop("classes", "contexts", "shared")
    return rows, groups


def cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc, n_bytes, n_removed, n_spans, kept binary) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, runs, kept = [], [], [], []
            for value, places in zip(batch.column(1), batch.column(2)):
                data = value.as_py() or b""
                gone, n, parts, at = 0, 0, [], 0
                if places.is_valid:
                    lo, hi = (np.asarray(places.values.field(x)) for x in ("begin", "end"))
                    order = np.argsort(lo, kind="stable")
                    lo, top = lo[order], np.maximum.accumulate(np.minimum(hi[order], len(data)))
                    opens = np.flatnonzero(np.append(True, lo[1:] > top[:-1]))
                    for b, e in zip(lo[opens].tolist(), top[np.append(opens[1:], len(top)) - 1].tolist()):
                        if b < e:
                            parts.append(data[at:b])
                            gone, n, at = gone + e - b, n + 1, e
                parts.append(data[at:])
                total.append(len(data))
                removed.append(gone)
                runs.append(n)
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (total, removed, runs)), pa.array(kept, pa.binary())], ["doc", "n_bytes", "n_removed", "n_spans", "kept"])

    places = spans.groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("places"))
    joined = docs.join(places.hint("merge"), "doc", "left").select("doc", "data", "places")
    return joined.mapInArrow(run, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")


def _keyed(docs: DataFrame, scratch: Scratch, parts: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows under keys of their own, in the order of ids, and the id of each key (None: the ids are keys).

    A null id's rows have a key each; rows of equal ids and texts share one, rows of one id and different texts do not.
    """
    if docs.groupBy("doc").count().where("doc IS NULL OR count > 1").isEmpty():
        return docs, None
    row = F.when(F.col("doc").isNull(), F.monotonically_increasing_id())
    raw = docs.select(F.col("doc").alias("id"), F.md5("data").alias("digest"), row.alias("row"), "data")
    mark = F.concat_ws("/", F.col("id").cast("string"), F.col("row").cast("string"), F.col("id").isNull().cast("string"), "digest")
    raw = scratch.save(raw.withColumn("mark", F.md5(mark.cast("binary"))).drop("row"), "raw")
    order = [F.col("id").asc_nulls_first(), F.col("digest"), F.col("mark")]
    names = raw.groupBy("mark").agg(F.first("id").alias("id"), F.first("digest").alias("digest"))
    # Ranges in order, and rows in order within each: the numbers rise with the ids.
    names = names.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("doc", F.monotonically_increasing_id())
    names = scratch.save(names.select("mark", "id", "doc"), "names")
    keyed = scratch.save(raw.join(names.select("mark", "doc"), "mark").select("doc", "data"), "keyed")
    scratch.drop("raw")
    return keyed, names.select("doc", "id")


def _prepared(docs: DataFrame, text: str, key: str, scratch: Scratch, every: bool) -> tuple[DataFrame, DataFrame | None, DataFrame, DataFrame]:
    """The keyed rows, the ids of their keys, and what ``find_groups`` finds."""
    docs = docs.select(F.col(key).cast("long").alias("doc"), F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8").alias("data"))
    docs, names = _keyed(docs, scratch, shuffle_partitions(docs.sparkSession))
    with settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=BATCH):
        return docs, names, *find_groups(docs if names is None else docs.dropDuplicates(["doc"]), scratch, every)


def maximal_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(group, doc_id, begin, end): all occurrences, in bytes, of every repeated string of LENGTH bytes or more that is
    maximal within the reach of its anchor. A longer repeat is a chain of groups that overlap."""
    scratch = Scratch(docs.sparkSession, "repeats")
    _, names, rows, groups = _prepared(docs, text, key, scratch, every=True)
    met = groups.select("group", "h", "context", F.col("back").alias("b"), F.col("ahead").alias("a")).distinct().join(rows, ["h", "context"])
    out = met.select("group", "doc", (F.col("at") - F.col("b")).alias("begin"), (F.col("at") + F.col("a")).alias("end"))
    named = out.withColumn("id", F.col("doc")) if names is None else out.join(names, "doc")
    return named.select("group", F.col("id").alias("doc_id"), "begin", "end")


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; ``kept`` is what is left of the text's bytes."""
    scratch = Scratch(docs.sparkSession, "suffix")
    docs, names, rows, groups = _prepared(docs, text, key, scratch, every=False)
    # What leads a group stays there, but may follow in another: the first occurrence of a class and its others differ.
    follows = [F.max(F.when(~F.col("leads"), F.col(c))).alias(f"first_{c}") for c in ("back", "ahead")]
    most = groups.groupBy("h", "context").agg(F.first("doc").alias("d"), F.first("at").alias("p"), *follows, *[F.max(c).alias(f"most_{c}") for c in ("back", "ahead")])
    most = scratch.save(most, "most")
    own = (F.col("doc") == F.col("d")) & (F.col("at") == F.col("p"))
    back, ahead = (F.when(own, F.col(f"first_{c}")).otherwise(F.col(f"most_{c}")) for c in ("back", "ahead"))
    spans = rows.join(most, ["h", "context"]).select("doc", (F.col("at") - back).alias("begin"), (F.col("at") + ahead).alias("end"))
    spans = scratch.save(spans.where("begin IS NOT NULL"), "spans")
    scratch.drop("anchors", "groups", "most")
    out = cut(docs, spans)
    if names is not None:
        out = out.join(names, "doc").drop("doc").withColumnRenamed("id", "doc")
    return out.select(F.col("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: Bytes as hexadecimal digits, two each, since DuckDB has no substrings of blobs.
ORACLE = f"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, {2 * LENGTH})) AS m FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - {LENGTH - 1})) AS p FROM d)),
s AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY m ORDER BY doc_id, p) AS k FROM w) WHERE k > 1),
j AS (SELECT doc_id, p, sum(CASE WHEN p - coalesce(before, -{LENGTH + 1}) > {LENGTH} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (SELECT *, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM s)),
r AS (SELECT doc_id, run, min(p) AS a, max(p) + {LENGTH} AS b FROM j GROUP BY ALL),
g AS (SELECT doc_id, run, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM r),
k AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS top, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS kept FROM g JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(top, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""
