"""N-gram Jaccard join by a token-group matrix: connected components of documents that share 3/4 of their shingles.

A token is the 64-bit hash of five consecutive words. Steps, each a Spark job over all documents:

1. Tokens that many documents of a task share are counted; the most frequent go last in the order of tokens.
2. One pass gives each document its set's size and fingerprint, a few minimum hashes, and its prefix: under any
   fixed order of tokens two sets with similarity 3/4 share one of each one's first quarter + 1 tokens. Equal
   sets collapse to their smallest id.
3. Similar documents are partitioned into groups: documents with an equal minimum hash are compared with the
   smallest id that has it and with the one most like the others, and join the hub they are most similar to.
4. The matrix: (token, group) entries of the prefixes, dealt by token. Groups that share an entry are candidate
   pairs, unless they are all of one component.
5. Each such group's token union is stored, a row for each group and token with the number of members that have it.
   The documents that ask a group meet the union by an equi-join on group and token, which bounds what they have in
   common with any member. Only groups whose bound can reach 3/4 are opened, by the documents that reach it, block by
   block, and only links that join something are given out. Groups of one document are compared as they are.

All links between different components are found, so the components are exact; no partner is capped. Hashes of
64 bits stand for shingles.

Texts are hashed twice for the order and the prefixes; after that only the token sets of documents that are compared
are made, and these meet by shuffles at every size.

Null texts and texts without words have no tokens and link with nothing; very long texts are read whole. Texts of fewer than five words have one
token, the whole sequence. Repeated ids are one document (its links are those of any of its rows). Null ids are
left unlinked, each its own row with a null component. Empty tables give an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.llm.common import Scratch, settings, shuffle_partitions, table
from reportlake.llm.graph import components

WIDTH = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
HASHES = 8
#: Tokens that at least so many of ``COUNTED`` documents in a row share are counted for the order ...
COMMON, COUNTED = 3, 8000
#: Groups of a token that are paired at a time, pairs that a task counts before it hands them on, and entries of a task.
PAIRED, COUNTED_PAIRS, ENTRIES = 512, 500_000, 2_000_000
#: Groups of a frequent token in one row, and how an entry of one is written: group, component, sizes (of fewer than 2**31 tokens).
BLOCKED, ENTRY = 4096, (np.int64, np.int64, np.int32, np.int32)
#: ... and so many of the most frequent are remembered. The order decides speed only, never the result.
REMEMBERED = 1_000_000
BATCH = 1000
#: Minimum hashes a document must have in common with a hub to be compared with it.
AGREE = 3
#: Documents this similar to a hub are in its group, linked or not.
LOOSE = 0.4
#: Tokens on either side of a block in which groups are opened; a longer document is a block by itself.
BLOCK = 16_000
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
MIX, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
SALTS = np.array([xxhash.xxh64_intdigest(bytes([k])) | 1 for k in range(HASHES)], dtype=np.uint64)


class WordHashes(dict):
    """Hash of a word (bytes), remembered; forgets all when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def tokens(text: str | None, known: WordHashes) -> np.ndarray:
    """The document's set: sorted distinct 64-bit hashes."""
    return np.unique(shingles(text, known))


def shingles(text: str | None, known: WordHashes) -> np.ndarray:
    """Hashes of the document's shingles, one after the other."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    width = min(WIDTH, n)
    acc = h[: n - width + 1].copy()
    for k in range(1, width):
        acc = acc * MIX + h[k : n - width + 1 + k]
    acc = (acc ^ (acc >> np.uint64(29))) * MIX2 + np.uint64(width)
    return acc ^ (acc >> np.uint64(32))


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1 if n else 0


def _batches(docs: DataFrame, run, schema: str) -> DataFrame:
    return docs.mapInArrow(run, schema)


def common_tokens(docs: DataFrame, scratch: Scratch) -> np.ndarray:
    """The REMEMBERED most frequent tokens, ascending by frequency, as far as runs of documents hold them often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, got, size = WordHashes(), [], 0

        def often() -> pa.RecordBatch:
            value, n = np.unique(np.concatenate(got), return_counts=True)
            value, n = value[n >= COMMON], n[n >= COMMON]
            return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n)], ["token", "n"])

        for batch in batches:
            for v in batch.column(1):
                got.append(shingles(v.as_py(), known))  # a repeat in one document counts again, which does no harm here
                size += len(got[-1])
                if len(got) >= COUNTED or size >= 500 * COUNTED:  # some 30 MB of hashes at most
                    yield often()
                    got, size = [], 0
        if got:
            yield often()

    seen = _batches(docs, count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    seen = scratch.save(seen, "common").orderBy(F.desc("n"), "token").limit(REMEMBERED)
    return seen.toArrow().column("token").to_numpy().view(np.uint64)[::-1].copy()


def describe(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """Per row: doc_id, n, fingerprint, minimum hashes, prefix tokens (binary)."""
    order = np.argsort(common)
    ranked = common[order]
    shared = docs.sparkSession.sparkContext.broadcast((ranked, order.astype(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (last, rank) = WordHashes(), shared.value
        for batch in batches:
            size, mark, low, head = [], [], [], []
            for value in batch.column(1):
                t = tokens(value.as_py(), known)
                size.append(len(t))
                mark.append(xxhash.xxh3_128_digest(t.tobytes()))
                low.append([int(x) for x in (t[:, None] * SALTS).min(axis=0).view(np.int64)] if len(t) else [])
                if len(last) and len(t):
                    at = np.minimum(np.searchsorted(last, t), len(last) - 1)
                    place = np.where(last[at] == t, rank[at] + 1, 0)
                    t = t[np.argsort(place, kind="stable")]
                head.append(t[: prefix_length(len(t))].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(mark, pa.binary()), pa.array(low, pa.list_(pa.int64())), pa.array(head, pa.binary())], ["doc_id", "n", "mark", "low", "head"])

    return _batches(docs, run, "doc_id long, n long, mark binary, low array<bigint>, head binary")


def token_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, n, tokens binary) of the documents in ``ids`` (id), a saved table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = WordHashes(), set()
        for batch in batches:
            out = []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                t = tokens(v.as_py(), known)
                row = (i, len(t), t.tobytes())
                if (mark := hash(row)) not in seen:  # a row that a task repeats is needed once
                    seen.add(mark)
                    out.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))], ["id", "n", "tokens"])

    wanted = docs.join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")
    return _batches(wanted, run, "id long, n long, tokens binary")


def overlaps(pairs: DataFrame, sets: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``pairs`` (a, b, ...) with na, nb and the size of the intersection ``both``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {x: batch.schema.get_field_index(x) for x in ("ta", "tb")}
            both = []
            for x, y in zip(batch.column(at["ta"]), batch.column(at["tb"])):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                i = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both.append(int((y[i] == x).sum()) if len(x) else 0)
            kept = [i for i in range(batch.num_columns) if i not in at.values()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(both, pa.int64())], [*(batch.schema.names[i] for i in kept), "both"])

    # The sets of the b side travel once for each pair, to where the sets of the a side are.
    pairs = scratch.save(pairs, f"{name}_pairs")
    sets_a = sets.join(scratch.save(pairs.select(F.col("a").alias("id")).distinct(), f"{name}_a"), "id", "left_semi")
    left = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb")).join(pairs, "b")
    full = left.join(sets_a.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta")), "a")
    names = [c for c in full.columns if c not in ("ta", "tb")]
    fields = ", ".join(f"`{c}` {full.schema[c].dataType.simpleString()}" for c in names)
    return scratch.save(full.mapInArrow(run, fields + ", both long"), name)


LINKED = f"100 * both >= {PERCENT} * (na + nb - both)"


def groups(reps: DataFrame, docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) of hubs, and (id, hub, core) of every member.

    A member is ``core`` if it links with its hub.
    """
    buckets = reps.select("doc_id", "n", F.posexplode("low").alias("k", "v"))
    # A document whose minimum hashes are widespread lies in the middle of its like: it makes the best hub.
    counts = scratch.save(buckets.groupBy("k", "v").agg(F.count("*").alias("c")).where("c > 1"), "bucket_counts")
    shared = buckets.join(counts, ["k", "v"])
    fame = shared.groupBy("doc_id").agg(F.sum("c").alias("fame"))
    met = scratch.save(shared.join(fame, "doc_id").select("doc_id", "k", "v", "fame"), "met")
    ends = met.groupBy("k", "v").agg(F.max(F.struct("fame", (-F.col("doc_id")).alias("i"))).alias("top"), F.min("doc_id").alias("first"))
    # Written first: only a join of two plain shuffles can be split where one minimum hash has very many documents.
    ends = scratch.save(ends.select("k", "v", "first", (-F.col("top.i")).alias("last")), "ends")
    met = met.join(ends, ["k", "v"])
    hubs = met.select("doc_id", F.explode(F.array_distinct(F.array("first", "last"))).alias("a")).where("a <> doc_id").select("a", F.col("doc_id").alias("b")).distinct()
    size = reps.select("doc_id", "low")
    near = hubs.join(size.select(F.col("doc_id").alias("a"), F.col("low").alias("x")), "a").join(size.select(F.col("doc_id").alias("b"), F.col("low").alias("y")), "b")
    agree = F.aggregate(F.zip_with("x", "y", lambda x, y: (x == y).cast("int")), F.lit(0), lambda acc, v: acc + v)
    near = scratch.save(near.where(agree >= AGREE).select("a", "b").distinct(), "hub_pairs")
    ids = scratch.save(near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id"))).distinct(), "hub_ids")
    sets = scratch.save(token_sets(docs, ids), "hub_sets")
    met = overlaps(near, sets, scratch, "hub_overlaps")
    alike = F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))
    rank = F.struct(F.expr(LINKED).alias("core"), alike.alias("alike"), (-F.col("a")).alias("i"))
    chosen = met.where(alike >= LOOSE).groupBy("b").agg(F.max(rank).alias("h"))
    member = chosen.select(F.col("b").alias("id"), (-F.col("h.i")).alias("hub"), F.col("h.core").alias("core"))
    return met.where(LINKED).select("a", "b"), scratch.save(member, "members")


def matrix_pairs(entries: DataFrame, scratch: Scratch | None = None, tokens_in_all: int = 0) -> DataFrame:
    """Pairs of groups (g, h) of different components and near sizes, with how many tokens they share, from (grp, comp,
    lo, hi, head) rows; lo and hi are the sizes of the group's smallest and largest set.

    Tasks pack entries by token range, each (token, group) once; the next tasks, of at most some ``ENTRIES`` of them, sort
    theirs by token and pair the groups of a token. A token of more than ``PAIRED`` groups is not paired there: its groups
    are cut into blocks of ``BLOCKED``, and every pair of blocks is a row of its own, dealt to any task. Nothing but pairs of different
    components is ever emitted as a candidate.
    """
    scratch = scratch or Scratch(entries.sparkSession, "matrix")
    parts = max(shuffle_partitions(entries.sparkSession), -(-tokens_in_all // ENTRIES))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(2)]
            n = [len(x) for x in heads]
            if not sum(n):
                continue
            grp, row = np.unique(batch.column(0).to_numpy(), return_index=True)
            comp, lo, hi = (batch.column(k).to_numpy()[row] for k in (1, 3, 4))
            t, g = np.concatenate(heads), np.repeat(np.searchsorted(grp, batch.column(0).to_numpy()), n)
            by = np.lexsort((g, t))
            t, g = t[by], g[by]
            new = np.append(True, (t[1:] != t[:-1]) | (g[1:] != g[:-1]))
            t, g = t[new], g[new]
            part = (t >> np.uint64(40)).astype(np.int64) % parts
            by = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[by], np.arange(parts + 1))
            out = []
            for k in np.flatnonzero(np.diff(ends)):
                i = by[ends[k] : ends[k + 1]]
                used, index = np.unique(g[i], return_inverse=True)
                out.append((int(k), t[i].tobytes(), index.astype(np.uint16).tobytes(), *(x[used].tobytes() for x in (grp, comp, lo, hi))))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int32(), *[pa.binary()] * 6])], ["part", "t", "i", "g", "c", "lo", "hi"])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in range(5)]
        for batch in batches:
            for t, i, *groups_ in zip(*(batch.column(k) for k in range(1, 7))):
                i = np.frombuffer(i.as_buffer(), np.uint16)
                held[0].append(np.frombuffer(t.as_buffer(), np.uint64).copy())
                for x, v in zip(held[1:], groups_):
                    x.append(np.frombuffer(v.as_buffer(), np.int64)[i])
        if not held[0]:
            return
        t, g = np.concatenate(held[0]), np.concatenate(held[1])
        by = np.lexsort((g, t))
        by = by[np.append(True, (t[by][1:] != t[by][:-1]) | (g[by][1:] != g[by][:-1]))]
        t, g, c, lo, hi = (np.concatenate(x)[by] for x in held)
        begin = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
        end = np.append(begin[1:], len(t))
        two = begin[end - begin == 2]
        found = [_near(two, two + 1, g, c, lo, hi)]
        n = len(found[0][0])
        several = (end - begin > 2) & (end - begin <= PAIRED)
        for i, j in zip(begin[several].tolist(), end[several].tolist()):
            x, y = np.triu_indices(j - i, 1)
            found.append(_near(x + i, y + i, g, c, lo, hi))
            n += len(found[-1][0])
            if n > COUNTED_PAIRS:
                yield _paired(_counted(found))
                found, n = [], 0
        if n:
            yield _paired(_counted(found))
        frequent = end - begin > PAIRED
        for i, j in zip(begin[frequent].tolist(), end[frequent].tolist()):
            blocks = [b"".join(v[k : min(k + BLOCKED, j)].astype(kind).tobytes() for v, kind in zip((g, c, lo, hi), ENTRY)) for k in range(i, j, BLOCKED)]
            token = int(t[i].view(np.int64))
            for k in range(len(blocks)):  # one batch holds a block's pairs with up to 16 others
                for first in range(k, len(blocks), 16):
                    others = range(first, min(first + 16, len(blocks)))
                    yield _blocks([token] * len(others), [k] * len(others), list(others), [blocks[k]] * len(others), [blocks[m] if m > k else b"" for m in others])

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1)):
                one, other = _entries(x.as_buffer()), _entries(y.as_buffer())
                n, m = len(one[0]), len(other[0])
                both = [np.concatenate(v) for v in zip(one, other)]
                for first in range(0, n, PAIRED):  # some of the block's groups against those behind them, and the other block's
                    last = min(first + PAIRED, n)
                    if m:
                        i, j = (v.ravel() for v in np.meshgrid(np.arange(first, last), n + np.arange(m), indexing="ij"))
                    else:
                        i, j = (v.ravel() for v in np.meshgrid(np.arange(first, last), np.arange(first, n), indexing="ij"))
                        i, j = i[i < j], j[i < j]
                    found = _near(i, j, *both)
                    if len(found[0]):
                        yield _counted([found])

    packed = entries.select("grp", "comp", "head", "lo", "hi").mapInArrow(pack, "part int, t binary, i binary, g binary, c binary, lo binary, hi binary")
    paired = packed.repartitionById(parts, "part").mapInArrow(pair, "g long, h long, shared long, token long, i int, j int, x binary, y binary")
    paired = scratch.save(paired, "paired")
    # Rows of up to 100 kB: few of them to an Arrow batch.
    with settings(entries.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=16):
        rows = paired.where("x IS NOT NULL").repartition(parts, "token", "i", "j")
        crossed = scratch.save(rows.select("x", "y").mapInArrow(cross, "g long, h long, shared long"), "crossed")
    return paired.where("x IS NULL").select("g", "h", "shared").unionByName(crossed).groupBy("g", "h").agg(F.sum("shared").alias("shared"))


def _entries(block: pa.Buffer) -> list[np.ndarray]:
    """Groups, components and sizes of a block."""
    n, at, out = len(block) // sum(np.dtype(k).itemsize for k in ENTRY), 0, []
    for kind in ENTRY:
        out.append(np.frombuffer(block, kind, n, at).astype(np.int64))
        at += n * np.dtype(kind).itemsize
    return out


def _paired(batch: pa.RecordBatch) -> pa.RecordBatch:
    n = batch.num_rows
    rest = [pa.nulls(n, k) for k in (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())]
    return pa.RecordBatch.from_arrays([*batch.columns, *rest], ["g", "h", "shared", "token", "i", "j", "x", "y"])


def _blocks(token: list[int], i: list[int], j: list[int], x: list[bytes], y: list[bytes]) -> pa.RecordBatch:
    n = len(token)
    return pa.RecordBatch.from_arrays([*[pa.nulls(n, pa.int64())] * 3, pa.array(token, pa.int64()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(x, pa.binary()), pa.array(y, pa.binary())], ["g", "h", "shared", "token", "i", "j", "x", "y"])


def _near(x: np.ndarray, y: np.ndarray, g: np.ndarray, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of entries (x, y) the groups that are of different components and of sizes that a link may have."""
    ok = (c[x] != c[y]) & (100 * hi[y] >= PERCENT * lo[x]) & (100 * hi[x] >= PERCENT * lo[y])
    return g[x[ok]], g[y[ok]]


def _counted(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Each pair once, with how often it was found."""
    g, h = (np.concatenate(x) for x in zip(*found))
    by = np.lexsort((h, g))
    g, h = g[by], h[by]
    opens = np.flatnonzero(np.append(len(g) > 0, (g[1:] != g[:-1]) | (h[1:] != h[:-1])))
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (g[opens], h[opens], np.diff(np.append(opens, len(g))))], ["g", "h", "shared"])


def join(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=BATCH):
        described = scratch.save(describe(docs, common_tokens(docs, scratch)), "described")
        sizes = scratch.save(described.select("doc_id", "n", "mark"), "sizes")
        filled = sizes.where("n > 0 AND doc_id IS NOT NULL")
        same = scratch.save(filled.groupBy("mark").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("top")), "same")
        heads = described.where("n > 0").join(same.select("doc_id", "mark"), ["doc_id", "mark"], "left_semi")
        heads = scratch.save(heads.select("doc_id", "mark", "n", "low", "head"), "heads")
        scratch.drop("described")
        reps = scratch.save(heads.select("doc_id", "mark", "n", "low").distinct(), "reps")
        links, member = groups(reps, docs, scratch)
        comp = scratch.save(components(links, scratch, "first"), "comp0")
        # Documents without a hub are groups of their own, and so are hubs that joined no other.
        label = comp.select(F.col("id").alias("grp"), F.col("component").alias("comp"))

        def place(rows: DataFrame) -> DataFrame:
            out = rows.join(member.withColumnRenamed("id", "doc_id"), "doc_id", "left")
            out = out.withColumns({"grp": F.coalesce("hub", "doc_id"), "core": F.coalesce("core", F.lit(True))})
            return out.join(label, "grp", "left").withColumn("comp", F.coalesce("comp", "grp"))

        mixed = scratch.save(member.where("NOT core").select(F.col("hub").alias("grp"), F.lit(True).alias("mixed")).distinct(), "mixed")
        # Pairs within one component need no look, unless a group also has members that its hub does not link.
        placed = scratch.save(place(reps.select("doc_id", "n")).select("doc_id", "n", "grp", "core", "comp"), "placed")
        sizes_of = scratch.save(placed.groupBy("grp").agg(F.min("n").alias("lo"), F.max("n").alias("hi")).where("lo < hi"), "spans")
        entries = place(heads.select("doc_id", "n", "head")).join(sizes_of, "grp", "left").withColumns({"lo": F.coalesce("lo", "n"), "hi": F.coalesce("hi", "n")})
        entries = entries.join(mixed, "grp", "left").withColumn("comp", F.when(F.col("mixed"), -1 - F.col("grp")).otherwise(F.col("comp")))
        n = heads.agg(F.coalesce(F.sum(F.octet_length("head")), F.lit(0))).first()[0] // 8
        pairs = scratch.save(matrix_pairs(entries, scratch, n), "matrix")
        scratch.drop("heads", "paired", "crossed")
        own = mixed.select(F.col("grp").alias("g"), F.col("grp").alias("h"), F.lit(None).cast("long").alias("shared"))
        more = _opened(pairs.unionByName(own), placed, docs, scratch)
    edges = links.unionByName(more)
    # Equal sets: every document hangs on the smallest of its set; repeated ids join what their rows join.
    copies = filled.join(same.where("top > doc_id").select("mark", F.col("doc_id").alias("b")), "mark").select(F.col("doc_id").alias("a"), "b").where("a <> b")
    final = scratch.save(components(edges.unionByName(copies), scratch, "last"), "comp1")
    out = sizes.select("doc_id", F.col("n").alias("n_shingles"))
    return out.join(final.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _spread(rows: DataFrame, sets: DataFrame, columns: str) -> DataFrame:
    """``rows`` with a row for each token of the document ``id``: (columns, token)."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens_ = [np.frombuffer(v.as_buffer(), np.int64) for v in batch.column(len(names))]
            if tokens_:
                n = [len(t) for t in tokens_]
                kept = [pa.array(np.repeat(np.asarray(batch.column(i)), n)) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate(tokens_))], [*names, "token"])

    return rows.join(sets, "id").select(*names, "tokens").mapInArrow(run, columns + ", token long")


def _opened(pairs: DataFrame, grouped: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) that join the components of pairs of groups, and those of a group's loose members.

    The documents that ask a group are first met with its token union. Qualifying ones are opened in blocks of a bounded
    number of tokens: a block holds some of the group's members and some of the queries, and gives out only links that
    join what it has not joined yet.
    """
    touched = scratch.save(pairs.select(F.col("g").alias("grp")).unionByName(pairs.select(F.col("h").alias("grp"))).distinct(), "touched")
    grouped = scratch.save(grouped.join(touched, "grp", "left_semi"), "grouped")
    solo = (F.count("*") == 1) & (F.min("doc_id") == F.col("grp"))
    info = scratch.save(grouped.groupBy("grp", "comp").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.count("*").alias("c"), F.sum("n").alias("t"), F.count_if(~F.col("core")).alias("l"), solo.alias("solo")), "info")
    one, two = (info.select(*[F.col(c).alias(p if c == "grp" else c + p) for c in info.columns]) for p in "gh")
    sized = pairs.join(one, "g").join(two, "h").where(f"100 * hig >= {PERCENT} * loh AND 100 * hih >= {PERCENT} * log")
    # Common tokens lie in both prefixes, or behind the one that ends first, among three quarters of its set. What is
    # shared and these must make up a link of sizes that the groups have.
    most, least = F.greatest("hig", "hih"), F.least("log", "loh")
    can = (100 * least <= PERCENT * most) | (4 * 175 * F.col("shared") + 225 * most >= 300 * least)
    sized = sized.where(F.col("shared").isNull() | can)
    sized = scratch.save(sized.select("g", "h", "cg", "ch", "lg", "lh", (F.col("compg") == F.col("comph")).alias("same"), (F.col("solog") & F.col("soloh") & (F.col("g") != F.col("h"))).alias("single")), "sized")
    singles, several = sized.where("single").select(F.col("g").alias("a"), F.col("h").alias("b")), sized.where("NOT single")
    # Who asks whom: of two components the smaller group; within one component only the loose members.
    small_first = F.col("cg") <= F.col("ch")
    asks = several.where("NOT same").select(F.when(small_first, F.col("g")).otherwise(F.col("h")).alias("q"), F.when(small_first, F.col("h")).otherwise(F.col("g")).alias("t"), F.lit(False).alias("loose"))
    for p, q in ("gh", "hg"):
        asks = asks.unionByName(several.where(f"same AND l{p} > 0").select(F.col(p).alias("q"), F.col(q).alias("t"), F.lit(True).alias("loose")))
    asks = scratch.save(asks.distinct(), "asks")
    members = grouped.select("grp", "doc_id", "n", "core")
    queries = asks.join(members.withColumnRenamed("grp", "q"), "q").where("NOT loose OR NOT core").select("t", F.col("doc_id").alias("id"), "n", (F.col("q") == F.col("t")).cast("int").alias("own")).distinct()
    queries = scratch.save(queries, "queries")
    asked = scratch.save(queries.select("t").distinct(), "asked")
    targets = scratch.save(members.select(F.col("grp").alias("t"), F.col("doc_id").alias("id"), "core").join(asked, "t", "left_semi"), "targets")
    ids = singles.select(F.col("a").alias("id")).unionByName(singles.select(F.col("b").alias("id"))).unionByName(queries.select("id")).unionByName(targets.select("id"))
    sets = scratch.save(token_sets(docs, scratch.save(ids.distinct(), "open_ids")), "open_sets")
    links = overlaps(singles, sets, scratch, "singles").where(LINKED).select("a", "b")
    sets = sets.drop("n")
    again = scratch.spark.read.parquet(scratch.path("open_sets")).drop("n")  # else both sides would name the same columns
    # The matrix: each group's token union, and how many members have a token. What a query has in common with all of a
    # group bounds what it has with any member; in its own group its own tokens do not count.
    union = scratch.save(_spread(targets.select("t", "id"), sets, "t long").groupBy("t", "token").agg(F.count("*").alias("c")), "unions")
    common = _spread(queries.select("t", "id", "own"), sets, "t long, id long, own int").join(union, ["t", "token"]).where("c > own").groupBy("t", "id").agg(F.count("*").alias("both"))
    bound = common.join(info.select(F.col("grp").alias("t"), "lo"), "t").join(queries.groupBy("t", "id").agg(F.min("n").alias("n")), ["t", "id"])
    queries = scratch.save(queries.join(scratch.save(bound.where(f"{100 + PERCENT} * both >= {PERCENT} * (n + lo)").select("t", "id"), "bounds"), ["t", "id"], "left_semi"), "opening")
    cuts = queries.groupBy("t").agg(F.ceil(F.sum("n") / BLOCK).alias("kq")).join(info.select(F.col("grp").alias("t"), F.ceil(F.col("t") / BLOCK).alias("kt")), "t")
    cuts = scratch.save(cuts, "cuts")
    part = lambda k: F.pmod(F.xxhash64("id"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1).cast("array<int>"))
    left = queries.join(cuts, "t").select("t", part("kq").alias("i"), every("kt").alias("j"), "id").join(sets, "id")
    right = targets.join(cuts, "t").select("t", every("kq").alias("i"), part("kt").alias("j"), "id", "core").join(again, "id")
    blocks = left.groupBy("t", "i", "j").cogroup(right.groupBy("t", "i", "j")).applyInArrow(_block, "a long, b long")
    return links.unionByName(scratch.save(blocks, "opened"))


def _block(queries: pa.Table, members: pa.Table) -> pa.Table:
    """Links of queries with members, as many as join all that is linked (core members are joined already)."""
    q, m = queries.column("id").to_pylist(), members.column("id").to_pylist()
    found: list[tuple[int, int]] = []
    if q and m:
        root = {x: x for x in (*q, *m)}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        core = [x for x, c in zip(m, members.column("core").to_pylist()) if c]
        for x in core:
            root[find(x)] = find(core[0])
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in members.column("tokens")]
        n = np.array([len(x) for x in sets])
        every, owner = np.concatenate(sets), np.repeat(np.arange(len(m)), n)
        by = np.argsort(every, kind="stable")
        every, owner = every[by], owner[by]
        for x, value in zip(q, queries.column("tokens")):
            t = np.frombuffer(value.as_buffer(), np.uint64)
            lo, hi = np.searchsorted(every, t, "left"), np.searchsorted(every, t, "right")
            k = hi - lo
            at = np.repeat(lo - np.append(0, np.cumsum(k)[:-1]), k) + np.arange(k.sum())
            both = np.bincount(owner[at], minlength=len(m))
            for j in np.flatnonzero(100 * both >= PERCENT * (len(t) + n - both)):
                u, v = find(x), find(m[j])
                if u != v:
                    root[u] = v
                    found.append((x, m[j]))
    a, b = zip(*found) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


ORACLE = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, hash(g) AS g FROM (SELECT doc_id, list_aggregate(w[i:i + {WIDTH - 1}], 'string_agg', ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {WIDTH - 2}, 2))) AS i FROM w WHERE len(w) > 0))),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT l.a, r.c FROM r JOIN l ON l.b = r.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(c) AS component_id FROM r GROUP BY a) c USING (doc_id)"""
