"""Embedding near-duplicates by spherical-cap filters.

Filter directions are product codes: after a fixed random rotation a direction is one of B random unit vectors in
one half of the dimensions and one of B in the other, B * B directions in all, and this for several independent
splits into halves. A vector is list-decoded to every direction whose inner product with it exceeds the cap's bound;
vectors of one label that share a direction are verified by their cosine in double precision. The bound is set so
that a cap holds about ``BUCKET`` unrelated vectors of the largest label, and B so that two vectors just at the
threshold are expected to share ``SHARED`` directions over all splits, both from the exact law of inner products in
the table's number of dimensions; so recall does not fall as labels grow, while the caps that a vector is in grow
slowly (of 64 dimensions, from some 45 to 90 at 30 million vectors in a label).

Equal vectors collapse first and count by their number. Caps are cut into blocks of at most ``BLOCK`` vectors, and
every two blocks of a cap meet in a group of their own; a task takes many groups at a time. A group gives out, for each vector, how many others it
links with here for the first time (a link counts in the smallest direction both exceed) and those links that join
what it has not joined yet, never all pairs.

Vectors that are null, empty, zero, or hold null or non-finite components, and rows without a label, link with
nothing, and so do vectors of different lengths. Rows with a null id keep a null component. Repeated rows are
copies that link with each other; rows with equal ids share a component and, each, their own count. Empty tables
give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.llm.common import Scratch, settings, table
from reportlake.llm.graph import components

THRESHOLD = 0.93
BUCKET = 48
SHARED = 28.0
LEAST_CAPS = 16
BLOCK = 384
#: Inner products of a step of the decoding.
DECODED = 1 << 20
SEED = 11


@functools.lru_cache(64)
def _angles(d: int) -> tuple[np.ndarray, np.ndarray]:
    """Angles to a fixed direction, and the share of the unit sphere of ``d`` dimensions within each of them."""
    angle = np.linspace(0, math.pi, 100_001)
    share = np.append(0.0, np.cumsum(np.sin((angle[1:] + angle[:-1]) / 2) ** (d - 2)))
    return angle, share / share[-1]


def both_exceed(cosine: float, d: int, rho: float) -> tuple[float, float]:
    """Shares of directions in ``d`` dimensions whose inner product exceeds ``cosine`` with a unit vector, and with both of two of cosine rho."""
    angle, share = _angles(d)
    edge = np.linspace(0, math.acos(cosine), 4001)
    mid = (edge[1:] + edge[:-1]) / 2
    # The second inner product is rho * the first + a rest along a direction of d - 1 dimensions.
    least = (cosine - rho * np.cos(mid)) / (math.sqrt(1 - rho * rho) * np.sin(mid))
    tail = np.where(least > 1, 0.0, np.where(least <= -1, 1.0, 0.5)) if d == 2 else np.interp(np.arccos(np.clip(least, -1, 1)), *_angles(d - 1))
    within = np.interp(edge, angle, share)
    return float(within[-1]), float((np.diff(within) * tail).sum())


def rotations(d: int) -> int:
    """Splits into halves: a pair that one split treats badly meets in others. Few dimensions have few directions a split."""
    return 128 if d < 4 else 64 if d < 12 else 16


@functools.lru_cache(256)
def plan(n: int, threshold: float = THRESHOLD, d: int = 64) -> tuple[float, int]:
    """Bound in standard deviations of an inner product, and B, for labels of up to ``n`` vectors of ``d`` dimensions.

    The inner product of a random unit vector with a direction of the product code has the exact law of the sphere of
    all ``d`` dimensions. Caps of about ``BUCKET`` vectors are the aim; larger ones are taken where so small caps
    would be shared so seldom that their number costs more.
    """
    d, rho = max(d, 2), min(threshold, 1 - 1e-6)
    share, best = min(0.02, BUCKET / max(n, 1)), None
    while share < 0.5:
        cosine = math.cos(np.interp(share, *_angles(d)[::-1]))
        both = both_exceed(cosine, d, rho)[1]
        cost = (1 + share * n / BUCKET) * share / both if both > 0 else math.inf
        if cost < (best[0] if best else math.inf):
            b = max(2, math.ceil(math.sqrt(SHARED / rotations(d) / both)))
            best = cost, cosine * math.sqrt(d), b
        share *= 2
    return best[1:]


def codes(d: int, b: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each split a rotation, the order of its coordinates and the two halves' codes, the same wherever they are made."""
    rng = np.random.default_rng([SEED, d, b])
    out = []
    for m in range(rotations(d)):
        # Of many dimensions one rotation is enough: its coordinates fall into other halves each time.
        rotation = np.linalg.qr(rng.standard_normal((d, d)))[0] if m == 0 or d <= 256 else out[0][0]
        halves = []
        for k in (d // 2, d - d // 2):
            c = rng.standard_normal((b, max(k, 1)))
            halves.append((c / np.linalg.norm(c, axis=1, keepdims=True))[:, :k])
        out.append((rotation, rng.permutation(d), *halves))
    return out


def _best(x: np.ndarray, y: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and numbers of the best pairs, which are among the best few of either half."""
    i, j = (np.argsort(-v, kind="stable")[:least] for v in (x, y))
    s = (x[i][:, None] + y[j][None, :]).ravel()
    k = np.argsort(-s, kind="stable")[:least]
    return s[k], i[k // len(j)] * len(x) + j[k % len(j)]


def list_decode(unit: np.ndarray, t: float, code: list, least: int = LEAST_CAPS) -> list[np.ndarray]:
    """Numbers (m * B + i) * B + j of all directions that each vector exceeds; the ``least`` best if there are fewer."""
    d, b = unit.shape[1], len(code[0][2])
    bound = t / math.sqrt(d) * math.sqrt(2)
    out = []
    step = max(1, DECODED // b)
    for begin in range(0, len(unit), step):
        part, at, number = unit[begin : begin + step], [np.empty(0, int)], [np.empty(0, int)]
        last = turned = None
        for m, (rotation, order, one, two) in enumerate(code):
            turned, last = (turned if rotation is last else part @ rotation), rotation
            x, y = turned[:, order[: d // 2]] @ one.T, turned[:, order[d // 2 :]] @ two.T
            row, i = np.nonzero(x >= bound - y.max(axis=1, keepdims=True))
            for k in range(0, len(row), step):
                r, c = row[k : k + step], i[k : k + step]
                near, j = np.nonzero(y[r] >= bound - x[r, c][:, None])
                at.append(r[near])
                number.append((m * b + c[near]) * b + j)
        at, number = np.concatenate(at), np.concatenate(number)
        number = number[np.argsort(at, kind="stable")]
        found = np.split(number, np.cumsum(np.bincount(at, minlength=len(part)))[:-1])
        few = [r for r, v in enumerate(found) if len(v) < least]
        tops: dict[int, list] = {r: [] for r in few}
        for m, (rotation, order, one, two) in enumerate(code if few else []):
            turned = part[few] @ rotation
            x, y = turned[:, order[: d // 2]] @ one.T, turned[:, order[d // 2 :]] @ two.T
            for r, v, w in zip(few, x, y):
                s, k = _best(v, w, least)
                tops[r].append((s, m * b * b + k))
        for r, top in tops.items():
            s, k = map(np.concatenate, zip(*top))
            found[r] = np.union1d(found[r], k[np.argsort(-s, kind="stable")[:least]])
        out += found
    return out


def _units(values: pa.Array) -> np.ndarray:
    v = np.asarray(values.flatten(), np.float64).reshape(len(values), -1) if len(values) else np.empty((0, 1))
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _caps(reps: DataFrame, n: int, threshold: float) -> DataFrame:
    def run(batches):
        known: dict[int, tuple] = {}  # bound and code by dimensions
        for batch in batches:
            dims = np.asarray(batch.column("d"))
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                if d not in known:
                    t, b = plan(n, threshold, int(d))
                    known[d] = t, codes(int(d), b)
                caps = list_decode(_units(part.column("v")), *known[d])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("rep", "label", "d")), pa.array(caps, pa.list_(pa.int64()))], ["rep", "label", "d", "caps"])

    return reps.select("rep", "label", "d", "v").mapInArrow(run, "rep long, label long, d int, caps array<bigint>")


def _verify(threshold: float):
    """Links within caps: rows sorted by cap and blocks, whole groups of them at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            new = _opens(rows)
            if len(new) > 1:
                yield _links(rows.slice(0, new[-1]), new[:-1], threshold)
                held = rows.slice(new[-1]).to_batches()
        if held:
            rows = pa.Table.from_batches(held)
            yield _links(rows, _opens(rows), threshold)

    return run


GROUP = ("label", "d", "cap", "i", "j")


def _opens(rows: pa.Table) -> np.ndarray:
    """Where a group begins."""
    keys = [np.asarray(rows.column(c)) for c in GROUP]
    return np.flatnonzero(np.append(rows.num_rows > 0, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])))


def _links(rows: pa.Table, opens: np.ndarray, threshold: float) -> pa.RecordBatch:
    """(kind 0: rep, number of others linked here for the first time; kind 1: ids that links of a group join)."""
    rows = rows.combine_chunks()
    d, cap, i, j, block, rep, ids, weight = (np.asarray(rows.column(c)) for c in ("d", "cap", "i", "j", "block", "rep", "id", "weight"))
    lists = rows.column("caps").chunk(0) if rows.num_rows else pa.array([], pa.list_(pa.int64()))
    caps, at = np.asarray(lists.flatten()), np.append(0, np.cumsum(np.asarray(lists.value_lengths(), np.int64)))
    count = np.zeros(len(ids), np.int64)
    joined: list[np.ndarray] = [np.empty((2, 0), np.int64)]
    units, last = None, (0, 0)
    for s, e in zip(opens.tolist(), np.append(opens[1:], len(ids)).tolist()):
        if e - s < 2:
            continue
        if not last[0] <= s < last[1]:  # vectors of equal dimensions, as far as they go
            end = s + int(np.argmax(np.append(d[s:] != d[s], True)))
            units, last = _units(rows.column("v").chunk(0).slice(s, end - s)), (s, end)
        unit = units[s - last[0] : e - last[0]]
        if i[s] == j[s]:
            x = y = np.arange(s, e)
            near = unit @ unit.T >= threshold
            np.fill_diagonal(near, False)
        else:
            first = block[s:e] == i[s]
            x, y = s + np.flatnonzero(first), s + np.flatnonzero(~first)
            near = unit[first] @ unit[~first].T >= threshold
        p, q = np.nonzero(near)
        if not len(p):
            continue
        p, q = x[p], y[q]
        used, back = np.unique(np.concatenate([p, q]), return_inverse=True)
        u, v = back[: len(p)], back[len(p) :]
        fresh = ~_share(used, caps, at)[u, v]  # the others are counted in a smaller direction
        p, q, u, v = p[fresh], q[fresh], u[fresh], v[fresh]
        count += _sums(p, weight[q], len(ids))
        if i[s] != j[s]:
            count += _sums(q, weight[p], len(ids))
        low = _lowest(u, v, len(used))
        some = low != np.arange(len(used))
        joined.append(np.stack([ids[used[some]], ids[used[low[some]]]]))
    some = np.flatnonzero(count)
    a, b = np.concatenate(joined, axis=1)
    kind = np.repeat(np.array([0, 1], np.int32), [len(some), len(a)])
    return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.concatenate([rep[some], a])), pa.array(np.concatenate([count[some], b]))], ["kind", "a", "b"])


def _sums(at: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, value, n).astype(np.int64)


def _share(rows: np.ndarray, caps: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the rows exceed a common direction among those that they carry."""
    lists = [caps[at[r] : at[r + 1]] for r in rows]
    seen, back = np.unique(np.concatenate(lists), return_inverse=True)
    have = np.zeros((len(rows), len(seen)), np.float32)
    have[np.repeat(np.arange(len(rows)), [len(c) for c in lists]), back] = 1
    return have @ have.T > 0


def _lowest(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The smallest number that each of n can reach by the links (u, v)."""
    low = np.arange(n)
    while True:
        before = low.copy()
        np.minimum.at(low, u, before[v])
        np.minimum.at(low, v, before[u])
        low = low[low]
        if (low == before).all():
            return low


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "caps")
    # Single precision travels as such; cosines are computed in double from the same values.
    single = vectors.schema[vector].dataType.simpleString() == "array<float>"
    v = F.col(vector) if single else F.col(vector).cast("array<double>")
    x_type = "float" if single else "double"
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    usable = F.coalesce(good, F.lit(False)) & F.col(label).isNotNull() & F.col(key).isNotNull()
    # -0.0 + 0.0 is 0.0, so that equal vectors have equal marks; of 128 bits, and the dimensions count.
    plain = F.transform(v, lambda x: x + F.lit(0.0).cast(x_type))
    mark = F.concat_ws("/", *[F.xxhash64(F.lit(k), F.col(label), F.size(v), plain).cast("string") for k in (1, 2)])
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), v.alias("v"), F.when(usable, mark).alias("mark"))
    rows = scratch.save(rows, "rows")
    same = rows.where("mark IS NOT NULL").groupBy("mark").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"), F.first("label").alias("label"), F.first("v").alias("v"))
    # A rep's id may stand for several marks if ids repeat, so reps have numbers of their own.
    reps = scratch.save(same.select("mark", F.monotonically_increasing_id().alias("rep"), "id", "label", F.size("v").alias("d"), "weight", "v"), "reps")
    largest = reps.groupBy("label", "d").count().agg(F.max("count")).first()[0] or 0
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=2000):
        caps = scratch.save(_caps(reps, largest, threshold), "caps")
        entries = caps.select("rep", "label", "d", F.explode("caps").alias("cap"))
        sizes = scratch.save(entries.groupBy("label", "d", "cap").agg(F.count("*").alias("n")).where("n > 1").withColumn("k", F.ceil(F.col("n") / BLOCK).cast("int")), "sizes")
        # Numbers alone are joined on caps; the vectors come in once, when it is known which of their caps hold others.
        met = scratch.save(entries.join(sizes, ["label", "d", "cap"]).groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("cap", "k"))).alias("met")), "met")
        # With each of its caps a vector carries the smaller ones, in which its links may have been counted.
        held = reps.drop("mark").join(met, "rep").select("*", F.posexplode("met").alias("nth", "one"))
        held = held.select("rep", "id", "label", "d", "weight", "v", "one.cap", "one.k", F.slice(F.col("met.cap"), 1, F.col("nth")).alias("caps"))
        held = held.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("k")).cast("int"))
        # Block x meets every block y: in the group of both, the smaller number first.
        held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        held = held.select("label", "d", "cap", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "id", "weight", "v", "caps")
        dealt = held.repartition(*GROUP).sortWithinPartitions(*GROUP)
        found = scratch.save(dealt.mapInArrow(_verify(threshold), "kind int, a long, b long"), "found")
        scratch.drop("caps", "sizes", "met")
    counts = found.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("links"))
    comps = components(found.where("kind = 1").select("a", "b"), scratch)
    # The narrow result of every copy class, met by the class's mark; hot classes are split by adaptive execution.
    info = reps.select("mark", "rep", "id", "weight").join(counts, "rep", "left").join(comps, "id", "left")
    info = scratch.save(info.select("mark", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("component", "id").alias("c")), "info")
    out = rows.select("vec_id", "mark").join(info, "mark", "left")
    component = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def op2_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = f"""WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS n FROM e WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0
  AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= {THRESHOLD}),
r AS (SELECT vec_id AS a, vec_id AS c FROM e UNION SELECT l.a, r.c FROM r JOIN l ON l.b = r.a),
c AS (SELECT a, min(c) AS component_id FROM r GROUP BY a),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept FROM e LEFT JOIN k ON k.a = vec_id JOIN c ON c.a = vec_id"""
