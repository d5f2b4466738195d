import re

import pytest
from corpus import DOC, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from reportlake.llm import graph, jaccard
from reportlake.llm.common import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    sets = {}
    for i, t, *_ in rows:
        w = WORD.findall((t or "").translate(FOLD))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_against_brute_force(spark):
    rows = documents()
    got = jaccard.join(spark.createDataFrame(rows, DOC).selectExpr("*", "1 AS n", "2 AS component"))
    want = brute(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == want
    assert any(i != c for i, (_, c) in want.items())


def test_a_cluster_at_the_threshold(spark, monkeypatch):
    """Near copies most of which do not link with the centre: groups with loose members are opened in blocks."""
    import random

    rng = random.Random(5)
    words = [f"w{i}" for i in range(160)]
    rows = []
    for k in range(70):
        w = list(words)
        for _ in range(rng.randint(2, 7)):
            w[rng.randrange(len(w))] = f"r{rng.randrange(10**6)}"
        rows.append((k, " ".join(w), "en", "s", 0))
    monkeypatch.setattr(jaccard, "BLOCK", 900)
    saved, save = {}, Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name: saved.setdefault(name, save(self, df, name)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(spark.createDataFrame(rows, DOC)).collect()}
    assert got == brute(rows)
    assert len({c for _, c in got.values()}) > 1
    # The unions hold each token of a group once, with its members; bounds let documents through that opening must judge.
    union = saved["unions"].collect()
    assert len({(r["t"], r["token"]) for r in union}) == len(union) and max(r["c"] for r in union) > 5
    assert 0 < saved["bounds"].count() <= saved["queries"].count() and saved["cuts"].where("kt > 1").count() > 0
    assert saved["opened"].count() > 0


def test_unions_keep_groups_shut(spark, monkeypatch):
    """Two clusters that share a third of their tokens: candidates by prefix, but no document reaches the other union."""
    import random

    rng = random.Random(6)
    shared = [f"s{i}" for i in range(40)]
    rows = []
    for k in range(30):
        w = [f"{'ab'[k % 2]}{i}" for i in range(60)] + shared
        w[rng.randrange(60)] = f"r{k}"
        rows.append((k, " ".join(w), "en", "s", 0))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(spark.createDataFrame(rows, DOC)).collect()}
    assert got == brute(rows) and {c for _, c in got.values()} == {0, 1}


def test_many_groups_of_a_token_are_paired_in_blocks(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    n = 60
    g, c, lo = np.arange(n), rng.integers(0, 9, n), rng.integers(5, 12, n)
    x, y = np.triu_indices(n, 1)
    found = list(zip(*(v.tolist() for v in jaccard._near(x, y, g, c, lo, lo))))
    want = [(a, b) for a in range(n) for b in range(a + 1, n) if c[a] != c[b] and 100 * lo[b] >= 75 * lo[a] and 100 * lo[a] >= 75 * lo[b]]
    assert sorted(found) == want
    heads = [rng.integers(0, 12, 6).astype(np.uint64) for _ in range(n)]
    entries = spark.createDataFrame([(int(a), int(b), int(v), int(v), bytearray(np.sort(h).tobytes())) for a, b, v, h in zip(g, c, lo, heads)], "grp long, comp long, lo long, hi long, head binary")
    got = {(r["g"], r["h"]): r["shared"] for r in jaccard.matrix_pairs(entries).collect()}
    both = {(a, b): len(set(heads[a].tolist()) & set(heads[b].tolist())) for a, b in want}
    assert got == {k: v for k, v in both.items() if v}
    assert jaccard._counted([(np.array([2, 1, 2]), np.array([3, 5, 3]))]).to_pydict() == {"g": [1, 2], "h": [5, 3], "shared": [1, 2]}
    assert pa.types.is_int64(jaccard._counted([(g[:0], g[:0])]).schema.field("g").type)


def test_repeated_and_null_ids_and_empty(spark):
    rows = documents()[:5]
    df = spark.createDataFrame([*rows, *rows, (None, rows[0][1], "en", "s", 0)], DOC)
    got = jaccard.join(df).collect()
    assert len(got) == 11 and {r["component_id"] for r in got if r["doc_id"] in (0, 1)} == {0}
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]
    assert jaccard.join(df.where("false")).collect() == []


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, edges):
    got = dict(tuple(r) for r in graph.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect())
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


@pytest.mark.parametrize("n", [1, 2, 4, 5, 100, 101])
def test_prefix_holds_a_common_token(n):
    """Two sets of similarity 3/4 share at least ceil(3/4 n) tokens, so one is among the first n - that + 1."""
    assert jaccard.prefix_length(n) == n - -(-3 * n // 4) + 1


def test_one_token_in_very_many_groups_is_many_rows(spark):
    """Pairs of a frequent token's blocks are rows, and each pair of groups is found once."""
    import numpy as np
    from pyspark.sql import functions as F

    n, token = 4500, np.uint64(7).tobytes()
    # Sizes that no link bridges, but within each hundred groups.
    size = (F.pow(F.lit(1.4), F.floor(F.col("id") / 100)) * 10).cast("long")
    entries = spark.range(n).select(F.col("id").alias("grp"), F.col("id").alias("comp"), F.lit(token).alias("head"), size.alias("lo"), size.alias("hi")).repartition(8)
    scratch = Scratch(spark, "matrix")
    got = jaccard.matrix_pairs(entries, scratch)
    paired = spark.read.parquet(scratch.path("paired"))
    blocks = -(-n // jaccard.BLOCKED)
    assert blocks == 2 and paired.where("x IS NOT NULL").count() == blocks * (blocks + 1) // 2 and paired.where("x IS NULL").isEmpty()
    want = {(a, b) for a in range(n) for b in range(a + 1, min(n, (a // 100 + 1) * 100))}
    assert {(r["g"], r["h"]) for r in got.where("shared = 1").collect()} == want and got.count() == len(want)


def test_blocks_of_a_frequent_token_are_spread(spark):
    import numpy as np
    from pyspark.sql import functions as F

    n, token = 20_000, np.uint64(7).tobytes()
    rows = spark.range(n).select(F.col("id").alias("grp"), F.lit(0).cast("long").alias("comp"), F.lit(token).alias("head"), F.lit(10).cast("long").alias("lo"), F.lit(10).cast("long").alias("hi"))
    scratch = Scratch(spark, "matrix")
    assert jaccard.matrix_pairs(rows, scratch).isEmpty()  # all of one component: compared, and none a candidate
    blocks = spark.read.parquet(scratch.path("paired")).where("x IS NOT NULL").repartition(16, "token", "i", "j")
    dealt = [r["count"] for r in blocks.groupBy(F.spark_partition_id()).count().collect()]
    k = -(-n // jaccard.BLOCKED)
    assert sum(dealt) == k * (k + 1) // 2 == 15 and len(dealt) > 5 and max(dealt) <= 4
