import numpy as np
import pyarrow as pa
import pytest
from oracle import DATA, assert_same

from reportlake.llm import capjoin

VEC = "vec_id long, embedding array<float>, label int"


def fixture():
    rng = np.random.default_rng(2)
    rows, k = [], 0
    for label in (0, 1):
        for _ in range(12):
            centre = rng.standard_normal(24)
            for _ in range(4):
                v = centre + rng.standard_normal(24) * rng.choice([0.05, 0.2, 0.33, 0.45])
                rows.append((k, [float(np.float32(x)) for x in v], label))
                k += 1
    rows += [(k, rows[0][1], 0), (k + 1, [2 * x for x in rows[0][1]], 0), (k + 2, rows[0][1], 1), (k + 3, rows[0][1], None)]
    rows += [(k + 4, None, 0), (k + 5, [], 0), (k + 6, [0.0] * 24, 0), (k + 7, [None] * 24, 0), (k + 8, [float("nan")] * 24, 0), (k + 9, [float("inf")] + [0.0] * 23, 0), (k + 10, [1.0, 1.0], 0), (k + 11, [1.0, 1.001], 0)]
    return rows


def brute(rows, threshold=0.93):
    good = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            u = np.array(v, float)
            good[i] = (label, u / np.linalg.norm(u))
    links = {(a, b) for a, (la, u) in good.items() for b, (lb, v) in good.items() if a != b and la == lb and len(u) == len(v) and u @ v >= threshold}
    root = {r[0]: r[0] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {r[0]: (sum(a == r[0] for a, _ in links), find(r[0]), find(r[0]) == r[0]) for r in rows}


def test_against_brute_force(spark):
    rows = fixture()
    df = spark.createDataFrame(rows, VEC).selectExpr("*", "1 AS id", "2 AS caps")
    want = brute(rows)
    assert {r[0]: tuple(r[1:]) for r in capjoin.near_duplicates(df).collect()} == want
    assert sum(v[0] > 0 for v in want.values()) > 20


def test_blocks_of_a_hot_cap(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(16)
    rows = [(i, [float(np.float32(x)) for x in centre + 0.08 * rng.standard_normal(16)], 0) for i in range(90)]
    block, capjoin.BLOCK = capjoin.BLOCK, 20
    try:
        assert {r[0]: tuple(r[1:]) for r in capjoin.near_duplicates(spark.createDataFrame(rows, VEC)).collect()} == brute(rows)
    finally:
        capjoin.BLOCK = block


def test_empty_and_null_id(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0], 0), (1, [1.0, 2.0], 0)], VEC)
    got = {r[0]: r[1:] for r in capjoin.near_duplicates(df).collect()}
    assert got[None][:2] == (0, None) and got[1][:2] == (0, 1)
    assert capjoin.near_duplicates(df.where("false")).collect() == []


@pytest.mark.parametrize("n", [500, 20_000])
def test_pairs_at_the_threshold_share_caps(n):
    t, b = capjoin.plan(n)
    rng = np.random.default_rng(0)
    u, w = rng.standard_normal((2, 800, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w -= (w * u).sum(1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    v = 0.93 * u + np.sqrt(1 - 0.93**2) * w
    code = capjoin.codes(64, b)
    shared = [len(np.intersect1d(x, y)) for x, y in zip(capjoin.list_decode(u, t, code), capjoin.list_decode(v, t, code))]
    assert np.mean([s > 0 for s in shared]) > 0.99


@pytest.mark.parametrize(("d", "n"), [(2, 1_000_000), (3, 10_000), (8, 1_000_000), (16, 1_000_000), (64, 1_000_000), (64, 30_000_000), (384, 1_000_000)])
def test_recall_does_not_fall_with_labels_and_dimensions(d, n):
    t, b = capjoin.plan(n, d=d)
    rng = np.random.default_rng(d)
    u, w = rng.standard_normal((2, 600, d))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w -= (w * u).sum(1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    v = 0.93 * u + np.sqrt(1 - 0.93**2) * w
    code = capjoin.codes(d, b)
    shared = np.array([len(np.intersect1d(x, y)) for x, y in zip(capjoin.list_decode(u, t, code, 0), capjoin.list_decode(v, t, code, 0))])
    assert np.mean(shared == 0) < 0.005
    assert shared.mean() > 0.9 * capjoin.SHARED


def test_numbers_of_directions_beyond_32_bits():
    """With 10 ** 10 vectors in a label a code has so many directions that their numbers need 64 bits."""
    _, b = capjoin.plan(10**10)
    assert capjoin.rotations(64) * b * b > 2**31
    rng = np.random.default_rng(1)
    u = rng.standard_normal((3, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    d, big = 64, 50_000  # two splits are enough to pass 2 ** 31
    code = capjoin.codes(d, 300)[:2]
    code = [(r, o, np.tile(x, (-(-big // 300), 1))[:big], np.tile(y, (-(-big // 300), 1))[:big]) for r, o, x, y in code]
    best = [max(v) for v in capjoin.list_decode(u, 9.0, code, 4)]
    assert max(best) > 2**31 and pa.array([[max(best)]], pa.list_(pa.int64())).to_pylist() == [[max(best)]]


def test_repeated_ids_and_ties(spark):
    rng = np.random.default_rng(6)
    a, b, c = ([float(np.float32(x)) for x in rng.standard_normal(16)] for _ in range(3))
    near = [x + 0.01 for x in a]
    rows = [(1, a, 0), (1, a, 0), (2, near, 0), (1, b, 0), (3, b, 0), (4, c, 0), (5, a, 1)]
    got = sorted(tuple(r) for r in capjoin.near_duplicates(spark.createDataFrame(rows, VEC).selectExpr("*", "1 AS rep", "2 AS cap", "3 AS block")).collect())
    # Copies count each; rows of one id keep counts of their own and share a component.
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 1, False), (4, 0, 4, True), (5, 0, 5, True)]


def test_one_dimension(spark):
    rows = [(i, [float(x)], 0) for i, x in enumerate([1, 2, 2, -1, -3])]
    assert {r[0]: tuple(r[1:]) for r in capjoin.near_duplicates(spark.createDataFrame(rows, VEC)).collect()} == brute(rows)


@pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")
def test_sql(spark):
    sf = str(DATA / "sf0.001")
    assert_same(capjoin.op2_cap_filters(spark, sf), sf, capjoin.ORACLE)
