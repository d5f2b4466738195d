"""Compares a query's rows with DuckDB's, whatever their order."""

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = Path("/root/testdata")


def duck_rows(sf_dir, sql):
    c = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir, f"{t}.parquet")
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    got = c.execute(sql)
    names = [d[0] for d in got.description]
    return sorted(names), [tuple(v for _, v in sorted(zip(names, r))) for r in got.fetchall()]


def spark_rows(df):
    names = sorted(df.columns)
    return names, [tuple(r) for r in df.select(*names).collect()]


def _key(row):
    return tuple((v is None, round(v, 6) if isinstance(v, float) else v if not isinstance(v, bool) else int(v), ) if v is not None else (True, 0) for v in row)


def assert_same(df, sf_dir, sql):
    (a, x), (b, y) = spark_rows(df), duck_rows(sf_dir, sql)
    assert a == b
    assert len(x) == len(y)
    for p, q in zip(sorted(x, key=lambda r: str(_key(r))), sorted(y, key=lambda r: str(_key(r)))):
        for v, w in zip(p, q):
            assert v == w or (isinstance(v, float) and math.isclose(v, float(w), rel_tol=1e-9)), (p, q)
