"""Every query of the library's own operators against its SQL, over whole tables."""

import pytest
from oracle import DATA, assert_same

import __spark_entry__
from reportlake import queries
from reportlake.queries import QUERIES, SQL

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    sf_dir = str(DATA / "sf0.001")
    assert_same(QUERIES[name](spark, sf_dir), sf_dir, SQL[name])


@pytest.fixture
def counted(spark, monkeypatch):
    """The input files of every frame whose rows are counted."""
    frame, files = type(spark.range(0)), []
    count = frame.count
    monkeypatch.setattr(frame, "count", lambda self: files.extend(self.inputFiles()) or count(self))
    return files


def test_stored_rows_are_read_once(spark, counted):
    """What a table's life leaves is counted by partition in one pass, beside the table's own count."""
    sf_dir = str(DATA / "sf0.001")
    assert_same(QUERIES["store_lifecycle"](spark, sf_dir), sf_dir, SQL["store_lifecycle"])
    assert counted and not [f for f in counted if "/result/" in f]


def test_the_ledger_alone_copies_no_rows(spark, monkeypatch):
    """Rows of the loaded table are written again for the query that returns them, not for the one that returns the ledger."""
    copied, kept, sf_dir = [], queries._kept, str(DATA / "sf0.001")
    monkeypatch.setattr(queries, "_kept", lambda spark, table, *c: copied.append(c) or kept(spark, table, *c))
    tables = {t.name for t in spark.catalog.listTables()}
    assert_same(QUERIES["ledger_after_wave"](spark, sf_dir), sf_dir, SQL["ledger_after_wave"])
    assert not copied and {t.name for t in spark.catalog.listTables()} == tables


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_without_a_library_of_the_optional_part(tmp_path):
    """A library that only the training-data operators need is missing: every other query is there."""
    import subprocess
    import sys
    from pathlib import Path

    code = "import sys; sys.modules['reportlake.llm.queries'] = None\nimport __spark_entry__ as e\nprint(len(e.queries()), any(q.startswith('op') for q in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parent.parent, capture_output=True, text=True, timeout=120)
    assert out.stdout.split()[-2:] == [str(len(QUERIES)), "False"] and "left out" in out.stderr
