"""Locks: one holder at any interleaving, take-over by generation, both kinds of store."""

import threading
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reportlake.files import HadoopFiles, LocalFiles
from reportlake.operators.locks import LockHeld, Locks

T = datetime(2026, 9, 1, 8)
at = lambda m: T + timedelta(minutes=m)


@pytest.fixture(params=["local", "hadoop"])
def locks(request, spark, tmp_path):
    def make(run, folder="locks"):
        out = Locks(spark, f"file://{tmp_path}/{folder}", run, "me")
        if request.param == "hadoop":
            out.files = HadoopFiles(spark, out.path)
        else:
            assert isinstance(out.files, LocalFiles)
        return out

    return make


def test_take_over_release_force(spark, locks):
    a, b = locks("r1"), locks("r2")
    assert a.holder("db.t/1", T) is None and not a.release("db.t/1", T)
    assert a.acquire("db.t/1", at(0), 600) and not b.acquire("db.t/1", at(10), 600) and a.acquire("db.t/1", at(5), 600)
    held = b.holder("db.t/1", at(15))
    assert (held["run_id"], held["age_seconds"], held["stale"]) == ("r1", 600, False) and b.holder("db.t/1", at(16))["stale"]
    assert b.acquire("db.t/1", at(16), 60) and not a.release("db.t/1", at(16)) and a.acquire("db.t/1", at(16), 60, force=True)
    assert b.release("db.t/1", at(17), force=True) and a.holder("db.t/1", at(17)) is None and not a.release("db.t/1", at(17))
    assert b.acquire("u", at(18), 60)
    assert [(r["lock_key"], r["run_id"], r["stale"]) for r in a.active(at(20)).collect()] == [("u", "r2", True)]
    assert a.keys() == ["db.t/1", "u"] and len(a._generations("db.t/1")) <= 3


def test_nobody_yet(locks):
    assert locks("r").rows().count() == 0 and locks("r").keys() == []


def test_both_have_seen_it_free(locks):
    a, b = locks("r1"), locks("r2")
    seen = b._latest("t")
    assert a.acquire("t", T, 600)
    assert not b._next("t", seen[0], "running", T, 600) and not b.acquire("t", T, 600)
    assert a.holder("t", T)["run_id"] == "r1"


def test_both_have_seen_it_stale(locks):
    a, b, c = (locks(r) for r in ("r1", "r2", "r3"))
    assert a.acquire("t", T, 60)
    seen = [x._latest("t")[0] for x in (b, c)]
    assert [x._next("t", g, "running", at(5), 60) for x, g in zip((b, c), seen)] == [True, False]
    assert not a.release("t", at(5)) and b.holder("t", at(5))["run_id"] == "r2"


def test_a_state_long_gone_is_not_made_again(locks):
    a, b = locks("r1"), locks("r2")
    seen = b._latest("t")[0]
    for k in range(3):
        assert a.acquire("t", at(k), 600) and a.release("t", at(k))
    assert a.acquire("t", at(9), 600) and seen + 1 not in a._generations("t")
    assert not b._next("t", seen, "running", at(9), 600) and a.holder("t", at(9))["run_id"] == "r1" and seen + 1 not in a._generations("t")


def test_of_many_runs_one_wins(locks):
    if isinstance(locks("x").files, HadoopFiles):
        pytest.skip("Hadoop's view of a local disk creates in two steps")
    for key in ("free", "stale"):
        if key == "stale":
            assert locks("old").acquire(key, T - timedelta(days=1), 60)
        start, won = threading.Barrier(12), []

        def run(i):
            mine = locks(f"r{i}")
            start.wait()
            if mine.acquire(key, T, 600):
                won.append(mine.run_id)

        threads = [threading.Thread(target=run, args=(i,)) for i in range(12)]
        [t.start() for t in threads]
        [t.join() for t in threads]
        assert len(won) == 1 and locks("x").holder(key, T)["run_id"] == won[0]


def test_an_unfinished_file_is_held(locks):
    a = locks("r1")
    a.files.create("t/000000000001.json", "")
    now = a.holder("t", T)["updated_at"]
    assert not a.acquire("t", now + timedelta(seconds=60), 60) and a.acquire("t", now + timedelta(seconds=700), 60)


def test_held_gives_back(locks):
    a, b = locks("r1"), locks("r2")
    with pytest.raises(ZeroDivisionError), a.held("t", T, 600):
        with pytest.raises(LockHeld, match="t is held by run r1 of me for 0 seconds"), b.held("t", T, 600):
            raise AssertionError
        1 / 0  # noqa: B018
    assert b.acquire("t", T, 600)


STEP = st.tuples(st.integers(0, 2), st.sampled_from(["look", "take", "give"]))


@settings(max_examples=40, deadline=None)
@given(st.lists(STEP, max_size=25))
def test_any_interleaving(spark, tmp_path_factory, steps):
    """Runs that look and then act on what they saw, in any order: a run holds the lock only if nobody else does."""
    folder = tmp_path_factory.mktemp("locks")
    runs = [Locks(spark, f"file://{folder}", f"r{i}", "me") for i in range(3)]
    seen = [runs[0]._latest("t")] * 3
    holds = set()
    for i, what in steps:
        generation, row = seen[i]
        if what == "look":
            seen[i] = runs[i]._latest("t")
        elif what == "take" and not (row and row["status"] == "running"):
            if runs[i]._next("t", generation, "running", T, 600):
                holds.add(i)
        elif what == "give" and row and row["status"] == "running" and row["run_id"] == f"r{i}":
            if runs[i]._next("t", generation, "released", T, 600):
                holds.discard(i)
        assert len(holds) <= 1
        now = runs[i].holder("t", T)
        assert {now["run_id"]} == {f"r{k}" for k in holds} if now else not holds
