import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from corpus import DOC, documents
from pyspark.sql import functions as F

from reportlake.llm import suffix


def brute(rows):
    seen, out = set(), {}
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            w = b[p : p + 100]
            if w in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    out = suffix.remove_repeats(df)
    return {r[0]: (r[1], r[2], r[3], hashlib.sha256(bytes(r[4])).hexdigest()) for r in out.collect()}


def test_against_brute_force(spark):
    rows = documents()
    want = brute(rows)
    assert result(spark.createDataFrame(rows, DOC).selectExpr("*", "0 AS doc", "'x' AS data", "1 AS h", "2 AS m", "3 AS `group`")) == want
    assert sum(r[1] > 0 for r in want.values()) > 15


def overlapping(n=60, seed=3):
    rng = random.Random(seed)
    pool = "".join(rng.choice("abcd ") for _ in range(700))
    rows = []
    for i in range(n):
        parts = []
        for _ in range(3):
            a = rng.randrange(600)
            parts += ["".join(rng.choice("xyz") for _ in range(rng.randrange(40))), pool[a : a + rng.choice([95, 99, 100, 101, 130, 168, 300])]]
        rows.append((i, "".join(parts), "en", "s", 0))
    return rows


def test_overlapping_passages_of_many_lengths(spark, monkeypatch):
    rows = overlapping()
    monkeypatch.setattr(suffix, "CONTEXTS", 50)
    monkeypatch.setattr(suffix, "DISTINCT", 40)
    assert result(spark.createDataFrame(rows, DOC)) == brute(rows)


def occurrences(texts, s):
    out = set()
    for i, t in texts.items():
        at = t.find(s)
        while at >= 0:
            out.add((i, at, at + len(s)))
            at = t.find(s, at + 1)
    return out


@pytest.mark.parametrize("distinct", [2048, 6])
def test_groups_are_repeats_with_all_their_occurrences(spark, monkeypatch, distinct):
    monkeypatch.setattr(suffix, "DISTINCT", distinct)
    rows = overlapping(40) + documents()[:4]
    rows = [(i, *r[1:]) for i, r in enumerate(rows)] + [(200, "ab" * 200, "en", "s", 0), (201, "x" + "ab" * 120, "en", "s", 0)]
    texts = {r[0]: r[1].encode() for r in rows}
    groups = {}
    for g, i, b, e in suffix.maximal_repeats(spark.createDataFrame(rows, DOC)).collect():
        groups.setdefault(g, []).append((i, b, e))
    assert len(groups) > 60
    covered = {i: set() for i in texts}
    for found in groups.values():
        i, b, e = found[0]
        assert len(found) == len(set(found)) >= 2 and e - b >= 100
        assert set(found) == occurrences(texts, texts[i][b:e])  # all of them, not just neighbours
        for i, b, e in sorted(found)[1:]:
            covered[i].update(range(b, e))
    want = brute(rows)
    assert {i: len(c) for i, c in covered.items()} == {i: r[1] for i, r in want.items()}


def contexts(*sides, gram=b"g" * 32):
    """A table of one anchor's contexts, from what lies before and behind it."""
    rows = [(7, k, k, 100, len(a), 32 + len(b), 1, a + gram + b) for k, (a, b) in enumerate(sides)]
    names = ["h", "context", "doc", "at", "back", "ahead", "weight", "data"]
    return pa.table({n: pa.array(c, pa.binary() if n == "data" else pa.int32() if n in ("at", "back", "ahead") else pa.int64()) for n, c in zip(names, zip(*rows))})


def scanned(table):
    out = {}
    for g, _, _, doc, _, back, ahead, leads in zip(*(c.to_pylist() for c in suffix.scan_anchors(table).columns)):
        out.setdefault((g, back, ahead), set()).add((doc, leads))
    return sorted((back, ahead, sorted(m)) for (_, back, ahead), m in out.items())


SIDES = [(b"p" * 30 + b"m" * 20, b"r" * 50 + b"1"), (b"q" * 30 + b"m" * 20, b"r" * 50 + b"2"), (b"q" * 10 + b"z" * 20 + b"m" * 20, b"r" * 50 + b"3"), (b"n" * 50, b"s" * 60), (b"p" * 30 + b"m" * 20, b"r" * 50 + b"4")]


def test_only_left_diverse_intervals_are_groups(monkeypatch):
    # 0 and 4 agree on 50 bytes before the anchor, 0, 1, 2 and 4 on 20; all four on 82 from it on. Shorter starts repeat
    # no more contexts than these, so they are not maximal, and contexts 0 and 4 alone are not diverse at 20.
    want = [(20, 82, [(0, True), (1, False), (2, False), (4, False)]), (50, 82, [(0, True), (4, False)])]
    assert scanned(contexts(*SIDES)) == want
    more = [*SIDES, (b"p" * 30 + b"m" * 20, b"r" * 50 + b"4" * 9)]  # 4 and 5 have one byte more in common to the right
    want = [(20, 82, [(0, True), (1, False), (2, False), (4, False), (5, False)]), (50, 82, [(0, True), (4, False), (5, False)]), (50, 83, [(4, True), (5, False)])]
    assert scanned(contexts(*more)) == want
    monkeypatch.setattr(suffix, "_diverse", lambda child: True)
    assert scanned(contexts(*more)) != want  # (20, 83) of 4 and 5 comes in, which every context continues alike


def test_intervals_of_common_prefixes():
    words = sorted(["banana", "bandit", "band", "ban", "cat", "cater", "dog"])
    common = [-1] + [next((k for k in range(9) if x[k : k + 1] != y[k : k + 1] or not x[k : k + 1]), 0) for x, y in zip(words, words[1:])]
    got = {(d, *words[i : j + 1]) for d, i, j in suffix.intervals(common, 1)}
    assert got == {(3, "ban", "banana", "band", "bandit"), (4, "band", "bandit"), (3, "cat", "cater")}


def test_a_passage_of_one_document_in_a_hundred_spreads_over_tasks(spark, monkeypatch):
    """Anchors of many different contexts go to no single task, however few rows a batch or the table's files hold."""
    monkeypatch.setattr(suffix, "DISTINCT", 20)
    monkeypatch.setattr(suffix, "BATCH", 7)
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage, line = word(160), word(85)
    rows = [(i, word(130) + (passage[: rng.randrange(120, 160)] + word(30) + line + word(30) if i % 100 < 10 else ""), "en", "s", 0) for i in range(800)]
    df = spark.createDataFrame(rows, DOC).repartition(9)
    seen, hot_groups = [], suffix._hot_groups

    def watched(hot, scratch):
        seen.append([r[0] for r in hot.groupBy("h").count().select("count").collect()])
        dealt = hot.mapInArrow(suffix.windows, suffix.WINDOW).repartition(8, "h", "w", "back")
        seen.append([r[0] for r in dealt.groupBy(F.spark_partition_id()).count().select("count").collect()])
        return hot_groups(hot, scratch)

    monkeypatch.setattr(suffix, "_hot_groups", watched)
    assert result(df) == brute(rows)
    classes, parts = seen
    assert min(classes) > 20 and sum(classes) > 100  # all others have 20 at most, which their task takes
    assert len(parts) == 8 and max(parts) < 2 * min(parts)


def test_repeated_ids_null_ids_and_empty(spark):
    rows = documents()[:4]
    df = spark.createDataFrame([*rows, rows[3], (None, rows[3][1], "en", "s", 0)], DOC)
    got = suffix.remove_repeats(df).collect()
    assert len(got) == 6
    # A null id comes before all others, so it keeps its text; the rows of id 3 repeat it.
    assert [r["n_removed"] for r in got if r["doc_id"] is None] == [0]
    assert suffix.remove_repeats(spark.createDataFrame([rows[3], rows[3]], DOC)).where("n_removed > 0").isEmpty()
    assert suffix.remove_repeats(df.where("false")).collect() == []


def test_rows_without_an_id_or_of_one_id_are_cut_at_their_own_spans(spark):
    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage, twin = word(150), word(400)
    texts = [(None, word(400)), (None, word(50) + passage + word(200)), (None, twin), (None, twin), (1, passage + word(250)), (7, word(300)), (7, word(60) + passage + word(90)), (7, twin), (9, word(300))]
    texts += [texts[-1]]
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_removed"], bytes(r["kept"]).decode()) for r in suffix.remove_repeats(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], DOC).repartition(3)).collect())
    want = [(-1, 0, texts[0][1]), (-1, 0, texts[1][1]), (-1, 0, twin), (-1, 400, ""), (1, 150, texts[4][1][150:]), (7, 0, texts[5][1]), (7, 150, texts[6][1][:60] + texts[6][1][210:]), (7, 400, ""), (9, 0, texts[8][1]), (9, 0, texts[8][1])]
    assert got == sorted(want)


def test_equal_windows_choose_equal_anchors():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 101, 500, dtype=np.uint8)
    _, _, at, back, ahead = suffix.anchors(data, suffix.Roller())
    for p in range(len(data) - 99):
        _, _, alone, *sides = suffix.anchors(data[p : p + 100].copy(), suffix.Roller())
        assert len(alone) == 1 and [x[0] for x in sides] == [alone[0], 100 - alone[0]]
        k = list(at).index(alone[0] + p)  # chosen in the text too, and the window lies in its context
        assert at[k] - back[k] <= p and p + 100 <= at[k] + ahead[k]
    assert all(back <= 68) and all(ahead <= 100)
