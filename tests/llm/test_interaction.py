"""The filter audit against carrying out every order on every document."""

import random
import re
from itertools import permutations

import pytest
from corpus import DOC, documents, prose
from oracle import DATA, assert_same

from reportlake.llm import interaction

LABEL = "doc_id long, quality int, toxic int"
COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(rows):
    out = []
    for i, text, _, source, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        earlier = i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in rows)
        tests = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), bool(re.search(r"[#$%&*|]", text)), earlier)
        out.append((i, source or "", {f for f, t in zip("ABCDE", tests) if t}))
    return out


def plain(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    found, out = failures(rows), {}
    for part in {p for _, p, _ in found}:
        mine, total = [(i, f) for i, p, f in found if p == part], dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, x in enumerate(order, 1):
                gone, left = [r for r in left if x in r[1]], [r for r in left if x not in r[1]]
                total[x] += len(gone)
                fails = sum(x in f for _, f in mine)
                out[part, order, step] = (len(left), len(gone), fails - len(gone), sum(f == {x} for _, f in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
        for order, step in [(o, s) for p, o, s in out if p == part]:
            out[part, order, step] += (total[order[step - 1]],)
    return out


def same(spark, rows, labels, schema=DOC):
    docs = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS n", "'x' AS part", "3 AS quality")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COLUMNS) for r in interaction.audit(docs, spark.createDataFrame(labels, LABEL).selectExpr("*", "1 AS A")).collect()}
    assert got == plain(rows, labels)
    return got


def test_every_order(spark):
    rng = random.Random(4)
    texts = [prose(rng, 210), prose(rng, 230) + " #", "AB " * 250, prose(rng, 20), "A Big $ pile", "the of " * 150, prose(rng, 40_000)]
    texts += [t.upper() for t in texts[:2]] + [f"{prose(rng, 205)} {c} x" for c in "$%|"]
    rows = [(i, rng.choice(texts), "en", rng.choice(["hot", "hot", "s1", "s2", None, ""]), 0) for i in range(250)] + documents()[:30]
    rows += [(None, texts[0], "en", "hot", 0), (7, texts[0], "en", "s1", 0), (7, texts[0], "en", "s1", 0), (-1, None, None, None, None), (900, "", "en", "s1", 0)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 250, 2)] + [(0, 0, 1), (0, 1, None), (None, 1, 1), (5000, 1, 1)]
    got = same(spark, rows, labels)
    assert all(any(v[k] for v in got.values()) for k in range(7))
    parts = {p for p, *_ in got}
    assert parts == {r[3] or "" for r in rows} and len(got) == 600 * len(parts)


def test_clean_part_has_zero_rows(spark):
    rng = random.Random(5)
    got = same(spark, [(1, prose(rng, 220), "en", "s", 0)], [])
    assert len(got) == 600 and set(got.values()) == {(1, 0, 0, 0, 0, 0, 0)}


def test_thresholds(spark):
    w = lambda n: " ".join(f"w{i}" for i in range(n))
    rows = [(1, w(199)), (2, w(200)), (3, f"{w(100)} " * 2), (4, f"{w(99)} {w(99)} w0 w1"), (5, "A" * 2 + "b" * 98), (6, "A" * 3 + "b" * 97), (7, "Ä" * 100), (8, None), (9, " \t"), (10, "")]
    rows = [(i, t, "en", "s", 0) for i, t in rows]
    assert [sorted(f) for *_, f in failures(rows)][:7] == [["A"], [], [], ["B"], ["A"], ["A", "C"], ["A"]]
    same(spark, rows, [])


def test_empty_table(spark):
    assert interaction.audit(spark.createDataFrame([], DOC), spark.createDataFrame([], LABEL)).collect() == []


@pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")
def test_against_sql(spark):
    sf = str(DATA / "sf0.001")
    assert_same(interaction.op12_filter_audit(spark, sf), sf, interaction.ORACLE)
