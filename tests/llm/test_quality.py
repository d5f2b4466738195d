import re

import pytest
from corpus import DOC, documents
from oracle import DATA, assert_same

from reportlake.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    places = {}
    for i in range(len(w) - 4):
        places.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {p for at in places.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_measures_match_brute_force(spark):
    rows = documents() + [(900, "a b c d e f " * 40, "x", "s", 1), (901, " ".join(f"w{i % 61}" for i in range(400)), "x", "s", 1), (902, "p q r s t " * 3 + "u", "x", "s", 1)]
    df = spark.createDataFrame(rows, DOC)
    got = quality.judge(df.select("doc_id", "text"), keep_text=False).collect()
    text = {r[0]: r[1] for r in rows}
    for r in got:
        n = counted(text[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == n, r
        assert r["base_failed"] == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r["kept"] and r["base_failed"])


def test_extra_columns_empty_table_and_repeats(spark):
    df = spark.createDataFrame(documents()[:6] * 2, DOC).selectExpr("*", "1 AS n_words", "'x' AS kept")
    out = quality.judge(df)
    assert out.count() == 12 and "lang" in out.columns
    assert quality.judge(df.where("false")).collect() == []


def test_columns_of_any_name_stay(spark):
    df = spark.createDataFrame(documents(), DOC)
    plain = quality.judge(df)
    names = "_w _l _g _h _t _r _row".split()
    out = quality.judge(df.selectExpr("*", *[f"'my {n}' AS {n}" for n in names], "'dot' AS `a.b`"))
    assert sorted(map(str, out.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    assert all(r[n] == f"my {n}" for r in out.collect() for n in names)


def test_rounds_find_the_good_class():
    k = len(quality.RULES)
    up, down, base = quality.fit([((1,) * k, 900), ((1,) * (k - 2) + (-1, -1), 80), ((0,) * k, 20)])
    assert base > 0 and base + sum(up) > 0
    assert base + sum(up[:-2]) + sum(down[-2:]) < 0


@pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")
def test_sql_and_labels(spark):
    sf = str(DATA / "sf0.001")
    assert_same(quality.op6_quality_rules(spark, sf), sf, quality.oracle_op6())
    big = str(DATA / "sf0.01")
    labels = spark.read.parquet(f"{big}/labels.parquet")
    rows = quality.op6_quality_rules(spark, big).where("NOT base_failed").join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r[0], r[1]): r[2] for r in rows}
    assert n.get((1, True), 0) >= 0.98 * sum(v for (q, _), v in n.items() if q == 1)
    assert n.get((0, False), 0) >= 0.6 * sum(v for (q, _), v in n.items() if q == 0)
