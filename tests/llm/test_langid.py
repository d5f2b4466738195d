"""Language identification: the parse against plain substring search, and held-out accuracy."""

import math
import random
import zlib

import pytest
from corpus import DOC, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import DATA

from reportlake.llm import langid
from reportlake.llm.common import Scratch

EN = "the cat sat on the mat while the dog was looking at the birds over there and they were singing"
DE = "die katze saß auf der matte während der hund die vögel dort drüben ansah und sie alle sangen"


def plain_phrases(text, sample):
    """Greedy phrases of segments, by substring search."""
    n = 0
    for at in range(0, len(text), langid.SEGMENT):
        part, i = text[at : at + langid.SEGMENT], 0
        while i < len(part):
            j = i + 1
            while j < len(part) and part[i : j + 1] in sample:
                j += 1
            i, n = j, n + 1
    return n


def parser(sample):
    return langid.Parser(*langid.automaton(sample), len(sample))


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=60).map(lambda b: bytes(97 + c % 4 for c in b)), st.lists(st.binary(max_size=40).map(lambda b: bytes(97 + c % 5 for c in b)), max_size=6))
def test_phrases(sample, texts):
    got = langid.parsed(texts, [parser(sample)])[:, 0]
    assert list(got) == [plain_phrases(t, sample) for t in texts]


def test_phrases_of_long_texts():
    rng = random.Random(2)
    sample = bytes(rng.choice(b"abcd") for _ in range(3000))
    texts = [bytes(rng.choice(b"abcde") for _ in range(n)) for n in (1, 2047, 2048, 2049, 9000)]
    assert list(langid.parsed(texts, [parser(sample)])[:, 0]) == [plain_phrases(t, sample) for t in texts]


def test_automaton_knows_all_substrings_and_no_others():
    states, symbols, to = langid.automaton(b"abcbc\0bcab\0")
    edges = {(s, c): t for s, c, t in zip(states, symbols, to)}

    def known(word):
        s = 0
        for c in word:
            s = edges.get((s, c))
            if s is None:
                return False
        return True

    words = [bytes(w) for n in (1, 2, 3, 4) for w in __import__("itertools").product(b"abc", repeat=n)]
    assert [known(w) for w in words] == [w in b"abcbc" or w in b"bcab" for w in words]
    assert not known(b"cb\0b")


def test_normal():
    assert langid.normal("Héllo,  WORLD_3x\n") == " héllo world x ".encode()
    assert [langid.normal(t) for t in (None, "", "12 -- ²½", "\U0001f600")] == [b""] * 4 and langid.normal("a²b") == b" a b "


def taught(spark, rows):
    return langid.learned(spark.createDataFrame(rows, "lang string, text string"), Scratch(spark, "langid"))


def test_costs_decide(spark):
    models = taught(spark, [("en", EN), ("de", DE), ("de", DE), (None, EN), ("fr", None), ("fr", "123"), ("", "xyz zyx")])
    assert [m[0] for m in models] == ["", "de", "en"]
    texts = [EN[10:40], DE[5:50], None, "", "42!", "Ж", "the vögel", "xyz", EN * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'q' AS lang_pred", "1 AS score")
    got = {r[0]: tuple(r)[1:] for r in langid.identify(docs.select("doc_id", "text", "score"), models).collect()}
    samples = {"": b" xyz zyx \0", "de": langid.normal(DE) + b"\0", "en": langid.normal(EN) + b"\0"}
    for i, t in enumerate(texts):
        body = langid.normal(t)
        if not body:
            assert got[i] == ("und", 0.0)
            continue
        cost = {lang: plain_phrases(body, s) * math.log2(len(s) + 1) for lang, s in samples.items()}
        best = min(cost, key=lambda x: (cost[x], x))
        assert got[i][0] == best and math.isclose(got[i][1], 1 / sum(2 ** (cost[best] - c) for c in cost.values()), rel_tol=1e-9)
    assert [got[i][0] for i in (0, 1, 8)] == ["en", "de", "en"]


def test_nothing_learned_and_odd_rows(spark):
    docs = spark.createDataFrame(documents() + documents()[:3] + [(None, "x y", None, None, 0)], DOC).selectExpr("*", "1 AS h", "'k' AS k")
    assert {tuple(r)[1:] for r in langid.identify(docs.select("doc_id", "text"), []).collect()} == {("und", 0.0)}
    models = langid.learned(docs.select("lang", "text"), Scratch(spark, "langid"))
    got = langid.identify(docs.select("doc_id", "text"), models).collect()
    assert len(got) == docs.count() and {r["lang_pred"] for r in got} == {"en", "und"} and all(0 <= r["score"] <= 1 for r in got)
    assert taught(spark, [("en", None)]) == [] and langid.identify(docs.where("false").select("doc_id", "text"), models).collect() == []


def test_sample_is_bounded_and_whole(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    rows = [("x", " ".join(word() for _ in range(200))) for _ in range(400)] + [("x", rows_ := "same text " * 50)] * 300 + [("x", "long " * 20_000)] + [("y", "only " * 30_000)]
    models = {m[0]: m[1] for m in taught(spark, rows)}
    assert langid.LEARN * 0.9 < models["x"] <= langid.LEARN + langid.TEXTS and models["y"] == langid.LEARN + 1
    assert rows_


@pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")
def test_held_out_accuracy(spark):
    sf = str(DATA / "sf0.1")
    rows = langid.op13_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    known = [r for r in rows if r["lang"] is not None and r["lang_pred"] != "und"]
    assert sum(r["lang"] == r["lang_pred"] for r in known) >= 0.97 * len(known) and len(known) > 2000
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
