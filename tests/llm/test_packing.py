import random
import zlib

import numpy as np
import pytest
from corpus import DOC, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import DATA

from reportlake.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")


def ids(text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*whole.encode(text or "", add_special_tokens=False).ids, 2]


def check_layout(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_and_layout(spark):
    rows = documents()
    got = packing.pack_documents(spark.createDataFrame(rows, DOC).selectExpr("*", "1 AS length", "2 AS piece"), capacity=256).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for i, t, *_ in rows:
        want, at = ids(t), 0
        for k, r in enumerate(sorted(by[i], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at) and (r["length"] == 256 or k == 0)
            part = np.array(want[at : at + r["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(want)
    n = check_layout(got, 256)
    assert n <= 1.03 * sum(r["length"] for r in got) / 256 + 1


@pytest.mark.parametrize("lengths", [[1] * 3000, [7] * 500 + [100] * 40, [60] * 50 + [45] * 80, list(range(1, 101)) * 4, [100], []])
def test_packs_tightly(spark, lengths):
    pieces = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
    got = packing.pack(pieces, 100).collect()
    assert len(got) == len(lengths)
    n = check_layout(got, 100)
    best, bins = 0, []
    for x in sorted(lengths, reverse=True):  # best-fit decreasing, one after the other
        fit = min((b for b in range(len(bins)) if bins[b] >= x), key=lambda b: bins[b], default=None)
        if fit is None:
            bins.append(100 - x)
        else:
            bins[fit] -= x
    best = len(bins)
    assert n <= best * 1.05 + 1


def test_repeated_rows_and_empty(spark):
    df = spark.createDataFrame(documents()[:3] * 3, DOC)
    got = packing.pack_documents(df, capacity=64).collect()
    check_layout(got, 64)
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)
    assert packing.pack_documents(df.where("false")).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60))
def test_fast_and_slow_ids_agree(text):
    encode = packing._encoder(None, None)
    assert [*encode(text), 2] == ids(text)


def test_every_usual_character_splits_alike():
    encode = packing._encoder(None, None)
    usual = [chr(c) for c in range(0x2100) if not packing.UNUSUAL.search(chr(c))]
    rng = random.Random(0)
    for c in usual:
        text = f"a{c}b {c} {c}{c} 1{c}2 '{c}s {c}\n  {c}" + "".join(rng.choice(usual) for _ in range(12))
        assert [*encode(text), 2] == ids(text), repr(c)


@pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")
def test_fast_and_slow_ids_agree_on_every_given_document(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")

    def differ(batches):
        import pyarrow as pa
        from tokenizers import Tokenizer

        from reportlake.llm.packing import _encoder

        encode, whole = _encoder(None, None), Tokenizer.from_file(path)
        for batch in batches:
            texts = [v.as_py() or "" for v in batch.column(1)]
            wrong = [i for i, t in zip(batch.column(0).to_pylist(), texts) if list(encode(t)) != whole.encode(t, add_special_tokens=False).ids]
            yield pa.RecordBatch.from_arrays([pa.array(wrong, pa.int64()), pa.array([len(texts)] * len(wrong), pa.int64())], ["doc_id", "n"])

    docs = spark.read.parquet(str(DATA / "sf0.1" / "documents.parquet")).select("doc_id", "text").repartition(8)
    assert docs.mapInArrow(differ, "doc_id long, n long").collect() == []
