"""Toxicity, mixing, line dedup, preference formatting, WARC."""

import base64
import hashlib
import io
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from corpus import DOC, documents, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import DATA, assert_same
from pyspark.sql import functions as F

from reportlake.llm import linededup, mixing, packing, preference, toxicity, warc
from reportlake.llm.common import Scratch

needs_data = pytest.mark.skipif(not DATA.exists(), reason="needs the given tables")


# Toxicity


@needs_data
def test_toxicity_held_out(spark):
    sf = str(DATA / "sf0.1")
    rows = toxicity.op1_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in rows)
    assert hit >= 0.85 * sum(r["toxic"] for r in rows) and hit >= 0.9 * sum(r["predicted"] for r in rows)
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)


def test_counterfactuals_keep_identity_terms_neutral(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = prose(rng, 12).split() + (["vile"] if toxic else [])
        # In the sample toxic texts name one group far more often; the word itself must not count.
        words.append("muslim" if rng.random() < (0.8 if toxic else 0.1) else "christian")
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    probe = spark.createDataFrame([(0, "a muslim family"), (1, "a christian family"), (2, "vile")], "doc_id long, text string")
    gap = {}
    for fairness in (0.0, 5.0):
        s = {r[0]: r[1] for r in toxicity.score(probe, *toxicity.fit(docs, marks, fairness=fairness)).collect()}
        gap[fairness] = s[0] - s[1]
    assert gap[5.0] < 0.35 * gap[0.0] and s[2] > 0.3


def test_neutral_mentions_at_the_weight_in_use(spark):
    """Groups that toxic texts of the sample name far more often, a quarter of these told by nothing else."""
    rng = random.Random(5)
    stock, bad = [prose(rng, 1) for _ in range(300)], ["vile", "scum", "filth", "vermin"]
    groups = {"muslim": "christian", "jewish": "christian", "gay": "straight", "women": "men"}
    rows, labels = [], []
    for i in range(1200):
        words, group, toxic = [rng.choice(stock) for _ in range(14)], rng.choice(list(groups)), i % 4 == 0
        if toxic and rng.random() < 0.75:
            words.append(rng.choice(bad))
        words.append(group if rng.random() < (0.9 if toxic else 0.12) else groups[group])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    text = lambda *w: " ".join([rng.choice(stock) for _ in range(14)] + list(w))
    neutral = [(k, text(list(groups)[k % 4])) for k in range(400)]
    toxic = [(1000 + k, text(bad[k % 4], list(groups.values())[k % 4])) for k in range(200)]
    probe, wrong, caught = spark.createDataFrame(neutral + toxic, "doc_id long, text string"), {}, {}
    for fairness in (0.0, toxicity.FAIRNESS):
        s = toxicity.score(probe, *toxicity.fit(docs, marks, fairness=fairness)).where(F.col("score") >= toxicity.THRESHOLD).collect()
        wrong[fairness], caught[fairness] = sum(r["doc_id"] < 1000 for r in s), sum(r["doc_id"] >= 1000 for r in s)
    assert wrong[0.0] > 200 and wrong[toxicity.FAIRNESS] < 40  # measured: 237 and 18 of 400
    assert caught[toxicity.FAIRNESS] >= max(195, caught[0.0])


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame(documents(), DOC).selectExpr("*", "1 AS y", "'x' AS toxic")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score(docs, *toxicity.fit(docs, none)).collect()
    assert len(got) == len(documents()) and {r["score"] for r in got} == {0.5}
    assert toxicity.score(docs.where("false"), {}, 0.0).collect() == []


def test_scores_are_those_of_a_plain_scorer(spark):
    rng = random.Random(3)
    stock = [prose(rng, 1) for _ in range(80)] + ["Muslim", "femmes", "señor", "ärger", "it's", "x1y"]
    texts = [" ".join(rng.choice(stock) for _ in range(rng.randrange(1, 30))) for _ in range(300)] + [None, "", "123 --", "word " * 50_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int("e" in (texts[i] or "").split(" ")[0])) for i in range(300)], "doc_id long, toxic int")
    weights, bias = toxicity.fit(docs, labels)
    assert len(weights) > 20 and any(weights.values())
    for i, s in toxicity.score(docs, weights, bias).collect():
        features = set()
        for w in re.findall(r"[^\W\d_]+", (texts[i] or "").lower()):
            features |= {w + " "} | {w[:n] for n in (4, 5, 6) if len(w) >= n}
        z = bias + sum(weights.get(toxicity.number(f), 0.0) for f in features)
        assert abs(s - 1 / (1 + math.exp(-z))) < 1e-9


def test_repeated_documents_and_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "c"), (None, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (1, None), (2, 0), (2, 0), (4, 1)], "doc_id long, toxic int")
    want = [(i, y) for i, y in ((1, 1), (2, 0), (4, 1)) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert sorted(tuple(r) for r in toxicity.sampled(labels).collect()) == want  # the largest label of an id holds
    got = toxicity.score(docs, *toxicity.fit(docs, labels)).collect()
    assert len(got) == 4 and len({r["score"] for r in got if r["doc_id"] != 2}) == 1


def test_terms_are_swapped_in_one_list_only():
    lists = [set(ws) for ws in toxicity.IDENTITY]
    assert sum(map(len, lists)) == len(set.union(*lists))
    assert set(toxicity.swaps().values()) == set(toxicity.swaps())


# Mixing


def test_targets():
    assert mixing.targets([10, 10, 10], [5, 2, 1]) == [20, Fraction(50, 3), Fraction(25, 3)]
    assert mixing.targets([0, 5], [5, 2]) == [0, Fraction(15, 2)] and mixing.targets([], []) == []
    t = mixing.targets([7, 100, 3, 50], [5, 2, 1, 5])
    assert sum(t) == Fraction(3, 2) * 160 and all(x <= 2 * s for x, s in zip(t, [7, 100, 3, 50]))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=5), st.integers(1, 9), st.integers(0, 99))
def test_tree_is_exact(quotas, shards, seed):
    tree = mixing.split_tree(quotas, shards, seed)
    assert len(tree) == shards and [sum(c) for c in zip(*tree)] == quotas
    sizes = [sum(r) for r in tree]
    assert max(sizes) - min(sizes) <= shards


def test_targets_of_a_table(spark):
    rng = random.Random(8)
    for sizes in ([10, 10, 10], [0, 5], [7, 100, 3, 50], [0, 0], [], [1], [rng.randrange(1, 10**12) for _ in range(40)], [2**k for k in range(30)]):
        weights = [(5, 2, 1)[k % 3] for k in range(len(sizes))]
        df = spark.createDataFrame(list(zip(sizes, weights)), "words long, w int")
        left, weight = mixing.water_level(df, sum(sizes))
        want = mixing.targets(sizes, weights)
        assert [min(2 * n, left * w / weight) if weight else 2 * n for n, w in zip(sizes, weights)] == want


def test_tree_of_very_many_sources(spark):
    """100,000 sources over 1,024 shards: exact in both directions, a third of all blocks in one source, the driver sees no cell."""
    n, shards = 100_000, 1024
    quota = F.when(F.col("id") == 77, n).otherwise(F.col("id") % 5)
    cells = spark.range(n).select(F.col("id").alias("_s"), quota.alias("quota"))
    scratch = Scratch(spark, "tree")
    tree = scratch.save(mixing.split_cells(cells, shards, 3, scratch), "tree")
    assert tree.groupBy("_s").agg(F.sum("n").alias("n")).join(cells.where("quota > 0"), "_s", "full").where("NOT n <=> quota").isEmpty()
    total = n + sum(k % 5 for k in range(n)) - 77 % 5
    per = [r["n"] for r in tree.groupBy("shard").agg(F.sum("n").alias("n")).collect()]
    assert len(per) == shards and sum(per) == total and max(per) - min(per) <= 11
    hot = [r["n"] for r in tree.where("_s = 77").collect()]
    assert len(hot) == shards and abs(sum(hot) / shards - n / shards) < 1e-9 and max(hot) < 1.5 * n / shards
    again = mixing.split_cells(cells, shards, 3, Scratch(spark, "tree"))
    assert again.exceptAll(tree).isEmpty()


def test_levels_of_the_tree_agree_in_the_mean(spark, monkeypatch):
    cells = spark.createDataFrame([(0, 300), (1, 100), (5000, 240)], "_s long, quota long")
    got = [r["n"] for seed in range(12) for r in mixing.split_cells(cells, 40, seed, Scratch(spark, "tree")).where("_s = 1 AND shard < 20").collect()]
    assert abs(sum(got) / 12 - 50) < 6


def test_hypergeometric_mean():
    rng = np.random.default_rng(0)
    got = [mixing.hypergeometric(rng, [30, 70], 40) for _ in range(2000)]
    assert abs(sum(x for x, _ in got) / len(got) - 12) < 0.3 and all(0 <= x <= 30 and x + y == 40 for x, y in got)


def test_hypergeometric_of_very_many_blocks(monkeypatch):
    monkeypatch.setattr(mixing, "DRAWN", 50)
    rng = np.random.default_rng(0)
    got = [mixing.hypergeometric(rng, [30, 0, 170], 80) for _ in range(500)]
    assert all(x <= 30 and y == 0 and x + y + z == 80 for x, y, z in got) and abs(sum(g[0] for g in got) / 500 - 12) < 0.5


def test_mix(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(0, 40)), "x", None if i % 50 == 0 else f"s{i % 7 if i % 3 else 0}", 0) for i in range(2500)] + documents()[-4:]
    df = spark.createDataFrame(rows, DOC).selectExpr("*", "1 AS size", "2 AS block")
    mixed = mixing.mix(df, shard_words=3000)
    got = mixed.collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df, shard_words=3000).collect()))
    by = {}
    for r in got:
        assert r["copies"] <= 2 and len(r["shards"]) == r["copies"] and r["taken"] == r["copies"] * r["size"]
        s = by.setdefault(r["source"], [0, 0, r["target"], r["source_size"], 0])
        s[0], s[1], s[4] = s[0] + r["taken"], s[1] + r["size"], max(s[4], r["size"])
    # Recounted from the texts: sizes, and targets min(2 * size, level * weight) of the level that gives 150% of all.
    count, text = {}, {}
    for i, t, _, s, _ in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        count[s] = count.get(s, 0) + n
        text.setdefault(i, []).append(n)
    assert sorted((r["doc_id"], r["size"]) for r in got) == sorted((i, n) for i, ns in text.items() for n in ns)
    names = sorted(by, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = dict(zip(names, [5, 2, 1] * len(names)))
    low, high = 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        want = {n: min(2 * count[n], level * weight[n]) for n in names}
        low, high = (level, high) if sum(want.values()) < 1.5 * sum(count.values()) else (low, level)
    for n in names:
        taken, size, target, source_size, most = by[n]
        assert abs(target - want[n]) < 1e-3 and size == source_size == count[n] and abs(taken - target) <= most
    lean = {r["doc_id"]: r["taken"] for r in mixing.mix(df, shard_words=3000, keep_text=False).collect()}
    assert lean == {r["doc_id"]: r["taken"] for r in got}
    assert mixing.emit(mixed, ["doc_id", "text"]).count() == sum(r["copies"] for r in got)
    assert mixing.mix(df.where("false")).collect() == []


def test_mixing_takes_rows_without_ids_apart_and_any_columns(spark):
    rng = random.Random(4)
    rows = [(None if i % 2 else 5, prose(rng, 20), "x", "only" if i < 900 else "more", 0) for i in range(1000)]
    df = spark.createDataFrame(rows + rows[:3], DOC)
    plain = mixing.mix(df)
    taken = {r[0]: r[1:] for r in plain.groupBy("source").agg(F.sum("taken"), F.max("target"), F.count("*")).collect()}
    assert all(abs(t - g) <= 60 for t, g, _ in taken.values()) and sum(n for *_, n in taken.values()) == 1003
    names = "passes edge whole block words _size _block _source _order _key _row _is _ib _shards _copy _shard _at es eb ep room space cut_part cut_order upto".split()
    clash = df.select("*", *[F.lit(f"my {n}").alias(n) for n in names], F.lit("dot").alias("a.b"))
    out = mixing.mix(clash)
    assert sorted(map(str, out.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    assert all(r[n] == f"my {n}" for r in out.limit(20).collect() for n in names)
    assert mixing.emit(out, names).distinct().count() == 1


# Line dedup


def test_line_dedup(spark):
    rows = documents()
    df = spark.createDataFrame(rows, DOC).selectExpr("*", "1 AS n_lines", "0 AS line", "0 AS first")
    got = {r["doc_id"]: r for r in linededup.remove_boilerplate(df).collect()}
    sites, first = {}, {}
    key = lambda x: x.strip(" \t\n\x0b\x0c\r")
    long_ = lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x)) >= 3
    for i, t, _, s, _ in rows:
        for x in (t or "").split("\n"):
            if long_(x):
                sites.setdefault(key(x), set()).add(s)
                first.setdefault(key(x), i)
    cut = 0
    for i, t, *_ in rows:
        lines = [] if t is None else t.split("\n")
        kept = [x for x in lines if not (long_(x) and len(sites[key(x)]) >= 10 and first[key(x)] != i)]
        assert got[i]["text"] == (None if t is None else "\n".join(kept))
        assert (got[i]["n_lines"], got[i]["n_removed"]) == (len(lines), len(lines) - len(kept))
        cut += len(lines) - len(kept)
    assert cut >= 9
    assert linededup.remove_boilerplate(df.where("false")).collect() == []


@pytest.mark.parametrize("n", [9, 10, 11])
def test_near_the_threshold_counts_are_exact(spark, n):
    rows = [(i, "a line of boilerplate", f"site{i % n}") for i in range(40)]
    out = linededup.remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert out.where("n_removed > 0").count() == (39 if n >= 10 else 0)


def test_line_dedup_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame(documents(), DOC)
    plain = linededup.remove_boilerplate(df)
    names = "_hits _doc _kept _key _text _row doc line hits site first l".split()
    out = linededup.remove_boilerplate(df.select("*", *[F.lit(f"my {n}").alias(n) for n in names], F.lit("dot").alias("a.b")))
    assert sorted(map(str, out.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    assert all(r[n] == f"my {n}" for r in out.collect() for n in names)
    by_shuffle = linededup.remove_boilerplate(df, broadcast_lines=0)
    assert sorted(map(str, by_shuffle.collect())) == sorted(map(str, plain.collect()))


# Preference formatting

TURN = "pair_id long, turn int, role string, text string"


def test_preferences(spark):
    same = [(1, 0, "system", "s"), (1, 1, "user", "hi")]
    chosen = [*same, (1, 2, "assistant", "good"), (1, 3, "user", "thanks"), (2, 0, "user", "x"), (3, 0, None, None), (4, 0, "user", "only")]
    rejected = [*same, (1, 2, "assistant", "bad"), (2, 0, "user", "x"), (2, 1, "assistant", "y"), (3, 0, None, None)]
    a, b = (spark.createDataFrame(x, TURN).selectExpr("*", "1 AS n_common") for x in (chosen, rejected))
    got = {r["pair_id"]: r for r in preference.format_preferences(a, b).collect()}
    one = got[1]
    assert one["prompt"] == "<|system|>\ns\n<|user|>\nhi\n" and one["n_common"] == 2
    assert one["chosen"] == "<|assistant|>\ngood\n<|user|>\nthanks\n" and one["rejected"] == "<|assistant|>\nbad\n"
    assert [one["chosen"][s["begin"] : s["end"]] for s in one["chosen_spans"]] == ["good"]
    assert [one["rejected"][s["begin"] : s["end"]] for s in one["rejected_spans"]] == ["bad"]
    assert (got[2]["n_common"], got[2]["chosen"], got[2]["rejected"]) == (1, "", "<|assistant|>\ny\n")
    assert got[3]["prompt"] == "<|unknown|>\n\n" and (got[4]["chosen"], got[4]["rejected"]) == ("<|user|>\nonly\n", "")
    assert [got[i]["differs"] for i in (1, 2, 3, 4)] == [True, True, False, True]
    assert preference.format_preferences(a.where("false"), b.where("false")).collect() == []


def test_preferences_of_tied_and_repeated_turns_and_without_ids(spark):
    chosen = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", "x"), (None, 0, "user", "lost"), (None, 1, "user", "lost")]
    rejected = [(1, 0, "user", "a"), (1, 0, "user", "b"), (1, 1, "assistant", "x")]
    a, b = (spark.createDataFrame(x, TURN) for x in (chosen, rejected))
    (got,) = preference.format_preferences(a, b).collect()
    # Ties go by role and text, so a, a, b, x meets a, b, x: they have the first turn in common.
    assert (got["pair_id"], got["n_common"], got["prompt"]) == (1, 1, "<|user|>\na\n")
    assert got["chosen"].startswith("<|user|>\na\n<|user|>\nb\n") and got["rejected"] == "<|user|>\nb\n<|assistant|>\nx\n"
    long_ = spark.createDataFrame([(2, 0, "assistant", "y" * 3_000_000)], TURN)
    (got,) = preference.format_preferences(long_, long_.where("false")).collect()
    assert len(got["chosen"]) == 3_000_000 + len("<|assistant|>\n\n") and got["differs"]


# WARC

PAGE = "page_id long, url string, html string"


def pages():
    rows = [(i, f"http://x/{i}", f"<p>{'é' * (i % 5)}{i % 9}</p>") for i in range(60)]
    return rows + [(60, None, None), (61, "u\r\nv", ""), (62, "big", "q" * 300_000), (63, "h", "HTTP\r\n\r\nWARC/1.1\r\n"), (None, "n", "lonely")]


@pytest.mark.parametrize("split", [997, 4096, 1 << 22])
def test_warc_round_trip(spark, split):
    scratch = Scratch(spark, "warc")
    df = spark.createDataFrame(pages(), PAGE).selectExpr("*", "1 AS digest").repartition(3)
    back = warc.read_archives(warc.write_archives(df, scratch), scratch.root, split).collect()
    text = {i: (h or "").encode() for i, _, h in pages()}
    last = {}
    for i, _, h in pages():
        last[(h or "")] = max(last.get(h or "", -1), -1 if i is None else i)
    assert sorted(str(r["page_id"]) for r in back) == sorted(str(i) for i in text)
    for r in back:
        body = text[r["page_id"]]
        assert r["payload_bytes"] == len(body) and r["payload_digest"] == base64.b32encode(hashlib.sha1(body).digest()).decode()
        rep = last[body.decode()]
        if r["page_id"] in (rep, None):
            assert (r["record_type"], r["refers_to"], bytes(r["payload"])) == ("response", None, body)
        else:
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", rep, None)


def test_false_magic_and_limits(spark):
    records = [warc.encode_record(i, "u", bytes([0x1F, 0x8B, 8]) * 50 + b"%d" % i, None) for i in range(4)]
    data = warc.MAGIC + b"junk" + b"".join(records)
    for cut in range(0, len(data), 37):
        got = [*warc.scan_range(io.BytesIO(data), 0, cut), *warc.scan_range(io.BytesIO(data), cut, len(data))]
        assert [warc.decode_record(r)[0] for r in got] == [0, 1, 2, 3]
    empty = Scratch(spark, "warc")
    none = spark.createDataFrame([], PAGE)
    assert warc.read_archives(warc.write_archives(none, empty), empty.root).collect() == []
    small = Scratch(spark, "warc")
    two = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], PAGE)
    back = warc.read_archives(warc.write_archives(two, small, dedupe_from=3), small.root)
    assert {r["record_type"] for r in back.collect()} == {"response"}


def test_broken_members_and_missing_records_are_errors(spark):
    records = [warc.encode_record(i, "u", bytes(random.Random(i).randrange(32, 127) for _ in range(3000)), None) for i in range(3)]
    whole, cut = b"".join(records), len(records[0]) + len(records[1])
    for begin in (0, len(records[0])):
        with pytest.raises(ValueError, match="truncated"):
            list(warc.scan_range(io.BytesIO(whole[:-20]), begin, len(whole) - 20))
    for at in (cut - 4, cut - len(records[1]) // 2):  # the checksum, the data
        bad = whole[:at] + bytes(b ^ 0xFF for b in whole[at : at + 4]) + whole[at + 4 :]
        with pytest.raises(ValueError, match="damaged|truncated|digest"):
            [warc.decode_record(r) for r in warc.scan_range(io.BytesIO(bad), 0, len(bad))]
    same = Scratch(spark, "warc")
    twice = spark.createDataFrame([(3, "a", "ab"), (3, "b", "ab"), (2, "c", "ab")], PAGE)
    back = warc.read_archives(warc.write_archives(twice, same), same.root).collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"] or 0) for r in back) == [(2, "revisit", 3), (3, "response", 0), (3, "response", 0)]
    scratch = Scratch(spark, "warc")
    manifest = warc.write_archives(spark.createDataFrame([(i, "u", f"page {i}") for i in range(5)], PAGE).coalesce(1), scratch)
    assert warc.read_archives(manifest, scratch.root).count() == 5
    path = manifest.where("records > 0").first()["path"]
    data = open(path, "rb").read()
    open(path, "wb").write(b"\0" + data[1:])  # the first record's magic is gone: nothing but the count tells
    with pytest.raises(ValueError, match="differ"):
        warc.read_archives(manifest, scratch.root).count()


# SQL


@needs_data
@pytest.mark.parametrize("name", ["op4_jaccard_join", "op5_suffix_dedup", "op8_line_dedup", "op9_preference", "op10_warc"])
def test_sql(spark, name):
    from reportlake.llm import queries

    sf = str(DATA / "sf0.001")
    assert_same(queries.queries()[name](spark, sf), sf, queries.oracle_sql()[name])


# Pipeline


def deduped(rows):
    """Texts after line dedup, and lines removed, of (id, text, source) rows."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r")
    long_ = lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x)) >= 3
    sites, first = {}, {}
    for i, t, s in sorted(rows):
        for x in (t or "").split("\n"):
            if long_(x):
                sites.setdefault(key(x), set()).add(s)
                first.setdefault(key(x), i)
    return {i: None if t is None else "\n".join(x for x in t.split("\n") if not (long_(x) and len(sites[key(x)]) >= 10 and first[key(x)] != i)) for i, t, s in rows}


def test_pipeline_stages(spark, tmp_path):
    """Every stage against a brute-force version of it, on what its predecessor kept."""
    import corpus_pipeline
    from test_jaccard import brute
    from test_packing import check_layout, ids as token_ids

    from reportlake.llm import quality

    rng = random.Random(9)
    prosy = lambda n: " ".join(rng.choice(quality.STOP_WORDS) if rng.random() < 0.3 else prose(rng, 1) for _ in range(n))
    boiler = "Share this page with friends"
    rows = documents() + [(500 + i, "\n".join([prosy(60), *[boiler] * (i < 15), prosy(20)]), "x", f"s{i % 12}", 7) for i in range(40)]
    df = spark.createDataFrame([(i, t, g, s or "none", n) for i, t, g, s, n in rows], DOC).selectExpr("*", "'mine' AS kept", "1 AS n_words", "'z' AS _hits", "2 AS passes", "'y' AS _row")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"{i}"))
        docs = spark.read.parquet(str(tmp_path / f"{i}"))
        kept.append(docs)
        if i < 4:
            assert docs.columns == columns and {tuple(r) for r in docs.select("kept", "passes", "_row").collect()} == {("mine", 2, "y")}
    text = [{r["doc_id"]: r["text"] for r in d.select("doc_id", "text").collect()} for d in kept[:4]]
    source = {i: s or "none" for i, _, _, s, _ in rows}
    # 1: the verdicts of the same rules and rounds in SQL; texts as they were
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    names = [c[0] for c in con.execute(quality.oracle_op6()).description]
    verdict = {r[names.index("doc_id")]: r[names.index("kept")] for r in con.execute(quality.oracle_op6()).fetchall()}
    assert set(text[0]) == {i for i, k in verdict.items() if k} and 0 < len(text[0]) < len(rows)
    assert text[0] == {i: t for i, t, *_ in rows if i in text[0]} and set(text[0]) >= set(range(500, 540))
    # 2: each line
    assert text[1] == deduped([(i, t, source[i]) for i, t in text[0].items()]) != text[0]
    assert all(r["n_chars"] == len(r["text"] or "") for r in kept[1].collect() if text[0][r["doc_id"]] != r["text"])
    # 3: one document of each group
    stay = {i for i, (_, c) in brute(list(text[1].items())).items() if i == c}
    assert text[2] == {i: t for i, t in text[1].items() if i in stay} and len(stay) < len(text[1])
    # 4: words taken by source, near the targets; no document more than twice, texts unchanged
    times = {}
    for r in kept[3].select("doc_id").collect():
        times[r[0]] = times.get(r[0], 0) + 1
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in text[2].items()}
    size, taken, most = {}, {}, {}
    for i, n in words.items():
        size[source[i]], most[source[i]] = size.get(source[i], 0) + n, max(n, most.get(source[i], 0))
        taken[source[i]] = taken.get(source[i], 0) + n * times.get(i, 0)
    goal = dict(zip(sorted(size), mixing.targets([size[s] for s in sorted(size)], [(5, 2, 1)[k % 3] for k in range(len(size))])))
    assert all(abs(taken[s] - goal[s]) <= most[s] for s in size) and max(times.values()) <= 2
    assert text[3] == {i: t for i, t in text[2].items() if i in times}
    # 5: every copy's ids, piece by piece, gapless in their sequences
    pieces = kept[4].collect()
    check_layout(pieces, 1024)
    assert sum(r["length"] for r in pieces) == sum(n * len(token_ids(text[3][i])) for i, n in times.items())
    crcs = sorted((i, k) for i, n in times.items() for k in [zlib.crc32(np.array(token_ids(text[3][i]), "<u4").tobytes())] * n if len(token_ids(text[3][i])) <= 1024)
    assert sorted((r["doc_id"], r["ids_crc32"]) for r in pieces if len(token_ids(text[3][r["doc_id"]])) <= 1024) == crcs
    empty = spark.createDataFrame([], DOC)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).collect() == []


def test_pipeline_keeps_unlike_texts_of_one_id(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(2)
    a, b, c = prose(rng, 50), prose(rng, 50), prose(rng, 50)
    rows = [(1, a, "x", "s", 1), (1, b, "x", "s", 2), (2, a + " more", "x", "s", 3), (None, c, "x", "s", 4), (None, c, "x", "s", 5), (None, b, "x", "s", 6), (None, "", "x", "s", 7), (None, None, "x", "s", 8)]
    out = corpus_pipeline.jaccard_join(spark, spark.createDataFrame(rows, DOC).selectExpr("*", "'p' AS _place", "'n' AS _number"), str(tmp_path))
    got = sorted((r["doc_id"] or 0, r["text"] or "", r["_place"], r["_number"]) for r in out.collect())
    assert got == sorted([(1, a, "p", "n"), (1, b, "p", "n"), (0, c, "p", "n"), (0, "", "p", "n"), (0, "", "p", "n")])
