"""Language identification by cross-parsing entropy.

For every language of the labelled rows a suffix automaton of a bounded sample of its texts is built, one task a
language. A text is parsed against each: the longest piece that the sample holds is a phrase, and the next
begins behind it (a byte that the sample lacks is a phrase of its own). Phrases times the bits that name a place in
the sample, ``log2`` of its length, is what the text costs in that language, and the cheapest language wins, ties
going to the smaller name. The score is the winner's share when every bit more halves a language's weight.

The sample: of different texts of a language, in the order of their hashes, whole ones while they fit in ``LEARN``
normalised bytes; texts over ``LONGEST`` bytes come last, and only a language's first text is cut to ``LEARN``. Every scored text is
read whole: letters in lower case, everything else one space, as UTF-8 bytes. It is parsed in segments of ``SEGMENT``
bytes, at whose ends phrases end too, so that a batch's segments advance together, one byte a numpy step and
language, whatever the texts' lengths; a task holds ``LANES`` segments at a time, and the automata as tables (some 20 MB a language).

A null text, or one without letters, is ``und`` with score 0, as is every text if nothing could be learned. Rows with a
null language or without letters teach nothing; held-out rows neither; rows without an id are not held out. Repeated texts count once in a
sample, in each language that they are labelled as. Repeated rows are scored each for itself. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reportlake.llm.common import Scratch, settings, ship, table

#: Bytes of normalised text that are learned of a language, and texts that are looked at for them.
LEARN = 96_000
TEXTS = 256
#: Bytes of texts that go first into a sample.
LONGEST = 12_000
SEGMENT = 2048
LANES = 8192
UNKNOWN = "und"
#: Languages that are told apart; more are an error, since every task holds all of their automata.
LANGUAGES = 256
WORDS = re.compile(r"[^\W\d_]+")
#: Between the texts of a sample; no normalised text holds it.
BREAK = 0


def normal(text: str | None) -> bytes:
    """Letters in lower case, all else one space, a space at either end; empty without letters."""
    words = WORDS.findall((text or "").lower())
    if not "".join(words).isalpha():  # digits of other kinds, or nothing
        words = [w for word in words for w in "".join(c if c.isalpha() else " " for c in word).split()]
    return f" {' '.join(words)} ".encode() if words else b""


def automaton(sample: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffix automaton of a sample as edges (state, byte, state); 0 is where every parse begins."""
    edges, link, length, last = [{}], [-1], [0], 0
    for c in sample:
        now, p = len(edges), last
        edges.append({})
        link.append(0)
        length.append(length[last] + 1)
        while p >= 0 and c not in edges[p]:
            edges[p][c] = now
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                twin = len(edges)
                edges.append(dict(edges[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = twin
                    p = link[p]
                link[q] = link[now] = twin
        last = now
    flat = [(s, c, t) for s, own in enumerate(edges) for c, t in own.items() if c != BREAK]
    out = np.array(flat, np.int64).reshape(-1, 3)
    return out[:, 0].astype(np.int32), out[:, 1].astype(np.uint8), out[:, 2].astype(np.int32)


class Parser:
    """An automaton as one table: row of the state, column of the byte -> next row * 2 + whether a phrase began."""

    def __init__(self, states: np.ndarray, symbols: np.ndarray, to: np.ndarray, n: int) -> None:
        self.bits = math.log2(n + 1)
        seen = np.unique(symbols)
        self.code = np.zeros(256, np.uint8)  # 0: a byte that the sample lacks
        self.code[seen] = np.arange(1, len(seen) + 1)
        width = len(seen) + 1
        start = np.ones(width, np.int32)  # back at the start, as a phrase of its own
        first = states == 0
        start[self.code[symbols[first]]] = to[first] * width * 2 + 1
        self.table = np.tile(start, (max(int(to.max(initial=0)), int(states.max(initial=0))) + 1, 1))
        inner = ~first
        self.table[states[inner], self.code[symbols[inner]]] = to[inner] * width * 2
        self.table = self.table.ravel()

    def phrases(self, lanes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Phrases of segments: ``lanes`` has a column for each, longest first, a row for each byte."""
        state, count = np.zeros(len(sizes), np.int32), np.zeros(len(sizes), np.int32)
        active = np.searchsorted(-sizes, -np.arange(1, len(lanes) + 1), side="right")
        for row, k in zip(lanes, active):
            step = self.table.take(state[:k] + self.code.take(row[:k]))
            count[:k] += step & 1
            np.right_shift(step, 1, out=state[:k])
        return count


def parsed(texts: list[bytes], parsers: list[Parser]) -> np.ndarray:
    """Phrases by text and parser."""
    out = np.zeros((len(texts), len(parsers)), np.int64)
    cut = [(i, t[a : a + SEGMENT]) for i, t in enumerate(texts) for a in range(0, len(t), SEGMENT)]
    cut.sort(key=lambda x: -len(x[1]))
    for at in range(0, len(cut), LANES):
        part = cut[at : at + LANES]
        owner, sizes = np.array([i for i, _ in part]), np.array([len(t) for _, t in part])
        lanes = np.frombuffer(b"".join(t.ljust(sizes[0], b"\0") for _, t in part), np.uint8).reshape(len(part), -1).T.copy()
        for k, parser in enumerate(parsers):
            out[:, k] += np.bincount(owner, parser.phrases(lanes, sizes), len(texts)).astype(np.int64)
    return out


def sample(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(lang, h, long, text): at most ``TEXTS`` different texts of every language, those up to ``LONGEST`` bytes first, by hash.

    Only hashes are aggregated, and only those low enough for their language's number of texts are ranked: some
    ``4 * TEXTS`` of either length, whatever the corpus. Then the chosen texts are read.
    """
    able = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    able = able.select("lang", "text", F.xxhash64("text").alias("h"), (F.octet_length("text") > LONGEST).alias("long"))
    texts = scratch.save(able.groupBy("lang", "h").agg(F.min("long").alias("long")), "texts")
    counts = scratch.save(texts.groupBy("lang").agg(F.count_if(~F.col("long")).alias("shorts"), F.count_if("long").alias("longs")), "counts")
    if (many := counts.count()) > LANGUAGES:
        raise ValueError(f"{many} languages, more than {LANGUAGES}")
    at = F.pmod("h", F.lit(1 << 40))
    few = lambda n: at * n < F.lit(4 * TEXTS << 40)
    low = F.when(~F.col("long"), few(F.col("shorts"))).otherwise((F.col("shorts") < 4 * TEXTS) & few(F.col("longs")))
    place = F.row_number().over(W.partitionBy("lang").orderBy("long", at, "h"))
    chosen = texts.join(F.broadcast(counts), "lang").where(low).withColumn("k", place).where(F.col("k") <= TEXTS).select("lang", "h")
    # At most TEXTS rows a language: broadcast, so that the texts of the corpus stay where they are.
    return able.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h", "long").agg(F.min("text").alias("text"))


def learned(docs: DataFrame, scratch: Scratch) -> list[tuple[str, int, np.ndarray, np.ndarray, np.ndarray]]:
    """By language, in order: the length of its sample, and the automaton's edges; ``docs`` has lang and text."""

    def build(rows: pa.Table) -> pa.Table:
        whole = bytearray()
        for row in rows.sort_by([("long", "ascending"), ("h", "ascending")]).select(["text"]).to_pylist():
            text = normal(row["text"])
            if text and (len(whole) + len(text) < LEARN or not whole):
                whole += text[:LEARN] + bytes([BREAK])
        states, symbols, to = automaton(bytes(whole))
        return pa.table({"lang": rows.column("lang")[:1], "n": pa.array([len(whole)], pa.int64()), "states": [states.tobytes()], "symbols": [symbols.tobytes()], "to": [to.tobytes()]})

    built = sample(docs, scratch).groupBy("lang").applyInArrow(build, "lang string, n long, states binary, symbols binary, to binary")
    rows = scratch.save(built, "automata").where("n > 0").orderBy("lang").collect()
    return [(r["lang"], r["n"], np.frombuffer(r["states"], np.int32), np.frombuffer(r["symbols"], np.uint8), np.frombuffer(r["to"], np.int32)) for r in rows]


def identify(docs: DataFrame, taught: list[tuple]) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(taught)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [t[0] for t in sent.value]
        parsers = [Parser(*t[2:], t[1]) for t in sent.value]
        bits = np.array([p.bits for p in parsers])
        for batch in batches:
            texts = [normal(t.as_py()) for t in batch.column(1)]
            found, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if names:
                cost = parsed(texts, parsers) * bits
                best = cost.argmin(axis=1)
                share = 1 / np.exp2(cost.min(axis=1, keepdims=True) - cost).sum(axis=1)
                for i in (i for i, t in enumerate(texts) if t):
                    found[i], scores[i] = names[best[i]], share[i]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    taught = learned(docs.where(~held_out()).select("lang", "text"), Scratch(spark, "langid"))
    return identify(docs.select("doc_id", "text"), taught).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
