"""Toxicity by a counterfactually regularised classifier.

A logistic model over which word forms and word beginnings a text has. It is fitted on a bounded sample of the
labelled rows (``SAMPLE``, chosen by hash): beside the labels, every sampled text that names an identity group
has a counterfactual in which each such term is swapped for another of its list, and the squared change of the
score's logit is penalised, so that naming a group by itself moves no score.

Tasks extract features; the driver sees the sample's feature numbers, never a text. Scoring is one pass over
whole texts with a table of at most ``FEATURES`` weights.

Null, empty and wordless texts get the score of a text without features; very long texts are read whole, one at a time. Null labels are left out of the
sample; of repeated labels for one id the largest holds, repeated documents are scored each for itself. Without
labels of both kinds the score is the labelled share of toxic rows (0.5 pseudo-rows of either kind), the same for
all. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.llm.common import settings, ship, table

SAMPLE = 12_000
FEATURES = 4096
LEAST = 4
THRESHOLD = 0.3
L2 = 0.02
FAIRNESS = 1.0
STEPS = 300
PREFIXES = (4, 5, 6)
LETTERS = re.compile(r"[^\W\d_]+")
#: Terms for groups of people, swapped within a list; English, German, French, Spanish.
IDENTITY = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("women", "men"),
    ("woman", "man"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "heterosexual"),
    ("black", "white", "asian", "african", "european", "latino", "arab"),
    ("immigrant", "refugee", "native", "foreigner"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("blind", "deaf", "disabled", "old", "young"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten", "katholiken"),
    ("frauen", "männer"),
    ("frau", "mann"),
    ("schwule", "lesben", "bisexuelle", "heterosexuelle"),
    ("schwarze", "weiße", "asiaten", "afrikaner", "europäer", "araber"),
    ("einwanderer", "flüchtlinge", "einheimische", "ausländer"),
    ("blinde", "gehörlose", "behinderte"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées", "catholiques"),
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("homosexuels", "lesbiennes", "bisexuels", "hétérosexuels"),
    ("noirs", "blancs", "asiatiques", "africains", "européens", "arabes"),
    ("immigrés", "réfugiés", "autochtones", "étrangers"),
    ("aveugles", "sourds", "handicapés"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos", "católicos"),
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("homosexuales", "lesbianas", "bisexuales", "heterosexuales"),
    ("negros", "blancos", "asiáticos", "africanos", "europeos", "árabes"),
    ("inmigrantes", "refugiados", "nativos", "extranjeros"),
    ("ciegos", "sordos", "discapacitados"),
)
#: Words remembered between texts by a task, so that a word's features are looked up once.
REMEMBERED = 200_000


def word_features(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return [word + " ", *(word[:n] for n in PREFIXES if len(word) >= n)]


def number(feature: str) -> int:
    """A stable 62-bit number of a feature."""
    import xxhash

    return xxhash.xxh64_intdigest(feature) >> 2


def swaps(lists: Sequence[Sequence[str]] = IDENTITY) -> dict[str, str]:
    return {w: ws[(i + 1) % len(ws)] for ws in lists for i, w in enumerate(ws)}


def sampled(labels: DataFrame, size: int = SAMPLE, key: str = "doc_id", label: str = "toxic") -> DataFrame:
    """At most ``size`` labelled ids, the first by hash; rows whose crc32(id) mod 4 is 2 are held out."""
    clean = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    return clean.where(~held_out("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)


def held_out(key: str):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def _extract(docs: DataFrame, lists: Sequence[Sequence[str]]) -> DataFrame:
    swap = swaps(lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain, other = [], []
            for value in batch.column(1):
                words = set(LETTERS.findall((value.as_py() or "").lower()))
                plain.append(sorted({number(f) for w in words for f in word_features(w)}))
                if any(w in swap for w in words):
                    other.append(sorted({number(f) for w in words for f in word_features(swap.get(w, w))}))
                else:
                    other.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(plain, pa.list_(pa.int64())), pa.array(other, pa.list_(pa.int64()))], ["y", "f", "g"])

    return docs.select("y", "text").mapInArrow(run, "y int, f array<bigint>, g array<bigint>")


def _sparse(rows: list, index: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    at = [(i, index[f]) for i, fs in enumerate(rows) for f in fs if f in index]
    a = np.array(at, dtype=np.int64).reshape(-1, 2)
    return a[:, 0], a[:, 1]


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, lists: Sequence[Sequence[str]] = IDENTITY, fairness: float = FAIRNESS) -> tuple[dict[int, float], float]:
    """Weights by feature number, and the bias."""
    ship(docs.sparkSession)
    chosen = sampled(labels, size)
    data = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    with settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=500):
        features = _extract(data, lists).persist()
        n, pos = features.agg(F.count("*"), F.coalesce(F.sum((F.col("y") > 0).cast("int")), F.lit(0))).first()
        if pos == 0 or pos == n:
            features.unpersist()
            p = (pos + 0.5) / (n + 1)
            return {}, math.log(p / (1 - p))
        # The features whose presence depends most on the label, by chi-square, counted where the data lie.
        a, b = F.sum((F.col("y") > 0).cast("double")), F.sum((F.col("y") <= 0).cast("double"))
        df = features.select("y", F.explode("f").alias("f")).groupBy("f").agg(a.alias("a"), b.alias("b")).where(F.col("a") + F.col("b") >= LEAST)
        e = (F.col("a") + F.col("b")) * pos / n
        best = df.orderBy(F.desc((F.col("a") - e) ** 2 / e), "f").limit(min(FEATURES, max(64, n // 4))).select("f")
        index = {r[0]: i for i, r in enumerate(best.collect())}
        kept = features.select("y", F.array_intersect("f", F.lit(list(index))).alias("f"), F.array_intersect("g", F.lit(list(index))).alias("g"))
        rows = kept.collect()
        features.unpersist()
    y = np.array([float(r["y"] > 0) for r in rows])
    pairs = [(r["f"], r["g"]) for r in rows if r["g"] is not None]
    w, bias = descend(_sparse([r["f"] for r in rows], index), y, _sparse([p[0] for p in pairs], index), _sparse([p[1] for p in pairs], index), len(pairs), len(index), fairness)
    return {f: float(w[i]) for f, i in index.items()}, bias


def descend(x: tuple, y: np.ndarray, plain: tuple, swapped: tuple, n_pairs: int, width: int, fairness: float) -> tuple[np.ndarray, float]:
    """Full-batch Adam on log loss + L2 + fairness * mean squared logit change between a text and its counterfactual."""
    theta, m, v = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    theta[-1] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for t in range(1, STEPS + 1):
        w = theta[:-1]
        z = np.bincount(x[0], w[x[1]], len(y)) + theta[-1]
        r = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)
        g = np.append(np.bincount(x[1], r[x[0]], width) + L2 * w / 100, r.sum())
        if n_pairs:
            d = (np.bincount(plain[0], w[plain[1]], n_pairs) - np.bincount(swapped[0], w[swapped[1]], n_pairs)) * 2 * fairness / n_pairs
            g[:-1] += np.bincount(plain[1], d[plain[0]], width) - np.bincount(swapped[1], d[swapped[0]], width)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def score(docs: DataFrame, weights: dict[int, float], bias: float) -> DataFrame:
    """(doc_id, score) for every row, over whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in batches:
            out = []
            for value in batch.column(1):
                found: set[int] = set()
                for word in set(LETTERS.findall((value.as_py() or "").lower())):
                    got = known.get(word)
                    if got is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        got = known[word] = tuple(k for k in map(number, word_features(word)) if k in weights)
                    if got:
                        found.update(got)
                z = bias + math.fsum(weights[k] for k in found)
                out.append(1 / (1 + math.exp(-max(-40.0, min(40.0, z)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["doc_id", "score"])

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, *fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
