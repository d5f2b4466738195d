"""How filters interact: what each removes in every order of application, and its fair share of all removals.

Five filters fail or pass every document, whatever the others say. For each of their 32 subsets one aggregation counts
the documents that fail all of it, as sums of flag products; nothing else is taken from the corpus. Everything
follows from those counts by inclusion-exclusion: a Moebius inversion gives the survivors of any set of filters, so what
a step of an order removes is a difference of two survivors; the same signs give the documents that fail one filter only.
As a game whose worth is the number of removed documents, a subset's Harsanyi dividend is its count with a sign, and a
filter's Shapley value is the sum of its subsets' dividends, each shared equally.

Texts are read once. Rows of ids, flags and a digest of the text are written; repeats are found by an aggregation
over digests (partial results first, so a text that a third of the rows share is no hot group) and an equi-join of
narrow rows. Labels meet the same narrow rows. Counts are aggregated by part, with partial results.

A null text is empty and has no words: it fails A only, and E if an earlier text is empty. A null source and the
empty one are one part. A document without an id is no smaller than another, never fails E and has no labels;
documents of one id and text are not repeats of each other, and all have the labels of their id. Of repeated labels of an id the best holds for
either kind. Very long texts are read whole, one at a time. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.llm.common import Scratch, table, words_of

FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)
#: A document of fewer words is too short; one of which less than half the words are different repeats itself.
MIN_WORDS = 200
MIN_DISTINCT = 50
#: More capitals than this share of the characters, in hundredths.
MAX_CAPITALS = 2
SYMBOLS = r"[#$%&*|]"
#: Orders of application that put a filter at a given place behind given others, over all: 5!.
ORDERS = 120


def own_flags(text: Column) -> list[Column]:
    """Failures of A to D, which a text and its words ``_w`` decide."""
    short = F.size("_w") < MIN_WORDS
    repeats = 100 * F.size(F.array_distinct("_w")) < MIN_DISTINCT * F.size("_w")
    capitals = 100 * F.regexp_count(text, F.lit("[A-Z]")) > MAX_CAPITALS * F.char_length(text)
    return [short, repeats, capitals, text.rlike(SYMBOLS)]


def flagged(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, part, A to E): for every document which filters it fails, as 0 or 1."""
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows, flags = rows.select("*", words_of(F.col("text")).alias("_w")), own_flags(F.col("text"))
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    rows = scratch.save(rows.select("doc_id", "part", *[f.cast("long").alias(x) for f, x in zip(flags, FILTERS)], digest), "flags")
    # Only texts that are found again have an earlier one; the join is of two plain shuffles, which can be split at a hot text.
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    again = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("long")
    met = rows.join(scratch.save(first, "first").hint("merge"), "digest", "left")
    return scratch.save(met.select("doc_id", "part", *"ABCD", again.alias("E")), "flagged")


def joint_failures(rows: DataFrame, name: str, *weights: str) -> DataFrame:
    """By part, an array for each weight: of every subset of the filters, how many rows of that weight fail all of it."""

    def product(s: int, weight: str) -> Column:
        out = F.lit(1) if weight == "1" else F.col(weight)
        for k, f in enumerate(FILTERS):
            if s >> k & 1:
                out = out * F.col(f)
        return F.sum(out)

    return rows.groupBy("part").agg(*[F.array(*[product(s, w) for s in range(SETS)]).alias(f"{name}{w}") for w in weights])


def _signed(s: Column) -> Column:
    return F.when(F.bit_count(s) % 2 == 0, 1).otherwise(-1).cast("long")


def _over(test, counts: Column, share=lambda t: F.lit(1)) -> Column:
    """The sum over subsets t that pass the test, of their counts with the sign of their size, shared."""
    each = lambda acc, t: acc + F.when(test(t), _signed(t) * F.element_at(counts, t + 1) * share(t)).otherwise(0)
    return F.aggregate(F.sequence(F.lit(0), F.lit(SETS - 1)), F.lit(0).cast("long"), each)


def survivors(counts: Column) -> Column:
    """Of every subset of the filters, how many rows pass all of it: the Moebius inversion of joint failures."""
    return F.transform(F.sequence(F.lit(0), F.lit(SETS - 1)), lambda s: _over(lambda t: t.bitwiseAND(s) == t, counts))


def by_filter(value) -> Column:
    return F.array(*[value(1 << k) for k in range(len(FILTERS))])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step; counts are within the part.

    ``docs``: doc_id, text, source; ``labels``: doc_id, quality, toxic.
    """
    scratch = Scratch(docs.sparkSession, "audit")
    rows = flagged(docs, scratch)
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(*[F.coalesce(F.max((F.col(c) == 1).cast("long")), F.lit(0)).alias(c) for c in ("quality", "toxic")])
    marks = scratch.save(marks.where("quality + toxic > 0"), "marks")
    labelled = joint_failures(rows.join(marks.hint("merge"), "doc_id"), "n_", "quality", "toxic")
    counts = joint_failures(rows, "n_", "1").join(labelled, "part", "left")
    none = F.array_repeat(F.lit(0).cast("long"), SETS)
    counts = counts.select("part", F.col("n_1").alias("n"), *[F.coalesce(f"n_{c}", none).alias(c) for c in ("quality", "toxic")])
    counts = scratch.save(counts, "counts")
    has = lambda x: lambda t: t.bitwiseAND(F.lit(x)) == x
    n = F.col("n")
    # The worth of a set of filters is what it removes; a subset's dividend is its count, with the opposite sign of its survivors'.
    shapley = by_filter(lambda x: -_over(has(x), n, lambda t: (F.lit(ORDERS) / F.bit_count(t)).cast("long")))
    alone = by_filter(lambda x: -_over(has(x), n))
    # Spark evaluates each of these once a part: the orders are spread behind a written table.
    told = scratch.save(counts.select("part", "n", *[survivors(F.col(c)).alias(f"s_{c}") for c in ("n", "quality", "toxic")], shapley.alias("shapley"), alone.alias("alone")), "told")
    orders = F.explode(F.lit(["".join(p) for p in permutations(FILTERS)])).alias("filter_order")
    steps = told.select("*", orders).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    at = lambda i: F.ascii(F.substring("filter_order", i, F.lit(1))) - ord(FILTERS[0])
    before = F.aggregate(F.filter(F.sequence(F.lit(1), F.lit(len(FILTERS))), lambda i: i < F.col("step")), F.lit(0), lambda s, i: s.bitwiseOR(F.call_function("shiftleft", F.lit(1), at(i))))
    steps = steps.select("*", at(F.col("step")).alias("_k"), before.alias("_s"))
    mine = F.call_function("shiftleft", F.lit(1), F.col("_k"))
    left = lambda c, s: F.element_at(f"s_{c}", s + 1)
    gone = lambda c: left(c, F.col("_s")) - left(c, F.col("_s").bitwiseOR(mine))
    return steps.select(
        "part", "filter_order", "step",
        left("n", F.col("_s").bitwiseOR(mine)).alias("kept"), gone("n").alias("removed"), (F.element_at("n", mine + 1) - gone("n")).alias("redundant"),
        F.element_at("alone", F.col("_k") + 1).alias("unique_fails"), gone("quality").alias("good_lost"), gone("toxic").alias("toxic_lost"), F.element_at("shapley", F.col("_k") + 1).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
#: Every order is carried out on every pattern of failures, and the removals of all orders are summed.
ORACLE = rf"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_WORDS} AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
b AS (SELECT part, [len(ws) < {MIN_WORDS}, 100 * len(list_distinct(ws)) < {MIN_DISTINCT} * len(ws), 100 * len(regexp_extract_all(t, '[A-Z]')) > {MAX_CAPITALS} * length(t), regexp_matches(t, '{SYMBOLS}'), coalesce(doc_id > first, false)] AS f,
  doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS q, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS x FROM w),
p AS (SELECT part, f, count(*) AS n, count(*) FILTER (q) AS q, count(*) FILTER (x) AS x FROM b GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT u.c || v.c || w.c || y.c || z.c AS filter_order FROM l u, l v, l w, l y, l z WHERE len(list_distinct([u.c, v.c, w.c, y.c, z.c])) = 5),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, CAST(list_transform(range(1, step + 1), lambda i: ascii(filter_order[i]) - 64) AS INTEGER[]) AS ks FROM o, range(1, 6) r(step)),
r AS (SELECT part, filter_order, step, ks[-1] AS k, CAST(sum(CASE WHEN fails = 0 THEN n ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN here THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN f[ks[-1]] AND NOT here THEN n ELSE 0 END) AS BIGINT) AS redundant, CAST(sum(CASE WHEN f[ks[-1]] AND len(list_filter(f, lambda v: v)) = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN here THEN q ELSE 0 END) AS BIGINT) AS good_lost, CAST(sum(CASE WHEN here THEN x ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM (SELECT *, f[ks[-1]] AND fails = 1 AS here FROM (SELECT *, len(list_filter(ks, lambda i: f[i])) AS fails FROM p, s)) GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley FROM r"""
