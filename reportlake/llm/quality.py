"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Everything per document is a built-in expression in one pass without a shuffle. Rules never remove a document
on their own; each votes good (+1), bad (-1) or abstains (0). The vote patterns of the whole corpus are counted
by one aggregation (at most 3 ** number of rules rows, whatever the input size), expectation-maximisation over
these counts estimates each rule's rates on good and on bad documents, and every document's posterior
probability of being good decides.

Nulls and blank texts have no words: all counts 0, ``base_failed`` true. Very long texts are judged whole, each as one
row. Repeated rows are judged each for
itself and count each in the statistics. An empty table gives an empty result. Extra columns pass through
``judge``; columns of the operator's own names are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.llm.common import GAP_CHARS, Scratch, fresh, named, table, without, words_of

WINDOW = 5
ROUNDS = 12
#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for was with as on are this an from by or "
    "der die und das den von zu mit sich ist im nicht dem ein eine als auf "
    "le la les et des est un une du que qui dans pour par au "
    "el los las y se una con no su lo es al como más de en"
).split()

#: (good, bad) conditions over the measures; a document matching neither gets no vote.
RULES: Mapping[str, tuple[str, str]] = {
    "enough_words": ("n_words >= 40", "n_words < 10"),
    "word_length": ("word_chars >= 3 * n_words AND word_chars <= 9 * n_words", "word_chars < 2 * n_words OR word_chars > 12 * n_words"),
    "few_symbols": ("50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    "symbol_share": ("200 * n_symbols <= word_chars", "25 * n_symbols > word_chars"),
    "distinct_lines": ("n_dup_lines = 0", "5 * n_dup_lines > n_lines"),
    "distinct_windows": ("50 * n_repeat_words <= n_words", "10 * n_repeat_words > n_words"),
    "lower_case": ("10 * n_upper <= word_chars", "4 * n_upper > word_chars"),
    "calm_marks": ("50 * n_shouts <= n_words", "10 * n_shouts > n_words"),
    "function_words": ("n_stop >= 2", "n_stop = 0 AND n_words >= 30"),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_shouts", "n_stop")


def _distinct_drop(a: Column) -> Column:
    return F.size(a) - F.size(F.array_distinct(a))


def _window_hashes(hashes: Column) -> Column:
    """A 64-bit hash per window of five words, in order, from the words' hashes (a column, not an expression: every window
    looks its words up)."""
    window = F.transform(hashes, lambda x, i: F.xxhash64(x, *[F.get(hashes, i + k) for k in range(1, WINDOW)]))
    return F.slice(window, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0)))


#: Up to so many different repeated windows, their places are found by membership; beyond it by sorting.
FEW = 32


def _steps(at: Column) -> Column:
    """Words covered by windows that start at the ascending positions ``at``."""
    gaps = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x)


def _repeated(grams: Column) -> Column:
    """The different hashes found at least twice."""
    s = F.sort_array(grams)
    pairs = F.zip_with(s, F.slice(s, 2, F.greatest(F.size(s), F.lit(1))), lambda a, b: F.when(a == b, a))
    return F.array_distinct(F.array_compact(pairs))


def _places_of_few(grams: Column, repeated: Column) -> Column:
    return F.array_compact(F.transform(grams, lambda g, i: F.when(F.array_contains(repeated, g), i)))


def _places_of_many(grams: Column) -> Column:
    s = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    none = F.lit(None).cast("struct<g:bigint,i:int>")
    around = F.arrays_zip(s.alias("c"), F.concat(F.array(none), s).alias("p"), F.slice(s, 2, F.greatest(F.size(s), F.lit(1))).alias("n"))
    twice = F.filter(around, lambda e: F.coalesce(e["c"]["g"] == e["p"]["g"], F.lit(False)) | F.coalesce(e["c"]["g"] == e["n"]["g"], F.lit(False)))
    return F.sort_array(F.transform(twice, lambda e: e["c"]["i"]))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds MEASURES (long) to every row, in one pass."""
    t = F.coalesce(named(text), F.lit(""))
    keep = [named(c) for c in without(docs, *MEASURES)]
    t_, w, h, l, g, r = fresh(docs, "_t", "_w", "_h", "_l", "_g", "_r")
    out = docs.select(*keep, t.alias(t_), words_of(named(text)).alias(w))
    has_word = lambda x: F.btrim(x, F.lit(GAP_CHARS)) != ""
    out = out.select(*keep, t_, w, F.filter(F.split(t_, "\n"), has_word).alias(l), F.transform(w, lambda x: F.xxhash64(x)).alias(h))
    out = out.select(*keep, t_, w, l, _window_hashes(F.col(h)).alias(g))
    nothing = F.array().cast("array<bigint>")
    out = out.select(*keep, t_, w, l, g, F.when(_distinct_drop(F.col(g)) > 0, _repeated(F.col(g))).otherwise(nothing).alias(r))
    found = lambda pattern: F.regexp_count(F.col(t_), F.lit(pattern)).cast("long")
    stop = F.array(*[F.lit(w) for w in dict.fromkeys(STOP_WORDS)])
    some = F.size(r)
    repeats = F.when(some == 0, 0).when(some <= FEW, _steps(_places_of_few(F.col(g), F.col(r)))).otherwise(_steps(_places_of_many(F.col(g))))
    out = out.select(
        *keep,
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        found(f"[{SYMBOLS}]").alias("n_symbols"),
        _distinct_drop(F.col(l)).cast("long").alias("n_dup_lines"),
        repeats.cast("long").alias("n_repeat_words"),
        F.size(l).cast("long").alias("n_lines"),
        found("[A-Z]").alias("n_upper"),
        found("!").alias("n_shouts"),
        F.size(F.array_intersect(w, stop)).cast("long").alias("n_stop"),
    )
    return out


def _votes() -> list[Column]:
    return [F.when(F.expr(good), 1).when(F.expr(bad), -1).otherwise(0).cast("tinyint").alias(f"v_{name}") for name, (good, bad) in RULES.items()]


def fit(patterns: Sequence[tuple[Sequence[int], int]], rounds: int = ROUNDS) -> tuple[list[float], list[float], float]:
    """Expectation-maximisation over counted vote patterns.

    Returns per rule the log-likelihood ratio (good against bad) of a good and of a bad vote, and the prior's
    log odds. Votes are taken as independent given the class. The start says that good documents rarely draw
    bad votes and bad documents often do; pseudo-counts of the same shape keep rules that never vote defined.
    """
    k = len(RULES)
    a, b, prior = [0.95] * k, [0.4] * k, 0.8
    patterns = sorted((tuple(v), n) for v, n in patterns)
    for _ in range(rounds):
        up, down = [math.log(x / (1 - y)) for x, y in zip(a, b)], [math.log((1 - x) / y) for x, y in zip(a, b)]
        base = math.log(prior / (1 - prior))
        good_up, good, bad_down, bad = [0.0] * k, [0.0] * k, [0.0] * k, [0.0] * k
        total = all_good = 0.0
        for votes, n in patterns:
            odds = base + sum(up[j] if v > 0 else down[j] if v < 0 else 0.0 for j, v in enumerate(votes))
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            total, all_good = total + n, all_good + n * p
            for j, v in enumerate(votes):
                if v:
                    good[j] += n * p
                    bad[j] += n * (1 - p)
                    if v > 0:
                        good_up[j] += n * p
                    else:
                        bad_down[j] += n * (1 - p)
        a = [min(0.999, max(0.6, (x + 9.5) / (y + 10))) for x, y in zip(good_up, good)]
        b = [min(0.999, max(0.02, (x + 0.8) / (y + 2))) for x, y in zip(bad_down, bad)]
        prior = min(0.99, max(0.5, (all_good + 4) / (total + 5)))
    up, down = [math.log(x / (1 - y)) for x, y in zip(a, b)], [math.log((1 - x) / y) for x, y in zip(a, b)]
    return up, down, math.log(prior / (1 - prior))


def judge(docs: DataFrame, text: str = "text", threshold: float = 0.5, keep_text: bool = True) -> DataFrame:
    """Adds MEASURES, the votes, ``base_failed``, ``p_good`` (posterior) and ``kept`` to every row of ``docs``.

    The texts are measured once: rows and measures are written to the shared folder, the pattern counts and the
    verdicts read them from there. Give only the columns that the result needs.
    """
    names = [f"v_{n}" for n in RULES]
    docs = docs.select(*[named(c) for c in without(docs, *names, "base_failed", "p_good", "kept")])
    measured = measure(docs, text)
    if not keep_text:
        measured = measured.drop(text)
    voted = Scratch(docs.sparkSession, "quality").save(measured.select("*", *_votes()), "voted")
    counted = voted.groupBy(*names).count()
    up, down, base = fit([(r[:-1], r[-1]) for r in counted.collect()])
    odds = F.lit(base)
    for name, u, d in zip(names, up, down):
        odds = odds + F.when(F.col(name) > 0, u).when(F.col(name) < 0, d).otherwise(0.0)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = voted.select("*", failed.alias("base_failed"), (1 / (1 + F.exp(-odds))).alias("p_good"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def oracle_op6() -> str:
    """The same in DuckDB, the rounds of expectation-maximisation as a chain of common table expressions."""
    names = list(RULES)
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    sql = rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT doc_id, i, list_aggregate(w[i:i+4], 'string_agg', ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) >= 5)),
d AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM d WHERE c > 1) GROUP BY doc_id),
m AS MATERIALIZED (SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines,
  CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_upper, CAST(length(t) - length(regexp_replace(t, '!', '', 'g')) AS BIGINT) AS n_shouts,
  CAST(len(list_distinct(list_filter(w, lambda x: x IN ({stop})))) AS BIGINT) AS n_stop
  FROM t JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
v AS MATERIALIZED (SELECT *, {", ".join(f"CASE WHEN {g} THEN 1 WHEN {b} THEN -1 ELSE 0 END AS v{j}" for j, (g, b) in enumerate(RULES.values()))} FROM m),
h AS MATERIALIZED (SELECT {", ".join(f"v{j}" for j in range(len(names)))}, count(*) AS n FROM v GROUP BY ALL),
p0 AS MATERIALIZED (SELECT {", ".join(f"0.95::DOUBLE AS a{j}, 0.4::DOUBLE AS b{j}" for j in range(len(names)))}, 0.8::DOUBLE AS pr)"""
    odds = "ln(pr / (1 - pr))" + "".join(f" + CASE v{j} WHEN 1 THEN ln(a{j} / (1 - b{j})) WHEN -1 THEN ln((1 - a{j}) / b{j}) ELSE 0 END" for j in range(len(names)))
    for i in range(ROUNDS):
        sql += f""",
e{i} AS MATERIALIZED (SELECT h.*, 1 / (1 + exp(-({odds}))) AS p FROM h, p{i}),
p{i + 1} AS MATERIALIZED (SELECT {", ".join(f"least(0.999, greatest(0.6, (coalesce(sum(n * p) FILTER (v{j} > 0), 0) + 9.5) / (coalesce(sum(n * p) FILTER (v{j} <> 0), 0) + 10))) AS a{j}, least(0.999, greatest(0.02, (coalesce(sum(n * (1 - p)) FILTER (v{j} < 0), 0) + 0.8) / (coalesce(sum(n * (1 - p)) FILTER (v{j} <> 0), 0) + 2))) AS b{j}" for j in range(len(names)))}, least(0.99, greatest(0.5, (coalesce(sum(n * p), 0) + 4) / (coalesce(sum(n), 0) + 5))) AS pr FROM e{i})"""
    failed = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"
    return sql + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {failed} AS base_failed, NOT {failed} AND 1 / (1 + exp(-({odds}))) >= 0.5 AS kept FROM v, p{ROUNDS}"""
