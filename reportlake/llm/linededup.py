"""Cross-site boilerplate removal by the distinct-site spread of lines.

Lines (split at line feeds, compared without white space at their ends, of at least ``MIN_WORDS`` words) are
hashed; one aggregation merges, per line hash, a HyperLogLog sketch of the sites that show it, and the smallest
document id. Lines whose estimate is clearly above ``MIN_SITES`` are boilerplate, those clearly below are not;
those near the threshold get an exact distinct count. Boilerplate goes from every document but the first that
shows it, so each line stays in the corpus once.

Only (line hash, site, id) is shuffled for counting, pre-aggregated per task. The documents meet their own list
of removed line hashes by an equi-join on the id.

Null texts stay null and have no lines; empty texts stay empty; a very long text is one row, its lines are counted
like others; lines without words are never removed. A null
site counts as one site of its own. Documents without an id are never first unless no document that shows the
line has an id, when all keep it. Rows with equal ids are treated alike. A document may end empty and still
stays. An empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.llm.common import GAP_CHARS, Scratch, n_words_of, named, small, table, without

MIN_SITES = 10
MIN_WORDS = 3
#: Estimates within this share of the threshold are counted exactly; sketches of 2**12 registers err by 1.6 %.
NEAR = 0.1
LG_REGISTERS = 12
#: Up to so many boilerplate lines (16 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_LINES = 200_000


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(GAP_CHARS)))


def _own(key: Column, text: Column) -> Column:
    """A key for each text without an id, so that such rows are no group of their own; 0 for all others."""
    return F.when(key.isNull(), F.xxhash64(text)).otherwise(F.lit(0).cast("long"))


def shown_lines(docs: DataFrame, text: str, key: str, site: str) -> DataFrame:
    """(doc, own, site, line) for every line that is long enough to be compared; ``own`` tells rows without an id apart by their text."""
    lines = docs.select(named(key).alias("doc"), _own(named(key), named(text)).alias("own"), F.coalesce(named(site), F.lit("\0")).alias("site"), F.explode(F.split(named(text), "\n")).alias("l"))
    return lines.where(n_words_of(F.col("l")) >= MIN_WORDS).select("doc", "own", "site", line_hash(F.col("l")).alias("line"))


def boilerplate(lines: DataFrame, scratch: Scratch, min_sites: int = MIN_SITES) -> DataFrame:
    """(line, first) of the lines shown by at least ``min_sites`` distinct sites."""
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_REGISTERS))
    spread = lines.groupBy("line").agg(F.count("*").alias("n"), sketch.alias("sites"), F.min("doc").alias("first"))
    maybe = scratch.save(spread.where((F.col("n") >= min_sites) & (F.col("sites") >= min_sites * (1 - NEAR))), "spread")
    sure = maybe.where(F.col("sites") > min_sites * (1 + NEAR)).select("line", "first")
    near = maybe.where(F.col("sites") <= min_sites * (1 + NEAR)).select("line", "first")
    # Each task hands on a line's distinct sites, not its occurrences.
    shown = lines.join(small(near), "line").select("line", "first", "site").distinct()
    counted = shown.groupBy("line", "first").agg(F.count("*").alias("sites"))
    return scratch.save(sure.unionByName(counted.where(F.col("sites") >= min_sites).select("line", "first")), "boilerplate")


def remove_boilerplate(docs: DataFrame, text: str = "text", key: str = "doc_id", site: str = "source", min_sites: int = MIN_SITES, broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``, and long columns ``n_lines`` and ``n_removed``."""
    scratch = Scratch(docs.sparkSession, "lines")
    columns = without(docs, "n_lines", "n_removed")
    lines = scratch.save(shown_lines(docs, text, key, site), "shown")
    found = boilerplate(lines, scratch, min_sites)
    found = small(found, broadcast_lines)
    hits = lines.join(found, "line").where(~F.col("doc").eqNullSafe(F.col("first"))).groupBy("doc", "own").agg(F.collect_set("line").alias("_hits"))
    hits = scratch.save(hits, "hits")
    # Always by a shuffle of the documents: a broadcast would only fit while few of them show boilerplate. The rows
    # travel as structs, so their columns may have any names.
    rows = docs.select(named(key).alias("_key"), _own(named(key), named(text)).alias("_own"), named(text).alias("_text"), F.struct(*[named(c) for c in columns if c != text]).alias("_row"))
    joined = rows.join(hits.hint("merge"), F.col("_key").eqNullSafe(F.col("doc")) & (F.col("_own") == F.col("own")), "left")
    split = F.split(F.col("_text"), "\n")
    tested = F.transform(split, lambda x: F.struct(x.alias("l"), line_hash(x).alias("h"), (n_words_of(x) >= MIN_WORDS).alias("w")))
    kept = F.transform(F.filter(tested, lambda x: ~(x["w"] & F.array_contains("_hits", x["h"]))), lambda x: x["l"])
    joined = joined.withColumns({"n_lines": F.when(F.col("_text").isNull(), 0).otherwise(F.size(split)).cast("long"), "_kept": F.when(F.col("_hits").isNotNull(), kept)})
    joined = joined.withColumn("n_removed", F.when(F.col("_kept").isNull(), 0).otherwise(F.col("n_lines") - F.size("_kept")).cast("long"))
    left = F.when(F.col("_kept").isNull(), F.col("_text")).otherwise(F.array_join("_kept", "\n"))
    return joined.select(*[left.alias(c) if c == text else F.col("_row")[c].alias(c) for c in columns], "n_lines", "n_removed")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.char_length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


ORACLE = rf"""WITH l AS (SELECT doc_id, coalesce(source, chr(1)) AS site, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS l FROM documents),
k AS (SELECT *, regexp_replace(regexp_replace(l, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS t, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) >= {MIN_WORDS} AS w FROM l),
b AS (SELECT t, min(doc_id) AS first FROM k WHERE w GROUP BY t HAVING count(DISTINCT site) >= {MIN_SITES}),
d AS (SELECT k.*, w AND b.t IS NOT NULL AND k.doc_id <> b.first AS gone FROM k LEFT JOIN b USING (t)),
r AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text FROM d GROUP BY doc_id)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed, CAST(length(text) AS BIGINT) AS n_chars, md5(text) AS text_md5 FROM r"""
