"""Preference formatting: one prompt and two masked completions for every chosen/rejected pair.

The longest common prefix of turns (equal role and text) is rendered once as the prompt. What follows in either
conversation is its completion, with the character spans of assistant content, the only ones that carry loss.

Conversations are assembled by one aggregation per side and joined on the pair id. A row is one conversation, so
a task's memory is bounded by its longest conversations.

Null roles render as ``unknown``, null texts as empty, and very long ones whole; turns tie by role and text; repeated
rows are repeated turns. Turns without a pair id belong to no conversation and give no pair. A pair that lacks a side
has an empty completion for it, and so has one whose side is a prefix of the other. ``differs`` is false for pairs whose
completions are equal: they carry no preference. Empty tables give no row; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.llm.common import table

TURN = "array<struct<turn:bigint,role:string,text:string>>"


def _assembled(turns: DataFrame, name: str) -> DataFrame:
    clean = turns.select("pair_id", F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    return clean.where("pair_id IS NOT NULL").groupBy("pair_id").agg(F.sort_array(F.collect_list("t")).alias(name))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit("\n"))), "")


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def _spans(turns: Column) -> Column:
    """[begin, end) of assistant texts in the rendered turns, by one running sum."""
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(_head(t))
        end = begin + F.length(t["text"])
        span = F.array(F.struct(begin.alias("begin"), end.alias("end")))
        return F.struct((end + 1).alias("at"), F.when(t["role"] == "assistant", F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """From turns (pair_id, turn, role, text) of either side: pair_id, n_common, differs, prompt, and for each side the completion and its loss spans."""
    none = F.array().cast(TURN)
    sides = _assembled(chosen, "_c").alias("c").join(_assembled(rejected, "_r").alias("r"), F.col("c.pair_id") == F.col("r.pair_id"), "full")
    sides = sides.select(F.coalesce("c.pair_id", "r.pair_id").alias("pair_id"), F.coalesce("_c", none).alias("_c"), F.coalesce("_r", none).alias("_r"))
    equal = F.zip_with("_c", "_r", lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)))
    first = F.array_position(equal, F.lit(False))
    common = F.when(first > 0, first - 1).otherwise(F.size("_c")).cast("int")
    sides = sides.withColumn("n_common", common)
    rest = lambda a: F.slice(a, F.col("n_common") + 1, F.greatest(F.size(a) - F.col("n_common"), F.lit(0)))
    sides = sides.select("pair_id", "n_common", F.slice("_c", 1, F.col("n_common")).alias("_p"), rest(F.col("_c")).alias("_c"), rest(F.col("_r")).alias("_r"))
    return sides.select("pair_id", F.col("n_common").cast("long").alias("n_common"), ((F.size("_c") > 0) | (F.size("_r") > 0)).alias("differs"), _render(F.col("_p")).alias("prompt"), _render(F.col("_c")).alias("chosen"), _spans(F.col("_c")).alias("chosen_spans"), _render(F.col("_r")).alias("rejected"), _spans(F.col("_r")).alias("rejected_spans"))


def random_negatives(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns from plain conversations.

    The rejected side of a conversation is the conversation with its last assistant turn answered by that of
    its neighbour (ids 2k and 2k + 1 are neighbours); without one, the turn is left out.
    """
    turns = turns.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = turns.where("role = 'assistant'").groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("m")).select("pair_id", F.col("m.turn").alias("at"), F.col("m.text").alias("reply"))
    other = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("reply").alias("other"), F.lit(True).alias("has"))
    swap = last.join(other, "pair_id", "left").select("pair_id", "at", "other", "has")
    joined = turns.join(swap, "pair_id", "left")
    there = (F.col("role") == "assistant") & (F.col("turn") == F.col("at"))
    swapped = F.coalesce(there, F.lit(False))
    rejected = joined.where(~swapped | F.col("has")).select("pair_id", "turn", "role", F.when(swapped, F.col("other")).otherwise(F.col("text")).alias("text"))
    return turns, rejected


def op9_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = format_preferences(*random_negatives(table(spark, sf_dir, "conversations")))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["begin"].cast("string"), s["end"].cast("string"))), ",")
    return out.select(F.col("pair_id").alias("conv_id"), "n_common", "differs", "prompt", "chosen", text(F.col("chosen_spans")).alias("chosen_spans"), "rejected", text(F.col("rejected_spans")).alias("rejected_spans"))


def _side(name: str) -> str:
    return f"""{name}n AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM {name})"""


def _done(name: str) -> str:
    span = "CAST(ts + length(h) AS VARCHAR) || '-' || CAST(ts + length(h) + length(text) AS VARCHAR)"
    return f"""{name}m AS (SELECT n.conv_id, i, role, text, '<|' || role || '|>' || chr(10) AS h FROM {name}n n JOIN k USING (conv_id) WHERE i > k.n),
{name}o AS (SELECT *, coalesce(sum(length(h) + length(text) + 1) OVER (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ts FROM {name}m),
{name}s AS (SELECT conv_id, string_agg(h || text || chr(10), '' ORDER BY i) AS t, string_agg({span}, ',' ORDER BY i) FILTER (role = 'assistant') AS s FROM {name}o GROUP BY conv_id)"""


ORACLE = f"""WITH c AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT conv_id, max(turn) AS ts FROM c WHERE role = 'assistant' GROUP BY conv_id),
rep AS (SELECT conv_id, ts, max(text) AS reply FROM c JOIN last USING (conv_id) WHERE role = 'assistant' AND turn = ts GROUP BY ALL),
sw AS (SELECT a.conv_id, a.ts, b.reply AS other FROM rep a LEFT JOIN rep b ON b.conv_id = xor(a.conv_id, 1)),
r AS (SELECT c.conv_id, turn, role, CASE WHEN role = 'assistant' AND turn = ts THEN other ELSE text END AS text FROM c LEFT JOIN sw USING (conv_id)
  WHERE NOT coalesce(role = 'assistant' AND turn = ts, false) OR other IS NOT NULL),
{_side("c")}, {_side("r")},
q AS (SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.i, b.i) AS i, coalesce(a.role = b.role AND a.text = b.text, false) AS same FROM cn a FULL JOIN rn b ON a.conv_id = b.conv_id AND a.i = b.i),
k AS (SELECT conv_id, coalesce(min(i) FILTER (NOT same) - 1, max(i)) AS n FROM q GROUP BY conv_id),
p AS (SELECT conv_id, string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY i) AS t FROM cn JOIN k USING (conv_id) WHERE i <= k.n GROUP BY conv_id),
{_done("c")}, {_done("r")}
SELECT k.conv_id, CAST(k.n AS BIGINT) AS n_common, coalesce(cs.t, '') <> coalesce(rs.t, '') AS differs, coalesce(p.t, '') AS prompt, coalesce(cs.t, '') AS chosen, coalesce(cs.s, '') AS chosen_spans, coalesce(rs.t, '') AS rejected, coalesce(rs.s, '') AS rejected_spans
FROM k LEFT JOIN p USING (conv_id) LEFT JOIN cs USING (conv_id) LEFT JOIN rs USING (conv_id)"""
