"""From raw documents to packed training sequences: five stages, each one of the operators of reportlake.llm.

A stage takes (spark, docs, sf_dir); its result is written as Parquet and reread as the next stage's docs. All
stages but the last return the columns of their input. Columns that an operator does not read travel in one
struct, so their names cannot clash with its own.

Nulls, empty and very long texts, ties, repeated rows and empty tables have the results that the operators'
docstrings state. In the Jaccard stage rows without an id or of one id are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.llm import jaccard, linededup, mixing, packing, quality
from reportlake.llm.common import Scratch, fresh, shuffle_partitions, table

#: DuckDB cannot express tokenisation and packing; the stages are tested against brute force.
ORACLE_SQL = None


def _carried(docs: DataFrame, *used: str) -> DataFrame:
    """The columns an operator reads, and ``_row``, a struct of all others."""
    rest = [c for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(*[F.col(c) for c in rest]).alias("_row") if rest else F.lit(None).alias("_row"))


def _back(out: DataFrame, docs: DataFrame, *used: str) -> list:
    return [F.col(c) if c in used else F.col("_row")[c].alias(c) for c in docs.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed votes of the quality rules reject go."""
    used = ("text",)
    judged = quality.judge(_carried(docs, *used)).where("kept")
    return judged.select(*_back(judged, docs, *used))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines spread over many sites go from all but the first document; n_chars follows the text."""
    used = ("doc_id", "source", "text")
    out = linededup.remove_boilerplate(_carried(docs, *used))
    columns = _back(out, docs, *used)
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("_row")["n_chars"])
        columns[docs.columns.index("n_chars")] = changed.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays; documents that are alike to none stay."""
    scratch = Scratch(spark, "near")
    if docs.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1").isEmpty():
        gone = jaccard.join(docs.select("doc_id", "text")).where("component_id <> doc_id").select("doc_id")
        return docs.join(scratch.save(gone, "gone"), "doc_id", "left_anti").select(*docs.columns)
    # Rows get numbers of their own, in the order of ids, texts and places: the ranges are in order, and so are their rows.
    place, number = fresh(docs, "_place", "_number")
    rows = scratch.save(docs.withColumn(place, F.monotonically_increasing_id()), "rows")
    by = [F.col("doc_id").asc_nulls_last(), F.col("digest"), F.col(place)]
    names = rows.select("doc_id", F.md5("text").alias("digest"), place).repartitionByRange(shuffle_partitions(spark), *by).sortWithinPartitions(*by)
    names = scratch.save(names.select(place, F.monotonically_increasing_id().alias(number)), "names")
    known = scratch.save(rows.join(names, place).select(F.col(number).alias("doc_id"), "text"), "known")
    stay = jaccard.join(known).where("component_id = doc_id").select(F.col("doc_id").alias(number))
    return rows.join(scratch.save(names.join(stay, number).select(place), "stay"), place, "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights: documents drawn, some twice, dealt to shards and shuffled there."""
    used = ("doc_id", "source", "text")
    mixed = mixing.emit(mixing.mix(_carried(docs, *used)), ["doc_id", "source", "text", "_row"])
    return mixed.select(*_back(mixed, docs, *used))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenised pieces with their sequence and their place in it."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{i}-{name}")
    return docs
