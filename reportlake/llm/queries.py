"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reportlake.llm import capjoin, interaction, jaccard, langid, linededup, merkle, mixing, packing, preference, quality, suffix, toxicity, warc


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of corpus_pipeline.py over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_cap_filters": capjoin.op2_cap_filters,
        "op3_packing": packing.op3_packing,
        "op4_jaccard_join": jaccard.op4_jaccard_join,
        "op5_suffix_dedup": suffix.op5_suffix_dedup,
        "op6_quality_rules": quality.op6_quality_rules,
        "op7_mixing": mixing.op7_mixing,
        "op8_line_dedup": linededup.op8_line_dedup,
        "op9_preference": preference.op9_preference,
        "op10_warc": warc.op10_warc,
        "op11_merkle_manifest": merkle.op11_merkle_manifest,
        "op12_filter_audit": interaction.op12_filter_audit,
        "op13_language_id": langid.op13_language_id,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_cap_filters": capjoin.ORACLE,
        "op4_jaccard_join": jaccard.ORACLE,
        "op5_suffix_dedup": suffix.ORACLE,
        "op6_quality_rules": quality.oracle_op6(),
        "op8_line_dedup": linededup.ORACLE,
        "op9_preference": preference.ORACLE,
        "op10_warc": warc.ORACLE,
        "op11_merkle_manifest": merkle.oracle_op11(),
        "op12_filter_audit": interaction.ORACLE,
    }
