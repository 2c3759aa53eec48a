"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, fingerprint, linecrf, neardup, periodic, phrases, pitmanyor, quality, secrets, sharding, sitetree, toxicity
from .common import table


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.document_fingerprints(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placements(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitetree.extracted(table(spark, sf_dir, "pages"))


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitmanyor.language_model_scores(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "first")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_report(table(spark, sf_dir, "documents"))


def op12_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linecrf.line_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_fingerprint": op1_fingerprint,
        "op2_sharding": op2_sharding,
        "op3_decontaminate": op3_decontaminate,
        "op4_site_style_tree": op4_site_style_tree,
        "op5_pitman_yor": op5_pitman_yor,
        "op6_toxicity": op6_toxicity,
        "op7_quality": op7_quality,
        "op8_neardup": op8_neardup,
        "op9_secrets": op9_secrets,
        "op10_bpe": op10_bpe,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_line_crf": op12_line_crf,
        "op13_phrases": op13_phrases,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_decontaminate": decontaminate.ORACLE_SQL,
        "op13_phrases": phrases.ORACLE_SQL,
    }
