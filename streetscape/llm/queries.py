"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetscape.llm import chains, decontam, digest_cache, divergence, html, jaccard, langid, licenses, lines, lm, packing, periodic, quality


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op3_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_line_edit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(table(spark, sf_dir, "documents"))


def op7_html_consensus_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op9_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.passages(table(spark, sf_dir, "documents"))


def op5_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.periodic_runs(periodic.planted(table(spark, sf_dir, "documents"))))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_digest_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = digest_cache.token_counts(table(spark, sf_dir, "documents"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > digest_cache.TOKEN_LIMIT).alias("over_limit"))


QUERIES = {
    "op1_quality_llr": op1_quality_llr,
    "op2_language_id": op2_language_id,
    "op3_hierarchical_packing": op3_hierarchical_packing,
    "op4_simhash_decontamination": op4_simhash_decontamination,
    "op5_context_mixing": op5_context_mixing,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_html_consensus_paths": op7_html_consensus_paths,
    "op8_line_edit_dedup": op8_line_edit_dedup,
    "op9_chained_passages": op9_chained_passages,
    "op10_license_templates": op10_license_templates,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_source_divergence": op12_source_divergence,
    "op13_digest_cache": op13_digest_cache,
}

SQL: dict[str, str] = {"op12_source_divergence": divergence.SQL}
