"""The corpus pipeline: language ID, line dedup, near-duplicate documents, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next one's docs. All but the last return the columns of docs, whatever other columns those have. Each works on all
that its predecessor kept.

Defined cases: a null text or one without letters is of no language and goes in the first stage; rows without a doc_id are
kept by the stages that compare documents; repeated rows of one id stand or fall together, but a near-duplicate
stage keeps one of them; empty tables pass through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetscape.llm import decontam, jaccard, langid, lines, packing
from streetscape.llm.queries import table
from streetscape.session import checkpoint_root, configure


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which a language is recognised (learned from the labelled ones among them)."""
    configure(spark)
    model = langid.fit(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")))
    return langid.keep_recognised(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that are near a line before them."""
    configure(spark)
    return lines.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the least doc_id."""
    configure(spark)
    return jaccard.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no item of the benchmark."""
    configure(spark)
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed sequences of what is left, a row for each piece."""
    configure(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing_stage),
]

#: The stages' models and fingerprints aren't SQL; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    root = f"{checkpoint_root(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
