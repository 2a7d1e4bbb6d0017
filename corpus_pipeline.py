"""A corpus from raw documents to packed sequences, stage by stage.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame, which is
written as Parquet in the shared folder and read again as the next stage's ``docs``. All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docindex.llm import decontaminate, packing, pii_crf, quality_divergence, setsketch_dedup
from docindex.llm.scratch import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the divergence from their language reject go."""
    return quality_divergence.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8) stays."""
    return setsketch_dedup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words stand in windows of test items go."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the new text."""
    return pii_crf.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2,048 tokens: one row a piece, with its ids."""
    return packing.pieces(docs)


STAGES = [("quality rules", quality_rules), ("near-duplicates", near_dedup), ("decontamination", benchmark_decontamination),
          ("personal data", personal_data), ("packing", pack)]
ORACLE_SQL = None  # estimates, a fitted model and tokenisation are beyond SQL; tests hold run() against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
