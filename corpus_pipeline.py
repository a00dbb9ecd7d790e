"""The training-data pipeline: each stage works on all documents that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.llm import contamination, lines, near, packing, quality
from gleaner.session import stage


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression rejects go: toxic ones and those of low quality."""
    return quality.select(docs, quality.grades_of(spark.read.parquet(f"{sf_dir}/labels.parquet")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go; every document stays, and ``n_chars`` follows its text."""
    cut = lines.drop_recurring_lines(docs)
    changed = F.col("n_dropped") > 0
    return cut.select(*[F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col(c)).alias(c)
                        if c == "n_chars" else F.col(f"`{c}`") for c, kind in docs.dtypes])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest id."""
    gone = near.near_duplicates(docs).where("NOT kept").select("doc_id").distinct().hint("merge")
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go."""
    return contamination.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as token sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), end_id=2)


STAGES = [("quality", select_quality), ("line_dedup", dedup_lines), ("near_dedup", dedup_near),
          ("decontamination", decontaminate), ("packing", pack)]

#: SQL has neither the regression nor the tokenizer; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply ``STAGES`` in order to ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
