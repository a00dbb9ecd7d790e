"""Manifest of code or text files -> what is left to do -> text and word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gleaner.functions.predicates import has_suffix, lacks
from gleaner.operators.joins import join_content, todo_by_basename


def remaining_objects(listing: DataFrame, done: DataFrame, *suffixes: str, marker: str | None = None) -> DataFrame:
    """Listed objects with a suffix and without the marker whose name is not in ``done``."""
    wanted = listing.filter(has_suffix(F.col("key"), *suffixes))
    if marker:
        wanted = wanted.filter(lacks(F.col("key"), marker))
    return todo_by_basename(wanted, done, F.col("key"), F.col("key"))


def enrich_content(metadata: DataFrame, content: DataFrame, on: str = "blob_id",
                   content_unique: bool = False) -> DataFrame:
    """Each metadata row with ``text, word_count, status``."""
    return join_content(metadata, content, on, content_unique=content_unique)


def content_stats(enriched: DataFrame, group: str) -> DataFrame:
    """Files, failures and words per group."""
    return enriched.groupBy(group).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("status") != "ok").alias("missing"),
        F.sum("word_count").alias("words"))
