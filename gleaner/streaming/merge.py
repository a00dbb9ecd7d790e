"""A stream of changes merged into documents, each micro-batch exactly once."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.operators.ledger import merge_changes, upsert_documents
from gleaner.session import path_exists
from gleaner.streaming.ingest import run_to_end

_POINTER = "version bigint, stream string, batch bigint, folder string"


def _pointers(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, f"{root}/pointers"):
        return spark.createDataFrame([], _POINTER)
    return spark.read.schema(_POINTER).json(f"{root}/pointers")


def _last(spark: SparkSession, root: str, stream: str):
    """Newest version, its folder, and the last micro-batch of ``stream`` that is in it."""
    row = _pointers(spark, root).agg(
        F.max("version").alias("version"), F.max_by("folder", "version").alias("folder"),
        F.max(F.when(F.col("stream") == stream, F.col("batch"))).alias("batch")).first()
    return row["version"] or 0, row["folder"], -1 if row["batch"] is None else row["batch"]


def merged_documents(spark: SparkSession, root: str) -> DataFrame:
    """The newest version whose pointer was written; folders without a pointer are left over from a crash."""
    return spark.read.parquet(f"{root}/versions/{_last(spark, root, '')[1]}")


def merge_batch(documents: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Documents after a batch of changes: per field the value set last.

    A change that is older, by ``order``, than the last one a document has is left out, so batches may come in any
    order. ``documents`` and the result hold the columns of ``changes``; ``order`` is that of the last change. Null keys
    are left out: they name no document.
    """
    named = changes.dropna(subset=list(keys))
    last = named.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_at"))
    # What a document already has newer changes than.
    had = documents.select(*[F.col(k) for k in keys], F.struct(*order).alias("_had"))
    fresh = (named.join(had, list(keys), "left").where(F.col("_had").isNull() | (F.struct(*order) > F.col("_had")))
             .select(*changes.columns))
    fields = [c for c in changes.columns if c not in keys]
    set_ = merge_changes(fresh, keys, order).join(last, list(keys)).select(
        *keys, *[F.col(f"_at.{c}").alias(c) if c in order else F.col(c) for c in fields],
        F.concat("changed", F.array(*map(F.lit, order))).alias("changed"))
    return upsert_documents(documents.select(*keys, *fields), set_, keys).select(*changes.columns)


def _save(root: str, stream: str, keys: Sequence[str], order: Sequence[str]):
    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version, folder, done = _last(spark, root, stream)
        if batch_id <= done:
            return
        documents = spark.read.parquet(f"{root}/versions/{folder}") if folder else batch.limit(0)
        # A name of its own: what a crash has left under another one is never read.
        name = f"{version + 1:08d}-{uuid.uuid4().hex}"
        merge_batch(documents, batch, keys, order).write.parquet(f"{root}/versions/{name}")
        (spark.createDataFrame([(version + 1, stream, batch_id, name)], _POINTER).coalesce(1)
         .write.mode("append").json(f"{root}/pointers"))
    return save


def merge_stream(changes: DataFrame, root: str, checkpoint: str, keys: Sequence[str], order: Sequence[str],
                 stream: str = "changes") -> None:
    """Work off a stream of changes into the documents below ``root``.

    Each micro-batch writes a new version, then the pointer to it with its own number. A batch that is run again after
    a crash finds its number in the pointer and does nothing, or finds none and writes the version anew: it is applied
    exactly once. ``stream`` names the numbers of a checkpoint; one stream at a time writes to a root.
    """
    run_to_end(changes.writeStream.foreachBatch(_save(root, stream, keys, order)).option("checkpointLocation", checkpoint))
