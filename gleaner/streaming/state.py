"""Keyed state on streams: status ledger, first-seen URLs, request rates, retries.

Two ways, neither of which drops a late event. Status, first-seen and retry
state are streaming aggregations in update mode: each micro-batch writes the
keys it changed, and the last row per key counts. Rates and first-seen keys
per period keep no state: each micro-batch writes its own partial result, and
partial results are merged when they are read. Either way a micro-batch that
is run again after a failure replaces its folder, and :func:`compact` folds
what has been written into one base, so that a reader sees the newest base and
the batches after it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.operators.ledger import attempt_state, latest_status, retry_decision
from gleaner.session import path_exists
from gleaner.streaming.ingest import run_to_end

Fold = Callable[[DataFrame], DataFrame]


def _save(reduce: Fold, target: str):
    def save(batch: DataFrame, batch_id: int) -> None:
        reduce(batch).write.mode("overwrite").parquet(f"{target}/batches/batch_id={batch_id}")
    return save


def write_updates(updates: DataFrame, target: str, checkpoint: str) -> None:
    """Run the stream to its end and keep the changed rows of each micro-batch."""
    run_to_end(updates.writeStream.outputMode("update").foreachBatch(_save(lambda rows: rows, target))
               .option("checkpointLocation", checkpoint))


def write_partials(stream: DataFrame, reduce: Fold, target: str, checkpoint: str) -> None:
    """Run the stream to its end and keep ``reduce`` of each micro-batch."""
    run_to_end(stream.writeStream.foreachBatch(_save(reduce, target)).option("checkpointLocation", checkpoint))


_BASE = "upto bigint, folder string"


def _newest_base(spark: SparkSession, target: str):
    """The last micro-batch that a base holds, and the base's folder; None and None without a base."""
    if not path_exists(spark, f"{target}/pointers"):
        return None, None
    row = spark.read.schema(_BASE).json(f"{target}/pointers").agg(
        F.max("upto").alias("upto"), F.max_by("folder", "upto").alias("folder")).first()
    return row["upto"], row["folder"]


def written(spark: SparkSession, target: str) -> DataFrame:
    """The newest base and the batches after it, with ``batch_id``."""
    batches = spark.read.parquet(f"{target}/batches")
    upto, folder = _newest_base(spark, target)
    if folder is None:
        return batches
    # Equality on the folder columns: other bases and folded batches are not opened.
    base = spark.read.parquet(f"{target}/bases").filter((F.col("upto") == upto) & (F.col("folder") == folder)).drop("upto", "folder")
    return base.unionByName(batches.filter(F.col("batch_id") > upto))


def compact(spark: SparkSession, target: str, fold: Fold) -> None:
    """Fold all that is written into a new base; older bases and folded batches may be removed then.

    The base is written under a name of its own and counts from the moment its pointer is there, so a run that was
    ended in between leaves a folder that nobody reads, and the next run writes another one.
    """
    last = spark.read.parquet(f"{target}/batches").agg(F.max("batch_id")).first()[0]
    upto, _ = _newest_base(spark, target)
    if upto is not None and upto >= last:
        return
    rows = written(spark, target).filter(F.col("batch_id") <= last)
    folder = f"base-{uuid.uuid4().hex}"
    fold(rows).withColumn("batch_id", F.lit(last)).write.parquet(f"{target}/bases/upto={last}/folder={folder}")
    spark.createDataFrame([(last, folder)], _BASE).coalesce(1).write.mode("append").json(f"{target}/pointers")


def newest(keys: Sequence[str]) -> Fold:
    """Of updates: the last row per key."""
    return lambda rows: latest_status(rows, keys, ["batch_id"]).drop("batch_id")


def current(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """The newest row per key over all micro-batches of :func:`write_updates`."""
    return newest(keys)(written(spark, target))


def status_updates(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest event per key, live."""
    return latest_status(events, keys, order)


def first_seen_updates(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First event per key over the whole history, live."""
    return events.groupBy(*keys).agg(F.min(F.struct(*order)).alias("first"))


def first_seen_partials(keys: Sequence[str], order: Sequence[str], horizon: str, ts: str = "ts") -> Fold:
    """First event per key in each period of ``horizon`` (``"1 day"``), for :func:`write_partials`."""
    return lambda events: (events.groupBy(*keys, F.window(ts, horizon).alias("period"))
                           .agg(F.min(F.struct(*order)).alias("first")))


def first_seen(keys: Sequence[str]) -> Fold:
    """Partial results of :func:`first_seen_partials` as one."""
    return lambda rows: rows.groupBy(*keys, "period").agg(F.min("first").alias("first"))


def rate_partials(seconds: int = 60, ts: str = "ts") -> Fold:
    """Requests per tumbling window, for :func:`write_partials`."""
    return lambda requests: (requests.groupBy(F.window(ts, f"{seconds} seconds").alias("w"))
                             .agg(F.count(F.lit(1)).alias("requests"))
                             .select(F.col("w.start").alias("window_start"), "requests"))


def rates(rows: DataFrame) -> DataFrame:
    """Partial results of :func:`rate_partials` as one."""
    return rows.groupBy("window_start").agg(F.sum("requests").alias("requests"))


def over_budget(counted: DataFrame, limit: int = 30) -> DataFrame:
    """Whether a window has more requests than ``limit``."""
    return counted.withColumn("over_budget", F.col("requests") > limit)


def retry_updates(attempts: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Failures, success and last attempt per key, live."""
    return attempt_state(attempts, keys, ts)


def retry_schedule(spark: SparkSession, target: str, keys: Sequence[str], max_tries: int = 5) -> DataFrame:
    """Next action and time per key from the state written by :func:`retry_updates`."""
    return retry_decision(current(spark, target, keys), keys, max_tries)


def due(schedule: DataFrame, now) -> DataFrame:
    """Keys whose waiting time is over."""
    return schedule.filter((F.col("action") == "retry") & (F.col("next_at") <= now))
