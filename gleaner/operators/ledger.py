"""Status ledger: an append-only event log and views over it.

Updates are appended, never written in place; the state of a key is the last
event in ``order``. The reductions combine on the map side, so a key with a
very long history costs one row per map task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gleaner.functions.retry import backoff_seconds, jitter_seconds
from gleaner.operators.aggregate import numbered_lists


def latest_status(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last event per key, all columns."""
    rest = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return last.select(*[F.col(c) if c in keys else F.col("_last")[c].alias(c) for c in log.columns])


def merge_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str],
                  names: str | None = None) -> DataFrame:
    """One change per key, with the ``changed`` field names: each field has the value that was set last.

    The array column ``names`` says which fields a change sets, to null too;
    without it a change sets the fields that are not null.
    """
    fields = [c for c in changes.columns if c not in keys and c not in order and c != names]
    when = F.struct(*order)
    sets = {f: F.array_contains(names, f) if names else F.col(f).isNotNull() for f in fields}
    # The value sits in a struct: set to null and not set stay apart.
    last = changes.groupBy(*keys).agg(*[
        F.max_by(F.struct(F.col(f).alias("v")), F.when(sets[f], when)).alias(f) for f in fields])
    changed = F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.lit(f)) for f in fields]))
    return last.select(*keys, *[F.col(f)["v"].alias(f) for f in fields], changed.alias("changed"))


def upsert_documents(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Documents after the changes: the ``changed`` fields are set, to null too, others kept, new keys added.

    Both sides hold a key once (see :func:`merge_changes`). Changes without
    ``changed`` set their fields that are not null. The result is a new
    version; write it next to the old one with :func:`save_version`.
    """
    fields = [c for c in current.columns if c not in keys]
    extra = [c for c in changes.columns if c not in keys and c not in fields and c != "changed"]
    if "changed" not in changes.columns:
        named = [F.when(F.col(f).isNotNull(), F.lit(f)) for f in fields if f in changes.columns]
        changes = changes.withColumn("changed", F.array_compact(F.array(*named)))
    new = changes.withColumnsRenamed({c: f"_new_{c}" for c in changes.columns if c not in keys})
    joined = current.join(new, list(keys), "full_outer")
    merged = [
        F.when(F.array_contains("_new_changed", f), F.col(f"_new_{f}")).otherwise(F.col(f)).alias(f)
        if f in changes.columns else F.col(f) for f in fields]
    return joined.select(*keys, *merged, *[F.col(f"_new_{f}").alias(f) for f in extra])


def save_version(df: DataFrame, root: str, version: int) -> None:
    """Write a version of the state, then the pointer to it; a version that exists is an error."""
    df.write.mode("errorifexists").parquet(f"{root}/versions/version={version:08d}")
    pointer = df.sparkSession.createDataFrame([(version,)], "version long")
    pointer.coalesce(1).write.mode("append").json(f"{root}/pointers")


def last_version(spark: SparkSession, root: str) -> int:
    """The newest version that was written completely."""
    return spark.read.schema("version long").json(f"{root}/pointers").agg(F.max("version")).first()[0]


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A version of the state, the newest one if none is named."""
    version = last_version(spark, root) if version is None else version
    return spark.read.parquet(f"{root}/versions/version={version:08d}")


def link_status_map(status: DataFrame, item: Sequence[str], link: str, *, size: int = 1000) -> DataFrame:
    """``download_status`` maps (link to status) per item, at most ``size`` links each."""
    entry = F.struct(F.col(link).alias("key"), F.col("status").alias("value"))
    lists = numbered_lists(status, item, [link], entry, size=size, out="_entries")
    return lists.withColumn("download_status", F.map_from_entries("_entries")).drop("_entries")


def start_events(items: DataFrame, ts: Column) -> DataFrame:
    """Start records for new items, to be appended to the log."""
    return items.withColumns({
        "status": F.lit("started"), "ts": ts,
        "end_time": F.lit(None).cast("timestamp"),
        "error_message": F.lit(None).cast("string")})


def open_runs(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keys that were started and have no final event since."""
    return latest_status(log, keys, order).filter(F.col("status") == "started")


def snapshot_status(files: DataFrame, snapshot: Sequence[str]) -> DataFrame:
    """Roll the latest file states up: any failure fails the snapshot, all completed completes it."""
    return files.groupBy(*snapshot).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("status") == "completed").alias("completed_files"),
        F.count_if(F.col("status") == "failed").alias("failed_files"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
    ).withColumn(
        "status",
        F.when(F.col("failed_files") > 0, "failed")
        .when(F.col("completed_files") == F.col("files"), "completed")
        .otherwise("started"))


def attempt_state(attempts: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Failures, success flag and last attempt per key; works on batches and streams."""
    return attempts.groupBy(*keys).agg(
        F.count_if(F.col("status") == "failed").alias("failures"),
        F.coalesce(F.bool_or(F.col("status") == "completed"), F.lit(False)).alias("succeeded"),
        F.max(ts).alias("last_attempt"))


def retry_decision(state: DataFrame, keys: Sequence[str], max_tries: int = 5) -> DataFrame:
    """``action`` (done, retry, failed, wait) and ``next_at`` from :func:`attempt_state`.

    Keys that failed together come back up to a second apart.
    """
    # Bounded: a key far beyond its tries gets no waiting time anyway.
    delay = (backoff_seconds(F.least(F.col("failures") - 1, F.lit(max_tries)))
             + jitter_seconds(*[F.col(k) for k in keys], F.col("failures")))
    action = (F.when(F.col("succeeded"), "done")
              .when(F.col("failures") == 0, "wait")
              .when(F.col("failures") < max_tries, "retry")
              .otherwise("failed"))
    return state.withColumns({
        "action": action,
        "next_at": F.when(action == "retry",
                          F.col("last_attempt") + F.make_dt_interval(secs=delay)),
    })


def retry_plan(attempts: DataFrame, keys: Sequence[str], max_tries: int = 5, ts: str = "ts") -> DataFrame:
    """What to do next for each key of an attempt log."""
    return retry_decision(attempt_state(attempts, keys, ts), keys, max_tries)


def orphans(objects: DataFrame, failed: DataFrame, on: str = "key") -> DataFrame:
    """Stored objects whose upload failed: the list to delete."""
    return objects.join(failed.select(on), on, "left_semi")
