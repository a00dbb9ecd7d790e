"""Copies of large datasets: what is left, in chunks or byte ranges, and how far it came."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gleaner.operators.joins import byte_ranges, resume_plan, todo_by_basename, todo_by_key
from gleaner.operators.ledger import latest_status, orphans, snapshot_status
from gleaner.operators.numbering import work_chunks
from gleaner.sources.listings import list_snapshot_files


def copy_plan(files: DataFrame, target: DataFrame, snapshot: str, chunks: int) -> DataFrame:
    """Files of a snapshot that the target lacks, in key order cut into even ``chunks``.

    ``files`` and ``target`` are listings with ``key``.
    """
    return work_chunks(todo_by_key(list_snapshot_files(files, snapshot), target), ["key"], chunks)


def copy_status(log: DataFrame, order: Sequence[str], snapshot: str = "snapshot", key: str = "key") -> DataFrame:
    """Status per snapshot from the log of its files: one state per file, the last one."""
    last = latest_status(log, [snapshot, key], order)
    timed = last.withColumns({"start_time": F.col(order[0]), "end_time": F.col(order[0])})
    return snapshot_status(timed, [snapshot])


def copy_leftovers(objects: DataFrame, log: DataFrame, order: Sequence[str], snapshot: str = "snapshot",
                   key: str = "key") -> DataFrame:
    """Stored objects whose last state is a failure: what a new run deletes first."""
    last = latest_status(log, [snapshot, key], order)
    return orphans(objects, last.filter(F.col("status") == "failed").select(key).distinct(), key)


def manifest_ranges(manifest: DataFrame, listing: DataFrame, done: DataFrame, target: DataFrame,
                    step: int = 1 << 20) -> DataFrame:
    """Byte ranges still to fetch for the keys of a manifest.

    ``manifest`` and ``done`` hold ``key``: names that are done anywhere are
    left out. ``listing`` and ``target`` hold ``key, size``.
    """
    todo = todo_by_basename(manifest.select("key").distinct(), done, F.col("key"), F.col("key"))
    return byte_ranges(resume_plan(listing.join(todo, "key", "left_semi"), target), step)
