"""Object listings: keys and sizes without reading the objects."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gleaner.functions.predicates import has_suffix
from gleaner.session import stage


def from_inventory(inventory: DataFrame, key: str = "key", size: str = "size", modified: str = "modified") -> DataFrame:
    """A listing from an inventory table, the source for stores of very many objects."""
    return inventory.select(F.col(key).alias("key"), F.col(size).cast("bigint").alias("size"),
                            F.col(modified).cast("timestamp").alias("modified"))


def _place(root: str):
    from pyarrow import fs

    place, base = fs.FileSystem.from_uri(root if ":/" in root else f"file://{root}")
    return place, base.rstrip("/")


def _entries(place, path: str):
    """``path, is_folder, size, modified in microseconds`` of what stands in one folder."""
    from pyarrow import fs

    if isinstance(place, fs.LocalFileSystem):
        # Read step by step, however many there are.
        with os.scandir(path) as found:
            for entry in found:
                try:
                    facts = entry.stat()
                except FileNotFoundError:
                    continue
                yield entry.path, entry.is_dir(), facts.st_size, facts.st_mtime_ns // 1000
    else:
        for info in place.get_file_info(fs.FileSelector(path)):
            if info.type in (fs.FileType.File, fs.FileType.Directory):
                yield info.path, info.type == fs.FileType.Directory, info.size, info.mtime_ns and info.mtime_ns // 1000


def _level(root: str, page: int):
    """Entries of the folders of a batch, ``page`` to an Arrow batch."""
    def run(batches):
        import pyarrow as pa

        def batch_of(rows):
            keys, folders, sizes, times = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(folders, pa.bool_()), pa.array(sizes, pa.int64()),
                 pa.array(times, pa.timestamp("us", tz="UTC"))], ["key", "is_folder", "size", "modified"])

        place, base = _place(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                rows = []
                for path, is_folder, size, modified in _entries(place, f"{base}/{folder}".rstrip("/") or "/"):
                    rows.append((path.removeprefix(base + "/"), is_folder, None if is_folder else size, modified))
                    if len(rows) >= page:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)
    return run


def list_objects(spark: SparkSession, root: str, suffix: str | None = None, *, page: int = 1000,
                 tasks: int = 10_000) -> DataFrame:
    """``key`` (relative to ``root``), ``size``, ``modified`` of every object below ``root``.

    Objects are listed, never opened; empty ones and those whose names begin
    with ``_`` or ``.`` are objects too, and names are taken as they are. The
    tree is listed level by level: the folders found on one level are dealt
    over up to ``tasks`` tasks that list the next one, the root's too, and each
    level is written to the shared folder, so the driver sees one number per
    level. Entries leave a task ``page`` at a time. On local file systems a
    folder is read step by step; the clients of object stores give one folder
    at a time, so for a store with very many objects in one folder use
    :func:`from_inventory`.
    """
    levels, folders, n = [], spark.createDataFrame([("",)], "key string"), 1
    while n:
        level = stage(folders.repartition(min(n, tasks)).mapInArrow(
            _level(root, page), "key string, is_folder boolean, size bigint, modified timestamp"), "listing")
        levels.append(level.where("NOT is_folder").select("key", "size", "modified"))
        folders = level.where("is_folder").select("key")
        n = folders.count()
    found = reduce(DataFrame.union, levels)
    return found.filter(F.col("key").endswith(suffix)) if suffix else found


def list_snapshot_files(files: DataFrame, snapshot: str | Column, key: str = "key") -> DataFrame:
    """Dataset files below ``data/<snapshot>/``."""
    name = F.lit(snapshot) if isinstance(snapshot, str) else snapshot
    return files.filter(F.col(key).startswith(F.concat(F.lit("data/"), name, F.lit("/"))))


def pending_uploads(local: DataFrame, target: DataFrame, prefix: str, suffix: str = ".zip") -> DataFrame:
    """Left-over files with their target key, where the target does not exist.

    The key keeps the relative path, so equal names in two folders stay apart.
    """
    wanted = local.filter(has_suffix(F.col("key"), suffix)).withColumn(
        "target_key", F.concat_ws("/", F.lit(prefix), F.col("key")))
    there = target.select(F.col("key").alias("target_key"))
    return wanted.join(there, "target_key", "left_anti")
