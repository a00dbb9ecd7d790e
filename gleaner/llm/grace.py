"""Exact duplicates by Grace hashing: spill files until a bucket fits a table that compares whole contents."""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.hashing import texts_of

TABLE_BYTES = 64 << 20    # contents that one table holds before its bucket is partitioned again
FAN_OUT = 16              # spill files of one partitioning; four bits of the digest name the file
_HEAD = struct.Struct("<32s?qqq")
Record = tuple[bytes, bytes, "int | None", int]   # digest, content, largest id, rows


class Table:
    """Open addressing with linear probing; entries are equal only if their whole contents are."""

    def __init__(self):
        self.slots: list[int] = [-1] * 1024
        self.entries: list[list] = []
        self.size = 0

    def add(self, digest: bytes, content: bytes, top: int | None, rows: int) -> None:
        at = self._find(digest, content)
        if self.slots[at] < 0:
            self.slots[at] = len(self.entries)
            self.entries.append([digest, content, top, rows])
            self.size += len(content) + 200
            if 2 * len(self.entries) > len(self.slots):
                self._grow()
            return
        entry = self.entries[self.slots[at]]
        entry[2] = top if entry[2] is None else entry[2] if top is None else max(entry[2], top)
        entry[3] += rows

    def _find(self, digest: bytes, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[-8:], "little") & mask
        while (i := self.slots[at]) >= 0:
            entry = self.entries[i]
            if entry[0] == digest:
                if entry[1] != content:
                    raise ValueError(f"two contents with SHA-256 {digest.hex()}")
                return at
            at = (at + 1) & mask
        return at

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        for i, (digest, content, _, _) in enumerate(self.entries):
            self.slots[self._find(digest, content)] = i


def _spilled(path: str) -> Iterator[Record]:
    with open(path, "rb") as f:
        while head := f.read(_HEAD.size):
            digest, known, top, rows, size = _HEAD.unpack(head)
            yield digest, f.read(size), top if known else None, rows


def grace(records: Iterable[Record], budget: int = TABLE_BYTES, level: int = 0, folder: str | None = None
          ) -> Iterator[list]:
    """One entry per distinct content. Spill files live as long as the call, in the task's own folder."""
    table, source = Table(), iter(records)
    for record in source:
        table.add(*record)
        if table.size > budget and len(table.entries) > 1:
            break
    else:
        yield from table.entries
        return
    with tempfile.TemporaryDirectory(prefix=f"grace-{level}-", dir=folder) as own:
        paths = [os.path.join(own, str(i)) for i in range(FAN_OUT)]
        files = [open(p, "wb") for p in paths]
        try:
            for part in (table.entries, source):
                for digest, content, top, rows in part:
                    nibble = digest[level // 2] >> 4 if level % 2 else digest[level // 2] & 15
                    files[nibble].write(_HEAD.pack(digest, top is not None, top or 0, rows, len(content)))
                    files[nibble].write(content)
                table.entries = table.slots = []
        finally:
            for f in files:
                f.close()
        for path in paths:
            yield from grace(_spilled(path), budget, level + 1, own)
            os.remove(path)


def _batches(entries: Iterator[list], with_content: bool):
    def flush():
        cols = [pa.array([e[0] for e in rows], pa.binary()), pa.array([e[2] for e in rows], pa.int64()),
                pa.array([e[3] for e in rows], pa.int64())]
        names = ["digest", "top", "rows"]
        if with_content:
            cols.append(pa.array([e[1] for e in rows], pa.binary()))
            names.append("content")
        return pa.RecordBatch.from_arrays(cols, names)

    rows, size = [], 0
    for entry in entries:
        rows.append(entry)
        size += len(entry[1])
        if size > (8 << 20) or len(rows) >= 10_000:
            yield flush()
            rows, size = [], 0
    if rows:
        yield flush()


def _collapse(budget: int):
    """Copies inside a map task become one record, so a shuffle sees a content once per task at most."""
    def run(batches):
        def records():
            for batch in batches:
                for top, content in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                    yield hashlib.sha256(content).digest(), content, top, 1
        yield from _batches(grace(records(), budget), True)
    return run


def _merge(budget: int):
    def run(batches):
        def records():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("digest", "content", "top", "rows")))
        yield from _batches(grace(records(), budget), False)
    return run


def exact_duplicates(docs: DataFrame, budget: int = TABLE_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: one row per row of ``docs(doc_id, text, ...)``.

    Texts are equal when their UTF-8 bytes are; null counts as empty. The row
    with the largest ``doc_id`` of a group stays. Rows without ``doc_id`` count
    in ``group_size`` and give way to the others; a group without any
    ``doc_id`` has no ``keep_id`` and stays whole. Rows that share ``doc_id``
    and text are one and the same: all carry the same ``kept``. Other columns
    are ignored.

    Records are dealt by digest (the first partitioning is Spark's shuffle);
    a task partitions its share again into spill files until a bucket fits a
    table of ``budget`` bytes.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    partial = texts.mapInArrow(_collapse(budget), "digest binary, top bigint, rows bigint, content binary")
    groups = (partial.repartition("digest").mapInArrow(_merge(budget), "digest binary, top bigint, rows bigint")
              .select(F.lower(F.hex("digest")).alias("text_sha256"), F.col("top").alias("keep_id"),
                      F.col("rows").alias("group_size")))
    members = texts.select("doc_id", F.sha2("text", 256).alias("text_sha256"))
    return members.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
