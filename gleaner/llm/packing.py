"""Packing token sequences: large-item matching over the counts of lengths, then best fit."""

from __future__ import annotations

import base64
import bisect
import json
import os
import re
import zlib
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gleaner.llm.hashing import texts_of
from gleaner.session import stage

CAPACITY = 1024
LONGEST = 50_000          # characters of one kind in a row that go through the ranks; longer runs go through tokenizers
_encoders: dict[str, object] = {}


def _added(path: str) -> list[dict]:
    """Added tokens of the ``.json`` file beside a ``.tiktoken`` one; rank files do not list them."""
    try:
        with open(path.removesuffix(".tiktoken") + ".json", encoding="utf-8") as f:
            return json.load(f)["added_tokens"]
    except FileNotFoundError:
        return []


_RUNS = re.compile(r"\s+|[^\W\d_]+|\d+|(?:[^\w\s]|_)+")


def _has_long_run(text: str) -> bool:
    """A run on which the ranks' pattern would run out of stack, or merge in quadratic time."""
    return len(text) > LONGEST and any(m.end() - m.start() > LONGEST for m in _RUNS.finditer(text))


def encoder(path: str):
    """Ids of text by the vocabulary at ``path`` (``.tiktoken`` ranks, or a ``.json`` of ``tokenizers``).

    Both files of a byte-level vocabulary give the same ids, those of
    ``tokenizers`` as it is loaded: an added token that a text holds literally is
    that token. Ranks are four times as fast; texts with more than ``LONGEST``
    blanks, line breaks, letters, digits or marks in a row go through
    ``tokenizers``, which takes runs of any length, if its file is there.
    """
    if path not in _encoders:
        added = [] if path.endswith(".json") else _added(path)
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            _encoders[path] = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        elif any(t[x] for t in added for x in ("single_word", "lstrip", "rstrip", "normalized")):
            _encoders[path] = encoder(path.removesuffix(".tiktoken") + ".json")
        else:
            import public_tokenizers
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            ready = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={t["content"]: t["id"] for t in added})
            ranked = lambda text: ready.encode(text, allowed_special="all")
            whole = path.removesuffix(".tiktoken") + ".json"
            if os.path.exists(whole):
                _encoders[path] = lambda text: (encoder(whole) if _has_long_run(text) else ranked)(text)
            else:
                _encoders[path] = ranked
    return _encoders[path]


def cuts(total: int, capacity: int) -> list[tuple[int, int]]:
    """``start, length`` of each piece; only a longer text is cut, and then the first piece has the rest."""
    first = total if total <= capacity else total % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, total, capacity)]


def _tokenise(path: str, end_id: int, capacity: int):
    def run(batches):
        encode = encoder(path)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                ids = np.array(encode(text.decode()) + [end_id], dtype="<u4")
                for piece, (start, length) in enumerate(cuts(len(ids), capacity)):
                    rows.append((doc, piece, start, length, zlib.crc32(ids[start:start + length].tobytes())))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Slots ``(length, first rank, items, first sequence, offset)`` for ``counts[length]`` items of each length.

    Items above a third of the capacity come first, the longest first, each
    with the longest partner that fits: at most two to a sequence. Smaller
    ones follow, the longest first, each into the least gap that takes it.
    Equal items are placed together, so the work depends on the number of
    different lengths, not on the number of items.
    """
    left, rank = {k: v for k, v in counts.items() if v}, dict.fromkeys(counts, 0)
    slots: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}     # gap: ranges of sequences (first, number)
    order: list[int] = []                           # gaps that have sequences, ascending
    opened = 0

    def give(gap: int, first: int, number: int) -> None:
        if gap and number:
            if not gaps.get(gap):
                gaps[gap] = []
                bisect.insort(order, gap)
            gaps[gap].append((first, number))

    def put(length: int, number: int, first: int, offset: int) -> None:
        slots.append((length, rank[length], number, first, offset))
        rank[length] += number
        left[length] -= number

    large = sorted((k for k in left if 3 * k > capacity), reverse=True)
    for length in large:
        while left[length]:
            fits = [m for m in large if m <= capacity - length and left[m] - (m == length) > 0]
            partner = fits[0] if fits else None
            number = (left[length] if partner is None else left[length] // 2 if partner == length
                      else min(left[length], left[partner]))
            put(length, number, opened, 0)
            if partner is not None:
                put(partner, number, opened, length)
            give(capacity - length - (partner or 0), opened, number)
            opened += number

    def fill(length: int, gap: int, first: int, number: int) -> None:
        """Put items into ``number`` sequences with the same gap, as many into each as it takes."""
        each = gap // length
        full, rest = divmod(left[length], each)
        full = min(full, number)
        for k in range(each if full else 0):
            put(length, full, first, capacity - gap + k * length)
        give(gap - each * length, first, full)
        if full < number and left[length] and rest:
            for k in range(rest):
                put(length, 1, first + full, capacity - gap + k * length)
            give(gap - rest * length, first + full, 1)
            full += 1
        give(gap, first + full, number - full)

    for length in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(order, length)
            if at < len(order):
                gap = order[at]
                first, number = gaps[gap].pop()
                if not gaps[gap]:
                    order.pop(at)
            else:
                gap, first, number = capacity, opened, -(-left[length] // (capacity // length))
                opened += number
            fill(length, gap, first, number)
    return slots


def _place(slots):
    table = np.array(sorted(slots), dtype=np.int64).reshape(-1, 5)
    starts = (table[:, 0] << 44) + table[:, 1]

    def run(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(starts, (length << 44) + rank, side="right") - 1
            found = table[at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(found[:, 3] + rank - found[:, 1]), pa.array(found[:, 4])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of ``docs(doc_id, text, ...)`` and their places in sequences of at most ``capacity`` tokens.

    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. A row of
    ``docs`` is its ids followed by ``end_id``; null and empty texts are
    ``end_id`` alone. Rows that share a ``doc_id``, or have none, are packed
    each for itself. Other columns are ignored.

    Only the number of items of each length (at most ``capacity`` figures)
    reaches the driver, which plans from it; items of a length are numbered
    in slices, as many as the root of their number, so that a frequent length
    is never one task.
    """
    pieces = stage(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
                   .mapInArrow(_tokenise(vocabulary, end_id, capacity),
                               "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
                   .withColumn("uid", F.monotonically_increasing_id()), "packing-pieces")
    slices = max(1, int(pieces.count() ** 0.5))
    dealt = pieces.withColumn("slice", F.pmod(F.xxhash64("uid"), F.lit(slices)))
    counts = stage(dealt.groupBy("length", "slice").agg(F.count("*").alias("items")), "packing-counts")
    totals = {r["length"]: r["items"] for r in counts.groupBy("length").agg(F.sum("items").alias("items")).collect()}
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "slice", F.coalesce(F.sum("items").over(before), F.lit(0)).alias("first"))
    ranked = (dealt.withColumn("place", F.row_number().over(Window.partitionBy("length", "slice").orderBy("uid")))
              .join(first, ["length", "slice"])
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("first") + F.col("place") - 1).alias("rank")))
    return ranked.mapInArrow(_place(plan(totals, capacity)),
                             "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
                             "sequence_id bigint, offset bigint")
