"""Keys that more than one document has: blocks of documents meet at shards of keys and hear which repeat.

A third of all documents may have one key. A block sends a key once, however
many of its documents have it, so a shard gets a key once per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BLOCK_BYTES = 6 << 20         # text of the documents that are looked at together
KEY_BYTES = 30 << 20          # text whose keys meet in one task
KEY_BITS = 47                 # of a key; with a flag it is sent as six bytes
LAST = (1 << 63) - 1          # stands for a null id, after all others
_U = np.uint64


def text_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: the id as bigint and the UTF-8 bytes, null as empty."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"))


def deal(rows: DataFrame, total: int) -> DataFrame:
    """``id, th, text, block`` of ``text_rows``: blocks of about ``BLOCK_BYTES`` of ``total`` bytes."""
    return (rows.select(F.coalesce("doc_id", F.lit(LAST)).alias("id"), F.xxhash64("text").alias("th"), "text")
            .withColumn("block", F.pmod(F.xxhash64("id", "th"), F.lit(1 + total // BLOCK_BYTES))))


def rows_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Ids, text keys and texts of a block in an order that does not depend on how rows arrived."""
    ids, keys = (table[c].to_numpy() for c in ("id", "th"))
    order = np.lexsort((keys, ids))
    texts = table["text"].to_pylist()
    return ids[order], keys[order], [texts[i] for i in order]


def repeated_keys(dealt: DataFrame, total: int, keys_of, hot: int | None = None, weighted: bool = False) -> DataFrame:
    """``block, keys``: the keys of each block that more than one row has, as packed integers of ``KEY_BITS``.

    ``keys_of(texts)`` yields ``text number, keys``. Keys that agree by
    accident cost a look, and nothing else, where the keys are used.

    With ``hot``, it yields ``text number, keys, contents``, and a column ``hot``
    has those of the keys that stand with more than ``hot`` different contents,
    counted by block and added up, the same ones in every block. ``weighted``: the third is not contents but a weight
    of each key, and these are added up.
    """
    shards, more = 1 + total // KEY_BYTES, hot is not None
    return (dealt.groupBy("block").applyInArrow(_send(shards, keys_of, more, weighted), "shard bigint, block bigint, keys binary"
                                                + ", contents binary" * more)
            .groupBy("shard").applyInArrow(_repeated(hot), "block bigint, keys binary" + ", hot binary" * more))


def short(hashes: np.ndarray) -> np.ndarray:
    return hashes >> _U(64 - KEY_BITS)


def pack(values: np.ndarray) -> bytes:
    """Differences of neighbouring integers, compressed."""
    return pa.compress(np.diff(values.astype(np.int64), prepend=0).tobytes(), codec="zstd", asbytes=True)


def unpack(parts: list[bytes], lengths: list[int]) -> np.ndarray:
    """What ``pack`` made of several arrays, end to end."""
    return np.concatenate([np.empty(0, np.int64)] + [np.cumsum(np.frombuffer(pa.decompress(
        x, 8 * n, codec="zstd", asbytes=True), np.int64)) for x, n in zip(parts, lengths)])


def unpacked(table: pa.Table, column: str = "keys") -> np.ndarray:
    """The keys of a block in order."""
    return np.sort(np.concatenate([np.empty(0, _U)] + [np.frombuffer(x, _U) for x in table[column].to_pylist()]))


def among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places of ``keys`` that are in the sorted ``known``."""
    if not len(known):
        return np.empty(0, dtype=np.int64)
    at = np.searchsorted(known, keys)
    at[at == len(known)] = 0
    return np.flatnonzero(known[at] == keys)


def _send(shards: int, keys_of, more: bool, weighted: bool):
    """The different keys of a block by shard; the lowest bit says that two of its documents have one.

    ``contents`` has the number of different contents of each, or the sum of its weights.
    """
    def run(key, table):
        _, _, texts = rows_of(table)
        found = [(short(k), *c) for _, k, *c in keys_of(texts)]
        if not found:
            return pa.table({"shard": pa.array([], pa.int64()), "block": pa.array([], pa.int64()),
                             "keys": pa.array([], pa.binary())} | ({"contents": pa.array([], pa.binary())} if more else {}))
        every, docs = np.unique(np.concatenate([np.unique(k) for k, *_ in found]), return_counts=True)
        shard = (every >> _U(20)) % _U(shards)
        order = np.argsort(shard, kind="stable")
        packed, shard = (every[order] << _U(1)) | (docs[order] > 1), shard[order]
        packed = packed.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        names, at = np.unique(shard, return_index=True)
        out = {"shard": pa.array(names.astype(np.int64)), "block": pa.array(np.full(len(names), key[0].as_py())),
               "keys": pa.array([x.tobytes() for x in np.split(packed, at[1:])], pa.binary())}
        if more:
            keys, contents = map(np.concatenate, zip(*found))
            if weighted:
                number = np.bincount(np.searchsorted(every, keys), contents, len(every))[order]
            else:
                _, one = np.unique(contents, return_index=True)
                number = np.bincount(np.searchsorted(every, keys[one]), minlength=len(every))[order]
            out["contents"] = pa.array([pa.compress(x.astype("<u4").tobytes(), codec="zstd", asbytes=True)
                                        for x in np.split(number, at[1:])], pa.binary())
        return pa.table(out)
    return run


def _repeated(hot: int | None):
    """Keys of a shard that more than one row has, sent back to the blocks that have them."""
    def run(key, table):
        blocks = table["block"].to_numpy()
        parts = [np.frombuffer(x, dtype=np.uint8).reshape(-1, 6) for x in table["keys"].to_pylist()]
        block = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        keys = np.zeros((len(block), 8), dtype=np.uint8)
        keys[:, :6] = np.concatenate(parts)
        keys = keys.view("<u8").reshape(-1)
        order = np.argsort(keys >> _U(1), kind="stable")
        value = keys[order] >> _U(1)
        twin = value[1:] == value[:-1]
        again = (keys[order] & _U(1)).astype(bool)
        again[1:] |= twin
        again[:-1] |= twin
        keep = np.sort(order[again])
        names, at = np.unique(block[keep], return_index=True)
        back = lambda rows: pa.array([x.tobytes() for x in rows][:len(names)], pa.binary())
        out = {"block": pa.array(blocks[names]), "keys": back(np.split(keys[keep] >> _U(1), at[1:]))}
        if hot is not None:
            number = np.concatenate([np.frombuffer(pa.decompress(x, 4 * len(p), codec="zstd", asbytes=True), "<u4")
                                     for p, x in zip(parts, table["contents"].to_pylist())])
            new = np.flatnonzero(np.concatenate(([True], ~twin)))
            lots = np.empty(len(block), dtype=bool)
            lots[order] = np.repeat(np.add.reduceat(number[order].astype(np.int64), new) > hot,
                                    np.diff(new, append=len(block)))
            out["hot"] = back([(keys[own] >> _U(1))[lots[own]] for own in np.split(keep, at[1:])])
        return pa.table(out)
    return run
