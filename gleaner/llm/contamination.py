"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.hashing import folded, ngrams, tokens

N = 3                     # words of a seed
BLOCK_BYTES = 4 << 20     # benchmark text searched in one pass over the documents
LEAST = 0.5               # share of an item's information that an alignment must recover


def _grams(h: np.ndarray) -> np.ndarray:
    return ngrams(h, N)


@dataclass
class Items:
    """A block of the benchmark: per item its id, word hashes and the weight of each word; seeds sorted by hash."""

    ids: list
    words: list[np.ndarray]
    weights: list[np.ndarray]
    seeds: np.ndarray
    seed_item: np.ndarray
    seed_at: np.ndarray


def _count(wanted: np.ndarray):
    """Documents that hold each wanted word, summed within a batch."""
    def run(batches):
        for batch in batches:
            found = [np.zeros(0, dtype=np.int64)]
            for h in tokens(folded(batch.column(0))):
                x = np.unique(h)
                at = np.searchsorted(wanted, x)
                at[at == len(wanted)] = 0
                found.append(at[wanted[at] == x])
            keys, docs = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(docs.astype(np.int64))], ["key", "docs"])
    return run


def prepare(rows: list[tuple[int, bytes]], docs: DataFrame) -> Items:
    """Seeds and weights of a block of items; weights from counts over all documents.

    Every n-gram of an item is a seed, however many documents hold it: which of
    them an edited copy keeps is not known beforehand.
    """
    hashes = list(tokens([t for _, t in rows]))
    rows, hashes = zip(*[(r, h) for r, h in zip(rows, hashes) if len(h) >= N]) or ((), ())
    wanted = np.unique(np.concatenate(hashes))
    counted = (docs.select("text").mapInArrow(_count(wanted), "key bigint, docs bigint")
               .groupBy("key").agg(F.sum("docs").alias("docs")).toArrow())
    held = np.zeros(len(wanted), dtype=np.int64)
    held[counted["key"].to_numpy()] = counted["docs"].to_numpy()
    most = max(int(held.max()), 1) + 1
    weights = [np.log2(most / (held[np.searchsorted(wanted, h)] + 1)) + 1 for h in hashes]
    seeds = np.concatenate([_grams(h) for h in hashes])
    item = np.repeat(np.arange(len(hashes)), [len(h) - N + 1 for h in hashes])
    at = np.concatenate([np.arange(len(h) - N + 1) for h in hashes])
    order = np.argsort(seeds, kind="stable")
    return Items([r[0] for r in rows], list(hashes), weights, seeds[order], item[order], at[order])


def align(item: np.ndarray, weight: np.ndarray, passage: np.ndarray) -> tuple[float, int]:
    """Best local alignment and its end: a matched word scores its weight, others cost half the mean weight."""
    cost = float(weight.mean()) / 2
    steps = cost * np.arange(len(passage) + 1)
    above, best, end = np.zeros(len(passage) + 1), 0.0, 0
    for word, w in zip(item, weight):
        row = np.maximum(above - cost, 0.0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(passage == word, w, -cost))
        above = np.maximum.accumulate(row + steps) - steps
        top = int(above.argmax())
        if above[top] > best:
            best, end = float(above[top]), top
    return best, end


def _finder(items: Items, least: float):
    """``item number, score, end`` of each item that a text holds a copy of.

    A word that is not matched costs half the mean weight, so an alignment that
    recovers ``least`` of the total skips at most ``2 * (1 - least)`` words per word of
    the item; a passage reaches that far from its seed to both sides.
    """
    totals = [float(w.sum()) for w in items.weights]
    slack = [int(2 * max(1 - least, 0) * len(h)) + 1 for h in items.words]

    def hits(h: np.ndarray) -> dict[int, list[int]]:
        """First words of passages, by the diagonals of seeds, of each item that a text shares a seed with."""
        g = _grams(h)
        low, high = np.searchsorted(items.seeds, g, "left"), np.searchsorted(items.seeds, g, "right")
        places = np.flatnonzero(high > low)
        if not len(places):
            return {}
        n = high[places] - low[places]
        seed = np.repeat(low[places], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(places, n) - items.seed_at[seed]
        found: dict[int, list[int]] = {}
        for k, s in sorted(set(zip(items.seed_item[seed].tolist(), start.tolist()))):
            found.setdefault(k, []).append(s)
        return found

    def find(h: np.ndarray):
        for k, starts in hits(h).items():
            word, weight, at, best = items.words[k], items.weights[k], 0, (0.0, 0)
            near = slack[k]
            while at < len(starts):                 # windows of neighbouring diagonals become one
                low = max(starts[at] - near, 0)
                high = starts[at] + len(word) + near
                while at < len(starts) and starts[at] - near <= high:
                    high = starts[at] + len(word) + near
                    at += 1
                passage = h[low:high]
                if weight[np.isin(word, passage)].sum() >= least * totals[k]:
                    score, end = align(word, weight, passage)
                    best = max(best, (score, low + end))
            if best[0] >= least * totals[k]:
                yield k, best[0] / totals[k], best[1]
    return find


def _search(items: Items, least: float):
    def run(batches):
        find = _finder(items, least)
        for batch in batches:
            rows = [(doc, items.ids[k], score, end)
                    for doc, h in zip(batch.column(0).to_pylist(), tokens(folded(batch.column(1))))
                    for k, score, end in find(h)]
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int64()))],
                ["doc_id", "item_id", "score", "end_word"])
    return run


def _without(items: Items, least: float):
    def run(batches):
        find = _finder(items, least)
        for batch in batches:
            clean = [next(find(h), None) is None for h in tokens(folded(batch.column("text")))]
            yield batch.filter(pa.array(clean, pa.bool_()))
    return run


def _blocks(docs: DataFrame, benchmark: DataFrame):
    """The benchmark in blocks of bounded size, prepared with counts over ``docs``."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + 2 * size // BLOCK_BYTES
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for k in range(blocks):
        rows = [(r["item_id"], r["text"].lower().encode()) for r in items.where(part == k).collect()]
        if any(len(h) >= N for h in tokens([t for _, t in rows])):
            yield prepare(rows, docs)


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """``doc_id, item_id, score, end_word``: a row per row of ``docs`` and item that it holds a copy of.

    ``score`` is the share of the item's information that the best local
    alignment recovers, less the cost of edits; ``end_word`` is the word of
    the document after the aligned passage. Case and punctuation are ignored. The benchmark is the query set: it is read in
    blocks of at most ``BLOCK_BYTES`` or one item, each searched in all documents, so a
    benchmark of any size needs bounded memory. Items of fewer than three
    words have no seed and are found nowhere; null and empty texts hold
    nothing; repeated items and rows give repeated rows. Other columns are
    ignored.
    """
    docs, found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), None
    for items in _blocks(docs, benchmark):
        block = docs.mapInArrow(_search(items, least), "doc_id bigint, item_id bigint, score double, end_word bigint")
        found = block if found is None else found.union(block)
    if found is None:
        found = docs.where("false").selectExpr("doc_id", "doc_id AS item_id", "0D AS score", "doc_id AS end_word")
    return found


def remove(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that hold a copy of no item, with all their columns; text stays in its task."""
    kept = docs
    for items in _blocks(docs, benchmark):
        kept = kept.mapInArrow(_without(items, least), docs.schema)
    return kept


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """One row per document that holds an item: ``doc_id, item_id`` of the best score, ``score, items``.

    Of equal scores the smallest ``item_id`` counts; rows that share a
    ``doc_id`` are one document. Rows without ``doc_id`` are reported by
    ``leaks`` only.
    """
    return (leaks(docs, benchmark, least).where("doc_id IS NOT NULL").groupBy("doc_id")
            .agg(F.max(F.struct("score", -F.col("item_id"))).alias("top"), F.count_distinct("item_id").alias("items"))
            .select("doc_id", (-F.col("top.col2")).alias("item_id"), F.col("top.score").alias("score"), "items"))
