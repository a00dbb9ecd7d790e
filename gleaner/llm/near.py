"""MinHash near-duplicates: universal hash minima, banding, verification, connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.components import components
from gleaner.llm.hashing import Minima, mix, shingles, texts_of, words
from gleaner.session import stage

MINIMA = 120
MISSED = 1e-4             # share of the pairs at the threshold that may share no band
BLOCK = 500               # members of a bucket that are compared in one task


def _sketches(n_words: int):
    def run(batches):
        minima = Minima(MINIMA)
        for batch in batches:
            sizes, keys, sigs = [], [], []
            for h, _, _ in words(texts_of(batch.column(1))):
                s = shingles(h, n_words)
                sizes.append(len(s))
                keys.append((mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                            if len(s) else (0, 0))
                sigs.append(minima(s).tobytes() if len(s) else None)
            k = np.array(keys, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(k[:, 0]), pa.array(k[:, 1]),
                 pa.array(sigs, pa.binary())], ["id", "n", "k1", "k2", "sig"])
    return run


def _sets(n_words: int):
    def run(batches):
        for batch in batches:
            found = [shingles(h, n_words) for h, _, _ in words(texts_of(batch.column(1)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.tobytes() for s in found], pa.binary())], ["id", "s"])
    return run


def _alike(percent: int):
    """Keep pairs whose sizes allow the similarity and whose signatures suggest it."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint32)
                    .reshape(-1, MINIMA) for c in ("x", "y"))
            keep = (x == y).mean(axis=1) >= least_alike(percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            keep = [_linked(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), percent)
                    for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def rows_per_band(percent: int) -> int:
    """The longest bands that miss at most ``MISSED`` of the pairs at the threshold."""
    return max((r for r in range(1, MINIMA + 1) if MINIMA % r == 0
                and (1 - (percent / 100) ** r) ** (MINIMA // r) <= MISSED), default=1)


def least_alike(percent: int) -> float:
    """Share of equal minima, four standard deviations below the threshold."""
    share = percent / 100
    return share - 4 * (share * (1 - share) / MINIMA) ** 0.5


def _partners(percent: int):
    """Per member of a block: those of other components that look alike and share no earlier band with it."""
    length = rows_per_band(percent)

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for band, key, i, j, members in zip(*(batch.column(c).to_pylist() for c in ("band", "key", "i", "j")),
                                                batch.column("members")):
                m = pa.RecordBatch.from_struct_array(members.values)
                ids, comp, n, blk = (m.column(c).to_numpy() for c in ("id", "comp", "n", "blk"))
                sig = np.frombuffer(b"".join(m.column("sig").to_pylist()), np.uint32).reshape(-1, MINIMA)
                named = set()
                found = {}
                for k in range(len(ids)):
                    other = np.flatnonzero((comp != comp[k]) & (ids > ids[k]) & ((blk != blk[k]) | (i == j))
                                           & (100 * np.minimum(n, n[k]) >= percent * np.maximum(n, n[k])))
                    same = sig[other] == sig[k]
                    close = same.mean(axis=1) >= least_alike(percent)
                    first = same[close].reshape(-1, MINIMA // length, length).all(axis=2).argmax(axis=1)
                    near = ids[other[close][first == band]]
                    if len(near):
                        found[ids[k]] = near
                        named.update(near.tolist())
                rows += [(band, key, i, j, x, found.get(x, ())) for x in sorted(named | found.keys())]
            cols = list(zip(*rows)) or [()] * 6
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             ["band", "key", "i", "j", "id", "partners"])
    return run


def _confirm_block(percent: int):
    def run(batches):
        for batch in batches:
            out = []
            for members in batch.column(0):
                m = pa.RecordBatch.from_struct_array(members.values)
                sets: dict[int, list[np.ndarray]] = {}
                for x, s in zip(m.column("id").to_pylist(), m.column("s").to_pylist()):
                    sets.setdefault(x, []).append(np.frombuffer(s, dtype=np.uint64))
                out += [(x, y) for x, ys in zip(m.column("id").to_pylist(), m.column("partners").to_pylist())
                        for y in ys if any(_linked(s, t, percent) for s in sets[x] for t in sets[y])]
            cols = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b"])
    return run


def _star_links(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    side = lambda c, v: classes.select(F.col("id").alias(c), F.col("sig").alias(v), F.col("n").alias("n" + v))
    near = (pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
            .where(100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
            .select("a", "b", "x", "y").mapInArrow(_alike(percent), "a bigint, b bigint").distinct())
    return stage(near.join(sets.select(F.col("id").alias("a"), F.col("s").alias("x")), "a")
                 .join(sets.select(F.col("id").alias("b"), F.col("s").alias("y")), "b")
                 .select("a", "b", "x", "y").mapInArrow(_confirm(percent), "a bigint, b bigint").distinct(),
                 "near-links")


def near_duplicates(docs: DataFrame, n_words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per row of ``docs(doc_id, text, ...)``.

    Two documents are linked when their sets of ``n_words``-word shingles have
    a Jaccard similarity of at least ``percent`` / 100; the set of a shorter
    text is its whole sequence. Links are confirmed on the full sets.

    Equal sets are one class from the start, so a large group of copies is one
    member. Every bucket of a band links its members to the smallest one; a
    second step compares those members of a bucket that are still in different
    components, in blocks of ``BLOCK``, so that no link inside a bucket is lost
    and no task holds a whole bucket.

    Null and empty texts have no shingle, link with nothing and stay. A row
    without ``doc_id`` links with nothing, has no component and stays. Rows
    that share a ``doc_id`` are texts of one document: a link of one is a link
    of all, and all are kept or dropped together. Other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text")
    sketches = stage(texts.mapInArrow(_sketches(n_words), "id bigint, n bigint, k1 bigint, k2 bigint, sig binary"),
                     "near-sketches")
    classes = stage(sketches.where("n > 0 AND id IS NOT NULL").groupBy("k1", "k2")
                    .agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig")),
                    "near-classes")
    width = 4 * rows_per_band(percent)
    keys = [F.xxhash64(F.substring("sig", 1 + at, width)) for at in range(0, 4 * MINIMA, width)]
    banded = classes.select("id", F.posexplode(F.array(*keys)).alias("band", "key"))
    buckets = (banded.groupBy("band", "key").agg(F.min("id").alias("lead"), F.max("id").alias("last"),
                                                 F.count("*").alias("size")).where("lead < last").drop("last"))
    members = stage(banded.join(buckets, ["band", "key"]), "near-members")

    # Dealt by id at every size, so that the cost stays in proportion to the input.
    sets = stage(texts.join(members.select("id").distinct().hint("merge"), "id", "left_semi")
                 .mapInArrow(_sets(n_words), "id bigint, s binary"), "near-sets")

    pairs = members.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    links = _star_links(pairs, classes, sets, percent)
    comps = components(links, "near-first")

    placed = (members.join(comps.withColumnRenamed("node", "id"), "id", "left")
              .withColumn("comp", F.coalesce("component", "id")).drop("component"))
    mixed = (placed.groupBy("band", "key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
             .where("low < high").select("band", "key"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = ["band", "key", "i", "j"]
    open_ = (placed.join(mixed, ["band", "key"]).join(classes.select("id", "n", "sig"), "id")
             .withColumn("blk", F.pmod(F.xxhash64("id"), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .withColumns({"i": F.least("blk", "other"), "j": F.greatest("blk", "other")})
             .groupBy(*block).agg(F.collect_list(F.struct("id", "comp", "n", "blk", "sig")).alias("members")))
    alike = open_.mapInArrow(_partners(percent), "band int, key bigint, i int, j int, id bigint, partners array<bigint>")
    more = stage(alike.join(sets, "id").groupBy(*block).agg(F.collect_list(F.struct("id", "partners", "s")).alias("m"))
                 .select("m").mapInArrow(_confirm_block(percent), "a bigint, b bigint"), "near-more")
    links = links.union(more)
    comps = components(links, "near-last")

    return (sketches.select("id", "n", "k1", "k2")
            .join(classes.select("k1", "k2", F.col("id").alias("first")), ["k1", "k2"], "left")
            .withColumn("first", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("first")))
            .join(comps.withColumnRenamed("node", "first"), "first", "left")
            .withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("component", "first")))
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
                    (F.col("id").isNull() | (F.col("id") == F.col("component_id"))).alias("kept")))
