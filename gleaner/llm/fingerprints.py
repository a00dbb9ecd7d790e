"""Document fingerprints: randomised edit embedding, bit-sampled banding, verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.components import components
from gleaner.llm.hashing import mix
from gleaner.session import stage

SLOTS = 128              # sampled places of the embedding, a byte each
BAND = 8                 # neighbouring slots that make a band
PHASES = 1024            # steps after which the walk's random bits repeat
SYMBOLS = 256            # classes of characters that have random bits of their own
GRAM = 4                 # characters that a sampled place sees: its own and those before it
FARTHEST = 1 << 40       # longest walk whose places are known
BLOCK = 1000             # members of a bucket that are compared in one task
_U = np.uint64


def code_points(text: bytes) -> np.ndarray:
    """Code points of UTF-8 bytes."""
    return np.frombuffer(text.decode().encode("utf-32-le"), dtype=np.uint32)


class Walk:
    """The random walk that all texts share, and the places of it that a fingerprint samples.

    Step ``j`` of a walk reads the character at a pointer and moves the pointer on if a random bit of ``j`` and the
    character says so. Two texts that differ by an edit read different characters for a while, until their walks meet
    again; so a small edit distance becomes a small Hamming distance between what is read.

    Each slot samples one step. Of the steps a walk has, it takes the one with the smallest random number, so texts of
    like length sample the same step in nearly all slots.
    """

    def __init__(self, seed: int = 1):
        rng = np.random.RandomState(seed)
        moves = rng.randint(0, 2, (PHASES, SYMBOLS)).astype(bool)
        # leaves[p][c]: the phase in which a pointer that comes to character c in phase p stands on the next one.
        leaves = np.empty((PHASES, SYMBOLS), dtype=np.int64)
        held = np.full(SYMBOLS, -1)
        for phase in range(2 * PHASES - 1, -1, -1):
            held = np.where(moves[phase % PHASES], phase + 1, held)
            if phase < PHASES:
                leaves[phase] = held % PHASES
        self.states: list[list] = [[] for _ in range(PHASES)]
        for phase, state in enumerate(self.states):
            state += [self.states[p] for p in leaves[phase]] + [phase]
        records = [[0] for _ in range(SLOTS)]
        for r in records:
            while r[-1] < FARTHEST:
                r.append(int((r[-1] + 1) / (1 - rng.random_sample())))
        width = max(map(len, records))
        self.records = np.array([r + [r[-1]] * (width - len(r)) for r in records])
        self.salt = mix(np.arange(SLOTS, dtype=_U) + _U(seed << 32))

    def phases(self, points: np.ndarray, start: int = 0) -> np.ndarray:
        """Phase in which the pointer comes to each character, and to the end."""
        wide = (points * np.uint32(0x9E3779B1)) >> np.uint32(24)
        symbols = np.where(points < SYMBOLS, points, wide).astype(np.uint8).tobytes()
        passed = accumulate(symbols, getitem, initial=self.states[start])
        return np.fromiter(map(itemgetter(SYMBOLS), passed), np.int16, len(points) + 1)

    def fingerprint(self, points: np.ndarray, phases: np.ndarray) -> bytes:
        """A byte per slot; a text without characters has zeros."""
        if not len(points):
            return bytes(SLOTS)
        came = np.zeros(len(phases), dtype=np.int64)
        np.cumsum((np.diff(phases) - 1) % PHASES + 1, out=came[1:])
        step = self.records[np.arange(SLOTS), (self.records < came[-1]).sum(axis=1) - 1]
        at = np.searchsorted(came, step, side="right") - 1
        seen = np.zeros(SLOTS, dtype=_U)
        for j in range(GRAM):
            seen = seen * _U(0x100000001B3) + np.where(at >= j, points[np.maximum(at - j, 0)] + _U(1), 0).astype(_U)
        return (mix(seen ^ self.salt) >> _U(56)).astype(np.uint8).tobytes()


def likeness(x: bytes, y: bytes) -> float:
    """Share of equal slots."""
    return float((np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)).mean())


class _Document:
    def __init__(self, walk: Walk, doc_id: int | None, text: bytes):
        self.doc_id, self.text, self.points = doc_id, text, code_points(text)
        self.phases = walk.phases(self.points)
        self.print = walk.fingerprint(self.points, self.phases)


def _edited(walk: Walk, doc: _Document, following: _Document) -> tuple:
    """Columns of ``_FOUND``: the document, and its text with the last third replaced by the start of the next one's."""
    n = len(doc.points)
    points = np.concatenate([doc.points[:n - n // 3], following.points[:n // 3]])
    phases = np.concatenate([doc.phases[:n - n // 3], walk.phases(points[n - n // 3:], int(doc.phases[n - n // 3]))])
    other = walk.fingerprint(points, phases)
    return (doc.doc_id, n, hashlib.sha256(points.tobytes().decode("utf-32-le").encode()).digest(), doc.print, other,
            likeness(doc.print, other), likeness(doc.print, following.print), None, None, None, None)


_FOUND = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.binary()),
                    ("print", pa.binary()), ("edited_print", pa.binary()), ("near_edited", pa.float64()),
                    ("near_next", pa.float64()), ("piece", pa.int32()), ("first_text", pa.binary()),
                    ("last_id", pa.int64()), ("last_text", pa.binary())])
_DDL = ("doc_id bigint, n_chars bigint, edited_sha256 binary, print binary, edited_print binary, near_edited double, "
        "near_next double, piece int, first_text binary, last_id bigint, last_text binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_FOUND)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)


def _squeeze(batches):
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = batch.column("text").to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), batch.column("row"),
                                          pa.array([pack(t) for t in texts], pa.binary())], ["doc_id", "h", "row", "z"])


def _along(batches: Iterator[pa.RecordBatch]):
    """Rows of a piece in order, each with the one after it; last, the texts at the piece's two ends."""
    walk, unpack = Walk(), zstandard.ZstdDecompressor().decompress
    first = last = piece = None
    for batch in batches:
        rows = []
        for doc_id, z, piece in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "z", "piece"))):
            doc = _Document(walk, doc_id, unpack(z))
            if last is None:
                first = doc.text
            else:
                rows.append(_edited(walk, last, doc))
            last = doc
        yield _batch(rows)
    if last is not None:
        yield _batch([(None,) * 7 + (piece, first, last.doc_id, last.text)])


def _across(batches: Iterator[pa.RecordBatch]):
    walk = Walk()
    for batch in batches:
        yield _batch([_edited(walk, _Document(walk, i, text), _Document(walk, None, following)) for i, text, following in zip(
            *(batch.column(c).to_pylist() for c in ("last_id", "last_text", "first_text")))])


def neighbours(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, print, edited_print, near_edited, near_next`` per row of ``docs(doc_id, text)``.

    The text of the next document is needed only next to it: one exchange puts the rows in order, a task goes along
    its piece, and one row per piece carries the texts at its ends to the piece before.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"))
    packed = (texts.withColumns({"h": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
              .mapInArrow(_squeeze, "doc_id bigint, h bigint, row bigint, z binary"))
    order = [F.col("doc_id").desc_nulls_last(), "h", "row"]
    found = stage(packed.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("piece", F.spark_partition_id()).mapInArrow(_along, _DDL), "fingerprints")
    ends = found.where("piece IS NOT NULL")
    # One number per piece.
    pieces = sorted(r["piece"] for r in ends.select("piece").collect())
    after = docs.sparkSession.createDataFrame(list(zip(pieces, pieces[1:] + pieces[:1])), "piece int, after int")
    edges = (ends.select("piece", "last_id", "last_text").join(F.broadcast(after), "piece")
             .join(ends.select(F.col("piece").alias("after"), "first_text").hint("merge"), "after")
             .select("last_id", "last_text", "first_text").mapInArrow(_across, _DDL))
    return found.where("piece IS NULL").union(edges).drop("piece", "first_text", "last_id", "last_text")


def _alike(least: float):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SLOTS) for c in "xy")
                yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))
    return run


def _inside(least: float):
    """Links between members of a block that are in different components."""
    def run(batches):
        for batch in batches:
            found = []
            for i, j, members in zip(*(batch.column(c).to_pylist() for c in "ij"), batch.column("members")):
                m = pa.RecordBatch.from_struct_array(members.values)
                ids, comp, blk = (m.column(c).to_numpy() for c in ("id", "comp", "blk"))
                prints = np.frombuffer(b"".join(m.column("print").to_pylist()), np.uint8).reshape(-1, SLOTS)
                for k in range(len(ids)):
                    others = np.flatnonzero((comp != comp[k]) & (ids > ids[k]) & ((blk != blk[k]) | (i == j)))
                    near = others[(prints[others] == prints[k]).mean(axis=1) >= least]
                    found += [(ids[k], x) for x in ids[near]]
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def print_classes(prints: DataFrame, least: float = 0.9) -> DataFrame:
    """``print, class_id``: classes of fingerprints ``prints(doc_id, print)`` that are linked at ``least`` of their slots.

    A class is a connected component and bears the smallest ``doc_id`` in it. Equal fingerprints are one member from
    the start. Fingerprints that share a band are candidates (a pair at 0.9 shares one with probability 0.9998) and
    all slots decide. A bucket is linked to its smallest member; members that are in different components after that
    are compared in blocks of ``BLOCK``. Rows without ``doc_id`` take no part.
    """
    members = stage(prints.where("doc_id IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("id")), "print-classes")
    bands = [F.xxhash64(F.lit(at), F.substring("print", 1 + at, BAND)) for at in range(0, SLOTS, BAND)]
    banded = members.select("id", F.explode(F.array(*bands)).alias("band"))
    shared = (banded.groupBy("band").agg(F.min("id").alias("lead"), F.max("id").alias("last"), F.count("*").alias("size"))
              .where("lead < last").drop("last"))
    met = stage(banded.join(shared, "band"), "print-buckets")
    side = lambda c, v: members.select(F.col("id").alias(c), F.col("print").alias(v))
    pairs = met.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    links = stage(pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y")
                  .mapInArrow(_alike(least), "a bigint, b bigint"), "print-links")
    placed = (met.join(components(links, "print-first").withColumnRenamed("node", "id"), "id", "left")
              .withColumn("comp", F.coalesce("component", "id")).drop("component"))
    mixed = placed.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("band")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    open_ = (placed.join(mixed, "band").join(members, "id").withColumn("blk", F.pmod(F.xxhash64("id"), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .withColumns({"i": F.least("blk", "other"), "j": F.greatest("blk", "other")})
             .groupBy("band", "i", "j").agg(F.collect_list(F.struct("id", "comp", "blk", "print")).alias("members")))
    more = open_.mapInArrow(_inside(least), "a bigint, b bigint").distinct()
    found = components(links.union(more), "print-last").withColumnRenamed("node", "id")
    return members.join(found, "id", "left").select("print", F.coalesce("component", "id").alias("class_id"))


def document_fingerprints(docs: DataFrame, least: float = 0.9) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, class_id``.

    One row per row of ``docs(doc_id, text, ...)``, whole texts. The next document is that with the next smaller
    ``doc_id``, after the last one the first; rows without ``doc_id`` are last, and rows of one ``doc_id`` follow each
    other by a hash of their text. The edited text has the last third of the characters replaced by as many, or all,
    of the next document's first ones. ``near_edited`` and ``near_next`` are shares of equal slots. Equal texts have equal
    fingerprints; null counts as empty, and an empty text has a fingerprint of zeros. A single row is its own next
    document. ``class_id`` is that of :func:`print_classes`, null without ``doc_id``. Other columns are ignored.
    """
    found = stage(neighbours(docs), "fingerprints-all")
    classes = print_classes(found.select("doc_id", "print"), least)
    hexed = lambda c: F.lower(F.hex(c))
    return (found.join(classes, "print", "left").select(
        "doc_id", "n_chars", hexed("edited_sha256").alias("edited_sha256"), hexed("print").alias("fingerprint"),
        hexed("edited_print").alias("edited_fingerprint"), "near_edited", "near_next",
        F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id")))
