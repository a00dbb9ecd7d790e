"""Alignment of two tokenizers: fragments of byte ranges, composed by tree reduction, and counts of linked ids."""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from bisect import bisect_right
from itertools import accumulate, chain
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from gleaner.session import stage

BLOCK = 4_000_000        # characters whose links are counted together
SLICE = 500_000          # characters that are split at a time
LONG = 100_000           # characters from which a document is cut into ranges
RANGE = 50_000           # characters of a range
REACH = 2_000            # characters in which a range's border has to have a cut on either side
FAN = 16                 # neighbouring fragments that a task composes
REMEMBERED = 800_000     # segments and words a task keeps
STOPS = "。．！？，、；：」』）】"   # candidates for a cut behind them


class Fragment(NamedTuple):
    """Tokens that end in a byte range: those up to its first common end, groups, and those after its last one.

    Without a common end ``groups`` is None, and all tokens are in ``pre``. ``pre`` and ``suf`` are ids of A and of B.
    """
    pre: tuple[str, str]
    groups: tuple | None
    suf: tuple[str, str]


EMPTY = Fragment(("", ""), None, ("", ""))


def _comma(x: str, y: str) -> str:
    return f"{x},{y}" if x and y else x or y


def _both(x: tuple[str, str], y: tuple[str, str]) -> tuple[str, str]:
    return _comma(x[0], y[0]), _comma(x[1], y[1])


def compose(f: Fragment, g: Fragment, close=lambda group, f, g: (group,)) -> Fragment:
    """The fragment of two neighbouring ranges; associative, with ``EMPTY`` as neutral element."""
    if f.groups is None:
        return Fragment(_both(f.pre, g.pre), g.groups, g.suf)
    if g.groups is None:
        return Fragment(f.pre, f.groups, _both(f.suf, g.pre))
    return Fragment(f.pre, f.groups + close("|".join(_both(f.suf, g.pre)), f, g) + g.groups, g.suf)


def fragment(a: list[int], ends_a: list[int], b: list[int], ends_b: list[int], low: int, high: int):
    """Fragment of the tokens that end in ``low < end <= high``, the id pairs linked there, and both counts of tokens."""
    i, j, to_a, to_b = (bisect_right(ends, x) for x in (low, high) for ends in (ends_a, ends_b))
    n_a, n_b, groups, pairs, x, y = to_a - i, to_b - j, [], [], i, j
    while i < to_a and j < to_b:
        if ends_a[i] < ends_b[j]:
            i += 1
        elif ends_a[i] > ends_b[j]:
            j += 1
        else:
            i, j = i + 1, j + 1
            pairs.append(a[i - 1] << 32 | b[j - 1])
            groups.append((",".join(map(str, a[x:i])), ",".join(map(str, b[y:j]))))
            x, y = i, j
    rest = ",".join(map(str, a[x:to_a])), ",".join(map(str, b[y:to_b]))
    if not groups:
        return Fragment(rest, None, ("", "")), pairs, n_a, n_b
    return Fragment(groups[0], tuple(map("|".join, groups[1:])), rest), pairs, n_a, n_b


def _byte_values() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable ones stand for themselves, others follow at U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [x for x in range(256) if x not in plain]
    return {chr(x): x for x in plain} | {chr(0x100 + n): x for n, x in enumerate(others)}


class Pair:
    """Both tokenizers, and segments of texts already seen."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        values = _byte_values()
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_a = [b""] * (1 + max(vocab.values()))
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(values[c] for c in token) if all(c in values for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        # No merge of B crosses a cut: a blank begins a piece or follows blanks, a line break is a byte of its own,
        # a stop ends a piece. A starts a token at each cut whatever stands before it.
        whole = [p for i, p in enumerate(pieces) if not self.b.is_byte(i) and not self.b.is_control(i)
                 and not self.b.is_unknown(i)]
        inner = {c for p in whole for c in p[:-1]} | {p[-1] for p in whole if len(p) > 1}
        if any("▁" in p.lstrip("▁") for p in whole):
            raise ValueError("a piece of B goes on across a blank")
        rules = [r"(?<=[^ ])(?= (?:[^\W_]|[!-/:-@\[-`{-~]))"]
        self.lone = self.b.encode("\n") == [self.b.piece_to_id("▁"), self.b.piece_to_id("<0x0A>")] and "\n" not in inner
        if self.lone:
            rules.append(r"(?<=\S)(?=\n)")
            stops = "".join(c for c in STOPS if not any(c in p[:-1] for p in whole))
            rules += [f"(?<=[{stops}])(?=[^\\W_])"] * bool(stops)
        self.cuts = re.compile("|".join(rules))
        self.length_a, self.length_b = (np.array(list(map(len, x)), dtype=np.int64) for x in (self.bytes_a, self.bytes_b))
        # An id inside a group, before the ids of B, and at the end of a group.
        self.spelled = np.array([[f"{i},", f"{i}|", f"{i};"] for i in range(max(len(self.bytes_a), len(self.bytes_b)))],
                                dtype=object)
        self.plain = re.compile(r"[^\W_]|[!-/:-@\[-`{-~]")
        self.forget()

    def forget(self) -> None:
        """Drop all segments; numbers begin anew."""
        self.number: dict[str, int] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.text: list[str] = []
        self.pairs = array("q")
        self.counts = array("q")

    def links(self, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Linked ids of segments, one after the other, and how many each has."""
        starts, sizes = self.table()[segments, 4], self.table()[segments, 2]
        place = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return np.array(self.pairs, dtype=np.int64)[place], sizes

    def table(self) -> np.ndarray:
        """Per segment tokens of A, of B, groups, whether it fits, and where its links start."""
        return np.array(self.counts, dtype=np.int64).reshape(-1, 5)

    def ids(self, segments: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B of each segment."""
        a = [x.ids for x in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        b = self.b.encode([s[1:] if s[:1] == " " else "\n" + s for s in segments], num_threads=1)
        return a, [y if s[:1] == " " else y[2:] for s, y in zip(segments, b)]

    def tokens(self, segments: list[str]):
        """Per segment ids and their ends in bytes, of A and of B, and whether both give the segment's bytes."""
        for s, a, b in zip(segments, *self.ids(segments)) if segments else ():
            parts_a, parts_b = [self.bytes_a[i] for i in a], [self.bytes_b[i] for i in b]
            yield (a, list(accumulate(map(len, parts_a))), b, list(accumulate(map(len, parts_b))),
                   b"".join(parts_a) == s.encode() == b"".join(parts_b))

    def learn(self, segments: list[str]) -> None:
        """Groups and links of new segments, all at once: tokens of A and B are merged by where they end."""
        a, b = self.ids(segments)
        raw = [s.encode() for s in segments]
        fits = [b"".join(map(self.bytes_a.__getitem__, x)) == r == b"".join(map(self.bytes_b.__getitem__, y))
                for x, y, r in zip(a, b, raw)]
        a, b = ([x if ok else [] for x, ok in zip(y, fits)] for y in (a, b))
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a, b))
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        common, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        # A token stands behind all tokens of earlier groups; A's come before B's.
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        close_a, close_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
        close_a[at_a], close_b[at_b] = True, True
        before_b = np.concatenate([[0], at_b + 1])
        words = np.empty(len(a) + len(b), dtype=object)
        words[np.arange(len(a)) + before_b[group_a]] = self.spelled[a, 0 + close_a]
        words[np.arange(len(b)) + (at_a + 1)[group_b]] = self.spelled[b, 2 * close_b]
        words = words.tolist()
        first = len(self.pairs)
        self.pairs.frombytes((a[at_a] << 32 | b[at_b]).tobytes())
        edge = np.concatenate([[0], np.cumsum(n_a)])
        n_groups = np.diff(np.searchsorted(at_a, edge))
        at = linked = 0
        for s, x, y, g, ok in zip(segments, n_a.tolist(), n_b.tolist(), n_groups.tolist(), fits):
            self.number[s] = len(self.text)
            self.text.append("".join(words[at:at + x + y])[:-1])
            self.counts.extend((x, y, g, ok, first + linked))
            at, linked = at + x + y, linked + g

    def numbers(self, segments: list[str]) -> list[int]:
        """Number of each segment in ``text`` and ``table()``."""
        new = sorted({s for s in segments if s not in self.number})
        if new:
            self.learn(new)
        return [self.number[s] for s in segments]

    def look(self, texts: list[str]) -> list[np.ndarray]:
        """Numbers of the segments of each text with a blank before it.

        What stands between two blanks is looked up as a whole, unless it is empty or begins with a character before
        which a blank is no cut: such texts are split at their cuts.
        """
        words = [t.split(" ") for t in texts]
        new = sorted({w for ws in words for w in ws if w not in self.words})
        fit = [w for w in new if self.plain.match(w)]
        parts = [self.cuts.split(" " + w) for w in fit]
        numbers = iter(self.numbers(list(chain.from_iterable(parts))))
        self.words.update((w, tuple(next(numbers) for _ in p)) for w, p in zip(fit, parts))
        found = []
        for text, ws in zip(texts, words):
            try:
                flat = list(chain.from_iterable(map(self.words.__getitem__, ws)))
            except KeyError:
                flat = self.numbers(self.cuts.split(" " + text))
            found.append(np.array(flat, dtype=np.int32))
        return found


_pairs: dict[tuple, Pair] = {}


def _pair(paths: tuple[str, str]) -> Pair:
    if paths not in _pairs:
        _pairs[paths] = Pair(*paths)
    return _pairs[paths]


# --- documents and ranges -> blocks of links --------------------------------------

_BLOCK = ("block bigint, key bigint, part int, ok boolean, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, "
          "n_groups array<bigint>, digest array<string>, pairs binary, occurs binary, length binary, links binary, "
          "closed string, pre array<string>, suf array<string>, open boolean")
_NAMES = [f.split()[0] for f in _BLOCK.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), *[pa.list_(pa.int64())] * 4, pa.list_(pa.string()),
          *[pa.binary()] * 4, pa.string(), *[pa.list_(pa.string())] * 2, pa.bool_()]


def _squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _loose(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


def _block(known: Pair, block: int, rows: list[tuple], key=None, part=None, ok=True, closed=None, f: Fragment = EMPTY,
           more: list[list[int]] = ()) -> pa.RecordBatch:
    """One row: documents ``(doc_id, n_a, n_b, n_groups, digest, numbers of segments)`` and the links they have.

    ``more`` are linked ids of segments without a number, all of the one document.
    """
    numbers = [r[-1] for r in rows]
    segments, place = np.unique(np.concatenate(numbers), return_inverse=True)
    linked, sizes = known.links(segments)
    linked = np.concatenate([linked, np.array(list(chain.from_iterable(more)), dtype=np.int64)])
    sizes = np.concatenate([sizes, np.array(list(map(len, more)), dtype=np.int64)])
    place = np.concatenate([place, np.arange(len(segments), len(sizes))])
    times = np.bincount(place, minlength=len(sizes)) if len(sizes) else np.empty(0, np.int64)
    pairs, at = np.unique(linked, return_inverse=True)
    occurs = np.bincount(at, weights=np.repeat(times, sizes), minlength=len(pairs)).astype(np.int64)
    lengths = np.array(list(map(len, numbers)), dtype=np.int32) + np.int32(len(more))
    # Per segment its pairs, per document its segments.
    links = np.concatenate([[len(sizes)], sizes, at, place]).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(
        [block, key, part, ok, *([r[c] for r in rows] for c in range(5)), pairs.tobytes(), occurs.tobytes(),
         _squeezed(lengths), _squeezed(links), closed, list(f.pre), list(f.suf), f.groups is None], _KINDS)], _NAMES)


def _whole(paths: tuple[str, str]):
    """Blocks of documents that are worked through as a whole."""
    def run(batches):
        known, first, n = _pair(paths), TaskContext.get().partitionId() << 32, 0
        known.forget()
        rows, held = [], 0
        for batch in batches:
            for ids, texts in _slices(batch):
                found = known.look(texts)
                table = known.table()
                for doc_id, segments in zip(ids, found):
                    n_a, n_b, n_groups, fits = table[segments, :4].sum(axis=0).tolist()
                    if fits == len(segments):
                        groups = ";".join([known.text[s] for s in segments.tolist()])
                        rows.append((doc_id, n_a, n_b, n_groups, hashlib.sha256(groups.encode()).hexdigest(), segments))
                    else:
                        rows.append((doc_id, 0, 0, 0, "", segments[:0]))
                held += sum(map(len, texts))
                if held >= BLOCK:
                    yield _block(known, first + n, rows)
                    rows, held, n = [], 0, n + 1
                    if len(known.text) + len(known.words) > REMEMBERED:
                        known.forget()
        if rows:
            yield _block(known, first + n, rows)
    return run


def _slices(batch: pa.RecordBatch):
    """Ids and texts of a batch, about ``SLICE`` characters at a time."""
    ids, texts, held = [], [], 0
    for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
        ids.append(doc_id.as_py())
        texts.append(text.as_py())
        held += len(texts[-1])
        if held >= SLICE:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def ranges(cuts: re.Pattern, text: str, size: int, reach: int):
    """``part, low, high, context`` of the byte ranges of a text: tokens that end in ``low < end <= high`` of ``context``.

    ``context`` is the range and what stands up to the next cut on either side. A border without cuts in ``reach``
    characters is left out, so that a text without cuts is one range and not worked through once for each of many.
    """
    def near(at: int) -> tuple[int, int] | None:
        start = max(1, at - reach)
        places = [start - 1 + m.start() for m in cuts.finditer(text[start - 1:at + reach]) if m.start()]
        places = [0] * (at <= reach) + places + [len(text)] * (at + reach >= len(text))
        before, after = [p for p in places if p <= at], [p for p in places if p >= at]
        return (before[-1], after[0]) if before and after else None

    borders = [(0, 0, 0)]
    for at in range(size, len(text), size):
        around = near(at)
        if around:
            borders.append((at, *around))
    borders.append((len(text),) * 3)
    n_bytes = lambda x, y: len(text[x:y].encode())
    for part, ((at, left, _), (to, _, right)) in enumerate(zip(borders, borders[1:])):
        yield part, n_bytes(left, at), n_bytes(left, to), text[left:right]


def _cut(paths: tuple[str, str], size: int, reach: int):
    def run(batches):
        cuts = _pair(paths).cuts
        for batch in batches:
            for key, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("key", "doc_id", "text"))):
                for part, low, high, context in ranges(cuts, " " + text, size, reach):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x], k) for x, k in zip((key, doc_id, part, low, high, context), (
                            pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()))],
                        ["key", "doc_id", "part", "low", "high", "context"])
    return run


def _ranged(paths: tuple[str, str]):
    """A block per range, with its fragment."""
    def run(batches):
        known, n = _pair(paths), 0
        first = (1 << 62) + (TaskContext.get().partitionId() << 32)
        known.forget()
        for batch in batches:
            for key, doc_id, part, low, high, context in zip(*(batch.column(c).to_pylist() for c in (
                    "key", "doc_id", "part", "low", "high", "context"))):
                at, inner, edges = 0, [], []
                for s in known.cuts.split(context):
                    to = at + len(s.encode())
                    if low <= at and to <= high:
                        inner.append(s)
                    elif to > low and at < high:
                        edges.append((s, at))
                    at = to
                total, more, left, right = np.zeros(4, dtype=np.int64), [], EMPTY, EMPTY
                for (s, at), (a, ends_a, b, ends_b, fits) in zip(edges, known.tokens([s for s, _ in edges])):
                    f, linked, n_a, n_b = fragment(a, ends_a, b, ends_b, low - at, high - at)
                    left, right = (f, right) if at < low else (left, f)
                    more.append(linked)
                    total += (n_a, n_b, len(linked), fits)
                numbers, middle = np.array(known.numbers(inner), dtype=np.int32), EMPTY
                total += known.table()[numbers, :4].sum(axis=0)
                ok = int(total[3]) == len(inner) + len(edges)
                if ok and inner:
                    head, _, rest = ";".join([known.text[s] for s in numbers.tolist()]).partition(";")
                    middle = Fragment(tuple(head.split("|")), (rest,) if rest else (), ("", ""))
                f = compose(compose(left, middle), right)
                yield _block(known, first + n, [(doc_id, *total[:3].tolist(), None, numbers)], key, part, ok,
                             ";".join(f.groups or ()), f, more)
                n += 1
                if len(known.text) > REMEMBERED:
                    known.forget()
    return run


# --- fragments of a document -> its digest ------------------------------------------

_FRAGMENT = ("key bigint, part int, first int, pre array<string>, suf array<string>, "
             "seams array<struct<part:int,text:string>>")


def _compose(table: pa.Table) -> pa.Table:
    """Neighbouring fragments as one; ``first`` is its first range with a common end, ``seams`` the groups closed so far."""
    rows = sorted(table.to_pylist(), key=itemgetter("part"))
    total, first = EMPTY, None
    for r in rows:
        groups = None if r["first"] is None else tuple((s["part"], s["text"]) for s in r["seams"])
        total = compose(total, Fragment(tuple(r["pre"]), groups, tuple(r["suf"])),
                        lambda group, f, g, at=r["first"]: ((at, group),))
        first = r["first"] if first is None else first
    return pa.table({"key": pa.array([rows[0]["key"]], pa.int64()), "part": pa.array([rows[0]["part"] // FAN], pa.int32()),
                     "first": pa.array([first], pa.int32()), "pre": [list(total.pre)], "suf": [list(total.suf)],
                     "seams": pa.array([[{"part": p, "text": t} for p, t in total.groups or ()]], pa.list_(
                         pa.struct([("part", pa.int32()), ("text", pa.string())])))})


def _digests(batches):
    """SHA-256 of the groups of each document, whose rows follow each other in order."""
    held, digest, begun = None, None, False
    for batch in batches:
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
            if key != held:
                if held is not None:
                    yield _digest(held, digest)
                held, digest, begun = key, hashlib.sha256(), False
            digest.update((";" * begun + text).encode())
            begun = True
    if held is not None:
        yield _digest(held, digest)


def _digest(key: int, digest) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([digest.hexdigest()])], ["key", "sha"])


def long_digests(blocks: DataFrame) -> DataFrame:
    """``key, sha`` of documents cut into ranges: fragments are composed ``FAN`` at a time until one is left of each."""
    top = blocks.agg(F.max("part")).first()[0] or 0
    left = blocks.select("key", "part", F.when(~F.col("open"), F.col("part")).alias("first"), "pre", "suf",
                         F.array().cast("array<struct<part:int,text:string>>").alias("seams"))
    while top >= 0:
        left = left.groupBy("key", F.floor(F.col("part") / FAN)).applyInArrow(lambda _, rows: _compose(rows), _FRAGMENT)
        top = top // FAN if top else -1
    seams = left.select("key", F.explode(F.concat(F.array(F.struct(
        F.col("first").alias("part"), F.array_join("pre", "|").alias("text"))), "seams")).alias("s"))
    texts = seams.select("key", "s.part", F.lit(0).alias("kind"), "s.text").union(
        blocks.where("closed <> ''").select("key", "part", F.lit(1), F.col("closed").alias("text")))
    return (texts.repartition("key").sortWithinPartitions("key", "part", "kind").select("key", "text")
            .mapInArrow(_digests, "key bigint, sha string"))


# --- links -> counts -> documents ---------------------------------------------------

def _linked(batches):
    for batch in batches:
        for block, pairs, occurs in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "occurs"))):
            p = np.frombuffer(pairs, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), block)), pa.array(p),
                                              pa.array(np.frombuffer(occurs, dtype=np.int64))], ["block", "pair", "n"])


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair, count, best``: links of each id pair, and whether no pair of the same B id has more. ``links(pair, n)``."""
    counts = stage(links.groupBy("pair").agg(F.sum("n").alias("count"))
                   .withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))), "align-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


_SCORED = ("key bigint, part int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
           "count_sum bigint, sha string")


def _score(blocks: pa.Table, counted: pa.Table) -> pa.Table:
    """Documents of a block with the counts of its pairs."""
    r = blocks.to_pylist()[0]
    order = np.argsort(counted["pair"].to_numpy())
    worth = {"n_best": counted["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64),
             "count_sum": counted["count"].to_numpy()[order]}
    links, lengths = _loose(r["links"], np.int32), _loose(r["length"], np.int32)
    sizes, rest = links[1:1 + links[0]], links[1 + links[0]:]
    place, segments = rest[:sizes.sum()], rest[sizes.sum():]
    before = lambda v: np.concatenate([[0], np.cumsum(v)])
    ends = before(sizes)
    sums = {}
    for name, value in worth.items():
        per = before(value[place])
        per = (per[ends[1:]] - per[ends[:-1]])[segments]
        edge = before(lengths)
        sums[name] = before(per)[edge[1:]] - before(per)[edge[:-1]]
    n = len(lengths)
    return pa.table({"key": pa.array([r["key"]] * n, pa.int64()), "part": pa.array([r["part"]] * n, pa.int32()),
                     "doc_id": pa.array(r["doc_id"], pa.int64()), "n_a": pa.array(r["n_a"], pa.int64()),
                     "n_b": pa.array(r["n_b"], pa.int64()), "n_groups": pa.array(r["n_groups"], pa.int64()),
                     "n_links": pa.array(r["n_groups"], pa.int64()), "n_best": pa.array(sums["n_best"], pa.int64()),
                     "count_sum": pa.array(sums["count_sum"], pa.int64()), "sha": pa.array(r["digest"], pa.string())})


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def align(docs: DataFrame, path_a: str, path_b: str, long: int = LONG, size: int = RANGE, reach: int = REACH) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, one row per row of ``docs(doc_id, text)``.

    ``path_a`` is a byte-level vocabulary of ``tokenizers``, ``path_b`` a sentencepiece model with byte fallback that puts
    a blank before a text; A gets the same blank. Both encode whole texts without special tokens. Where tokens of both end
    at one byte, a group of each ends, and the two tokens are linked. ``n_best`` counts the links of an id pair that no
    other pair of its B id outnumbers in all documents, ``count_sum`` adds up the numbers of links of the pairs.

    A text is worked through in segments between places where a token of either tokenizer begins whatever stands before.
    A text of more than ``long`` characters is cut into byte ranges of ``size``, dealt over all tasks. A range gives a
    :class:`Fragment`; these are composed as a tree. A text without such places is one segment and has to fit a task.

    Null and empty texts, and those whose bytes one of the tokenizers does not give back, have zeros and an empty digest,
    and their links are not counted. Rows that share a ``doc_id``, or have none, are documents of their own. Other
    columns are ignored.
    """
    paths = (path_a, path_b)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    size_ = F.char_length("text")
    short = stage(texts.where((size_ > 0) & (size_ <= long)).mapInArrow(_whole(paths), _BLOCK), "align-blocks")
    # Numbered once and written: the number is the document's key from here on.
    cut = stage(texts.where(size_ > long).withColumn("key", F.monotonically_increasing_id()).mapInArrow(
        _cut(paths, size, reach), "key bigint, doc_id bigint, part int, low bigint, high bigint, context string"), "align-cut")
    parts = stage(cut.repartition("key", "part").mapInArrow(_ranged(paths), _BLOCK), "align-ranges")
    whole = parts.join(parts.where("NOT ok").select("key").distinct(), "key", "left_anti").select(*parts.columns)
    blocks = short.unionByName(whole)
    linked = stage(blocks.select("block", "pairs", "occurs").mapInArrow(_linked, "block bigint, pair bigint, n bigint"),
                   "align-links")
    counted = linked.select("block", "pair").join(pair_counts(linked), "pair")
    scored = (blocks.select("block", "key", "part", "doc_id", "n_a", "n_b", "n_groups", "digest", "length", "links")
              .groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(_score, _SCORED))
    scored = stage(scored, "align-scored")
    digests = long_digests(whole)
    joined = (scored.where("key IS NOT NULL").groupBy("key").agg(
        F.first("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in _NUMBERS]).join(digests, "key"))
    zero = [F.lit(0).cast("bigint")] * len(_NUMBERS)
    broken = parts.groupBy("key").agg(F.first(F.col("doc_id")[0]).alias("doc_id"), F.min("ok").alias("ok")).where("NOT ok")
    columns = ["doc_id", *_NUMBERS, F.col("sha").alias("groups_sha256")]
    return (scored.where("key IS NULL").select(*columns).union(joined.select(*columns))
            .union(broken.select("doc_id", *zero, F.lit("")))
            .union(texts.where(F.coalesce(size_, F.lit(0)) == 0).select("doc_id", *zero, F.lit(""))))
