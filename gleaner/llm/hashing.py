"""Words, shingles and hashes of whole texts as numpy arrays; used inside Spark tasks only."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20  # bytes hashed at a time; longer texts are cut at white space
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_powers: dict[str, np.ndarray] = {}


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def folded(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column in lower case, null as empty."""
    return [x.lower().encode() if x else b"" for x in column.to_pylist()]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for ``i < n``."""
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK + 1024)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=_U)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _blank(buf: np.ndarray) -> np.ndarray:
    return (buf == 32) | ((buf >= 9) & (buf <= 13))


def _mark(buf: np.ndarray) -> np.ndarray:
    """True between letters and digits; bytes beyond ASCII count as letters."""
    return ~(((buf >= 48) & (buf <= 57)) | ((buf >= 65) & (buf <= 90)) | ((buf >= 97) & (buf <= 122)) | (buf >= 128))


def _words_of(buf: np.ndarray, split=_blank) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    space = split(buf)
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    start, end = edges[0::2], edges[1::2]
    low = buf + ((buf >= 65) & (buf <= 90)).view(np.uint8) * np.uint8(32)
    up, down = powers(len(buf))
    total = np.zeros(len(buf) + 1, dtype=_U)
    np.cumsum((low.astype(_U) + _U(1)) * up, out=total[1:])
    if not len(start):
        return np.empty(0, dtype=_U), start, end
    return mix((total[end] - total[start]) * down[start]), start, end


def pieces(text: bytes):
    """Place and bytes of the parts of a long text, cut at white space."""
    at = 0
    while at < len(text):
        cut = len(text)
        if cut - at > CHUNK:
            found = _SPACE.search(text, at + CHUNK)
            cut = found.start() if found else cut
        yield at, text[at:cut]
        at = cut


Words = Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]


def tokens(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Per text: hashes of its runs of letters and digits, A-Z lower-cased."""
    return (h for h, _, _ in words(texts, _mark))


def words(texts: list[bytes], split=_blank) -> Words:
    """Per text: hash, first byte and end byte of each word ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased."""
    return over(texts, lambda buf: _words_of(buf, split))


def over(texts: list[bytes], run) -> Words:
    """Per text what ``run(bytes)`` gives: values of words, first bytes, end bytes.

    Short texts are joined by a space and long ones cut at white space, so
    ``run`` gets about ``CHUNK`` bytes and no more than that is held.
    """
    group: list[bytes] = []
    size = 0

    def flush():
        if group:
            first = np.cumsum([0] + [len(x) + 1 for x in group])
            h, s, e = run(np.frombuffer(b" ".join(group), dtype=np.uint8))
            cuts = np.searchsorted(s, first)
            for k in range(len(group)):
                part = slice(cuts[k], cuts[k + 1])
                yield h[part], s[part] - first[k], e[part] - first[k]
            group.clear()

    for text in texts:
        if size + len(text) > CHUNK:
            yield from flush()
            size = 0
        if len(text) > CHUNK:
            parts = [(at, run(np.frombuffer(x, dtype=np.uint8))) for at, x in pieces(text)]
            yield (np.concatenate([p[0] for _, p in parts]), np.concatenate([p[1] + at for at, p in parts]),
                   np.concatenate([p[2] + at for at, p in parts]))
        else:
            group.append(text)
            size += len(text) + 1
    yield from flush()


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, in order; empty if there are fewer."""
    if len(h) < n:
        return np.empty(0, dtype=_U)
    last = len(h) - n + 1
    total = np.zeros(last, dtype=_U)
    for j in range(n):
        total += h[j:j + last] * _U(pow(_BASE, 2 * j + 1, 1 << 64))
    return mix(total)


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """Distinct shingles of ``n`` words, sorted; fewer words count as one shingle, no word as none."""
    if not len(h):
        return h
    if len(h) < n:
        return mix(ngrams(h, len(h)) + _U(len(h)))
    return np.unique(ngrams(h, n))


class Minima:
    """Minima of ``count`` multiply-shift hash functions, the upper 32 bits of each."""

    def __init__(self, count: int, seed: int = 1):
        rng = np.random.RandomState(seed)
        draw = lambda: rng.randint(0, 1 << 32, count, dtype=np.uint64) << _U(32) | rng.randint(
            0, 1 << 32, count, dtype=np.uint64)
        self.a, self.b = draw()[:, None] | _U(1), draw()[:, None]

    def __call__(self, values: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), ~_U(0), dtype=_U)
        for at in range(0, len(values), 2048):
            part = values[None, at:at + 2048]
            np.minimum(least, (part * self.a + self.b).min(axis=1), out=least)
        return (least >> _U(32)).astype(np.uint32)
