"""Alignment of tokenizers against whole encodings; fragments; edge cases."""

import hashlib
import random
from collections import Counter
from itertools import accumulate

import public_tokenizers
import pytest
from hypothesis import given, strategies as st

from gleaner.llm import alignment
from gleaner.llm.alignment import EMPTY, Fragment, Pair, compose, fragment, ranges

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, block string, key string, part string, sha string, pair string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, x, *["x"] * 6) for i, x in rows], SCHEMA)


@pytest.fixture(scope="module")
def known():
    return Pair(A, B)


def plain(known, rows):
    """Whole texts encoded at once, groups by walking along both sequences."""
    links, docs = Counter(), []
    for doc_id, text in rows:
        a, b, groups, pairs = [], [], [], []
        if text:
            a = known.a.encode(" " + text, add_special_tokens=False).ids
            b = known.b.encode(text)
            raw = (" " + text).encode()
            if not b"".join(known.bytes_a[i] for i in a) == raw == b"".join(known.bytes_b[i] for i in b):
                a, b = [], []
        ends_a = list(accumulate(len(known.bytes_a[i]) for i in a))
        ends_b = list(accumulate(len(known.bytes_b[i]) for i in b))
        at = {e: k for k, e in enumerate(ends_a, 1)}, {e: k for k, e in enumerate(ends_b, 1)}
        low = (0, 0)
        for end in sorted(set(ends_a) & set(ends_b)):
            high = at[0][end], at[1][end]
            mine = a[low[0]:high[0]], b[low[1]:high[1]]
            groups.append("|".join(",".join(map(str, x)) for x in mine))
            pairs.append((mine[0][-1], mine[1][-1]))
            low = high
        links.update(pairs)
        docs.append((doc_id, len(a), len(b), groups, pairs))
    most = Counter()
    for (x, y), n in links.items():
        most[y] = max(most[y], n)
    return sorted(((i, n_a, n_b, len(g), len(p), sum(links[q] == most[q[1]] for q in p), sum(links[q] for q in p),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, n_a, n_b, g, p in docs), key=repr)


def rows_of(df):
    return sorted(((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"],
                    r["groups_sha256"]) for r in df.collect()), key=repr)


def texts(rng):
    words = ["the", "Tokens", "naïve", "don't", "we'll", "I'M", "3,141", "x=1;", "\n", "\n\n", "  ", "\t", "\r\n", " ", "", "a\n b",
             "漢字。日本", "我们，今天。", "한국어", "é", "é", "🙂👍🏽", "<s>", "<|endoftext|>", "<0x41>", " ", "　", " ",
             "​", "\x00", "\x1c", "\x7f", "'s", "''", "...", "—", "“q”", "\U0001d54f", "ﬁ", "ß", "᠎", "\u0085"]
    out = []
    for n in [1, 2, 3, 5] * 30 + [40] * 40 + [400] * 5:
        out.append("".join(rng.choice(words) + rng.choice(["", " ", " ", " "]) for _ in range(n)))
    return out


ODD = [None, "", " ", "  ", "\n", "a▁b", "▁", "ends with blank ", " begins", "plain text", "plain text"]


def test_whole_texts(spark, known):
    rows = list(enumerate(texts(random.Random(1)) + ODD)) + [(None, "no id"), (None, None), (3, "same id")]
    found = alignment.align(frame(spark, rows).repartition(3), A, B)
    assert rows_of(found) == plain(known, rows)


@pytest.mark.parametrize("size, reach", [(13, 9), (40, 30), (7, 1)])
def test_ranges_compose_to_the_whole(spark, known, size, reach):
    rng = random.Random(size)
    rows = list(enumerate([x + y for x, y in zip(texts(rng)[100:], reversed(texts(rng)))] + ODD))
    rows += [(500, "x" * 3000), (501, "ab" * 500 + "▁" + " word" * 300), (502, "我们今天" * 200), (503, " " * 500 + "x"),
             (504, "。".join(["漢字仮名"] * 300)), (505, "word " * 2000), (None, "two rows " * 40), (None, "two rows " * 40)]
    found = alignment.align(frame(spark, rows).repartition(3), A, B, long=20, size=size, reach=reach)
    assert rows_of(found) == plain(known, rows)


def test_very_long_and_none(spark, known):
    rows = [(1, " ".join(f"word{i % 977}" for i in range(60_000))), (2, "long" * 100_000), (3, " " * 300_000), (4, "\n" * 250_000)]
    assert rows_of(alignment.align(frame(spark, rows), A, B)) == plain(known, rows)
    assert alignment.align(frame(spark, []), A, B).count() == 0


def test_a_range_is_no_longer_than_it_has_to_be(known):
    text = " " + "some words and more of them " * 3000
    parts = list(ranges(known.cuts, text, 1000, 100))
    assert len(parts) == -(-len(text) // 1000) and max(len(c) for *_, c in parts) < 1100
    assert [p for p, *_ in ranges(known.cuts, " " + "x" * 5000, 1000, 100)] == [0]


@given(st.lists(st.integers(1, 4), min_size=1, max_size=30), st.lists(st.integers(1, 4), min_size=1, max_size=30),
       st.lists(st.integers(0, 60), max_size=6), st.randoms())
def test_composition_is_associative(a, b, borders, rng):
    total = min(sum(a), sum(b))
    ends_a, ends_b = (sorted({min(e, total) for e in accumulate(x)}) for x in (a, b))
    ids_a, ids_b = list(range(len(ends_a))), list(range(100, 100 + len(ends_b)))
    edges = sorted({0, total, *(x for x in borders if x < total)})
    parts = [fragment(ids_a, ends_a, ids_b, ends_b, x, y)[0] for x, y in zip(edges, edges[1:])]
    parts.insert(rng.randrange(len(parts) + 1), EMPTY)
    while len(parts) > 1:
        k = rng.randrange(len(parts) - 1)
        parts[k:k + 2] = [compose(parts[k], parts[k + 1])]
    assert parts[0] == fragment(ids_a, ends_a, ids_b, ends_b, 0, total)[0]
    assert isinstance(parts[0], Fragment) and parts[0].suf == ("", "")
