"""Edit fingerprints against a plain walk, plain neighbours and all pairs; edge cases."""

import hashlib
import random

import numpy as np
import pytest

from gleaner.llm import fingerprints
from gleaner.llm.fingerprints import BAND, SLOTS, Walk, code_points, likeness, print_classes

SCHEMA = "doc_id bigint, text string, print string, id string, h string, row string, piece string, class_id string"


def frame(spark, rows):
    return spark.createDataFrame([(i, x, *["x"] * 6) for i, x in rows], SCHEMA)


def print_of(walk, text):
    points = code_points((text or "").encode())
    return walk.fingerprint(points, walk.phases(points))


def prose(rng, n):
    return "".join(rng.choice("abcdefghij  klmnoprstuvéß漢") for _ in range(n))


def test_walk_is_the_plain_one():
    walk = Walk()
    moves = np.random.RandomState(1).randint(0, 2, (fingerprints.PHASES, fingerprints.SYMBOLS))
    text = prose(random.Random(3), 3000)
    points = code_points(text.encode())
    symbols = [c if c < 256 else (c * 0x9E3779B1 & 0xFFFFFFFF) >> 24 for c in map(ord, text)]
    came, step = [], 0
    for c in symbols:
        came.append(step)
        while not moves[step % fingerprints.PHASES][c]:
            step += 1
        step += 1
    came.append(step)
    assert [c % fingerprints.PHASES for c in came] == walk.phases(points).tolist()
    half = len(points) // 2
    assert walk.phases(points[half:], int(walk.phases(points)[half])).tolist() == walk.phases(points)[half:].tolist()


def test_small_edits_keep_most_slots():
    rng, walk = random.Random(5), Walk()
    for _ in range(20):
        text = prose(rng, 2000)
        edited = list(text)
        for _ in range(3):
            at = rng.randrange(len(edited))
            edited[at:at + rng.randrange(2)] = rng.choice(["", "x", "yy"])
        assert likeness(print_of(walk, text), print_of(walk, "".join(edited))) > 0.6
        assert likeness(print_of(walk, text), print_of(walk, prose(rng, 2000))) < 0.1


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    walk, found = Walk(), []
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        keep = len(text) - len(text) // 3
        edited = text[:keep] + following[:len(text) // 3]
        x, y, z = (print_of(walk, t) for t in (text, edited, following))
        found.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), x.hex(), y.hex(), likeness(x, y),
                      likeness(x, z)))
    return sorted(found, key=repr)


def rows_of(df):
    return sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"],
                    r["near_edited"], r["near_next"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("parts", [1, 7])
def test_equals_the_plain_version(spark, parts):
    rng = random.Random(parts)
    rows = [(i, prose(rng, rng.choice([0, 1, 2, 3, 10, 400, 3000]))) for i in range(150)]
    rows += [(200, None), (201, ""), (None, "one without id"), (300, "x" * 400_000), (301, "word " * 100_000), (302, rows[9][1])]
    found = fingerprints.document_fingerprints(frame(spark, rows).repartition(parts))
    assert rows_of(found) == expected(rows)


def test_equal_rows_and_one_row_and_none(spark):
    same = [(5, "abc" * 50)] * 60 + [(None, "abc" * 50)] * 60
    found = fingerprints.document_fingerprints(frame(spark, same).repartition(6)).collect()
    assert len(found) == 120 and {r["near_next"] for r in found} == {1.0}
    assert {r["class_id"] for r in found if r["doc_id"] == 5} == {5}
    assert all(r["class_id"] is None for r in found if r["doc_id"] is None)
    assert rows_of(fingerprints.document_fingerprints(frame(spark, [(1, "abcdef")]))) == expected([(1, "abcdef")])
    assert fingerprints.document_fingerprints(frame(spark, [])).count() == 0


def test_texts_of_one_id_stay_apart(spark):
    rows = [(1, "first text " * 9), (1, "second text " * 9), (0, "third " * 9)]
    found = rows_of(fingerprints.document_fingerprints(frame(spark, rows)))
    assert sorted(r[1] for r in found) == [54, 99, 108]


def test_classes_equal_all_pairs(spark, monkeypatch):
    rng = np.random.RandomState(2)
    prints = []
    for _ in range(12):                                    # families whose members differ in up to 20 slots
        base = rng.randint(0, 256, SLOTS)
        for _ in range(30):
            x = base.copy()
            x[rng.choice(SLOTS, rng.randint(0, 11), replace=False)] = rng.randint(0, 256)
            prints.append(x.astype(np.uint8).tobytes())
    prints += prints[:5]
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    bands = lambda p: {(b, p[b:b + BAND]) for b in range(0, SLOTS, BAND)}
    for i in range(len(prints)):
        for j in range(i):
            if likeness(prints[i], prints[j]) >= 0.9 and bands(prints[i]) & bands(prints[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    monkeypatch.setattr(fingerprints, "BLOCK", 7)
    frame_ = spark.createDataFrame([(i, bytearray(p)) for i, p in enumerate(prints)], "doc_id bigint, print binary")
    found = {bytes(r["print"]): r["class_id"] for r in print_classes(frame_.repartition(4)).collect()}
    assert [found[p] for p in prints] == [root(i) for i in range(len(prints))]
    assert len(set(found.values())) < len(set(prints))
