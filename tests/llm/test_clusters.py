"""Centroid clustering against a plain version, and its edge cases."""

import hashlib
import math
import random

import pytest

from gleaner.llm import clusters

SCHEMA = "vec_id bigint, embedding array<double>, v string, lead string, rest string, cluster string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, x, *["x"] * 5) for i, x in rows], SCHEMA)


def plain(rows, k, rounds, dims, scale=64, seed=1):
    kept = [(i, tuple(math.floor(scale * c) for c in x)) for i, x in rows
            if x is not None and len(x) == dims and all(c is not None and math.isfinite(c) for c in x)]
    rank = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (r[0] is None, r[0] is not None and rank(r[0]), r[1]))[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for j, vs in groups.items():
            centroids[j] = tuple(sum(c) // len(vs) for c in zip(*vs))
    found = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertia = {j: sum(d for _, c, d in found if c == j) for j in range(len(centroids))}
    return [(i, j, d, inertia[j], sum(inertia.values()), digest[j]) for i, j, d in found]


def rows_of(df):
    return [(r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"])
            for r in df.collect()]


def in_order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("dims, k, rounds, scale", [(8, 5, 3, 64), (4, 7, 2, 2), (64, 16, 3, 64)])
def test_equals_the_plain_version(spark, dims, k, rounds, scale):
    rng = random.Random(dims)
    middle = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.3) for c in rng.choice(middle)]) for i in range(400)]
    rows += rows[:20] + [(i, rows[3][1]) for i in range(500, 560)]        # repeated rows, equal vectors
    rows += [(700, [0.0] * dims), (701, [-0.0] * dims), (None, rows[5][1]), (702, [1e4] * dims)]
    rows += [(800, None), (801, []), (802, [1.0] * (dims - 1)), (803, [None] + [1.0] * (dims - 1)),
             (804, [math.nan] * dims), (805, [math.inf] * dims), (806, [-math.inf] + [0.0] * (dims - 1))]
    found = clusters.centroid_clusters(frame(spark, rows).repartition(5), k, rounds, dims, scale,
                                       leading=max(2, dims // 4)).cache()
    assert in_order(rows_of(found)) == in_order(plain(rows, k, rounds, dims, scale))
    if dims == 64:
        checked = [r["n_verified"] for r in found.collect()]
        assert max(checked) <= k and sum(checked) < k * len(checked) / 2


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(40)] + [(100, [0.5, 0.0])]
    assert in_order(rows_of(clusters.centroid_clusters(frame(spark, rows), 6, 1, 2, 2))) == in_order(plain(rows, 6, 1, 2, 2))


def test_none_and_few(spark):
    assert clusters.centroid_clusters(frame(spark, []), dims=2).count() == 0
    few = [(1, [0.5, 0.25]), (2, [2.0, 1.0])]
    assert in_order(rows_of(clusters.centroid_clusters(frame(spark, few), dims=2))) == in_order(plain(few, 16, 3, 2))


def test_beyond_what_a_long_holds(spark):
    large = float(clusters.LARGEST) / 64
    rows = [(i, [large if i % 2 else -large] * 64) for i in range(6)] + [(9, [2 * large] * 64), (10, [1e300] * 64)]
    found = rows_of(clusters.centroid_clusters(frame(spark, rows), k=1, rounds=0))
    assert sorted(r[0] for r in found) == list(range(6))
    assert {r[2] for r in found} == {0, 64 * (2 * clusters.LARGEST) ** 2} and {r[4] for r in found} == {None}
