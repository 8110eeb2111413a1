"""Clusters against a plain version with Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from ledgerlake.llm.centroids import cluster, dot, integers_of, lengths, nearest, planes_of

from .helpers import crowded

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k, rounds, seed="2"):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) if i is not None else (True, "", v) for i, v in kept)
    cents = [list(v) for *_, v in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
            out.append((d.index(min(d)), min(d)))
        return out

    if not kept:
        return []
    for _ in range(rounds):
        at = assign()
        for c in range(len(cents)):
            mine = [v for (_, v), (x, _) in zip(kept, at) if x == c]
            if mine:
                cents[c] = [sum(col) // len(mine) for col in zip(*mine)]
    at = assign()
    per = [sum(d for x, d in at if x == c) for c in range(len(cents))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, c, d, per[c], sum(per), names[c]) for (i, _), (c, d) in zip(kept, at)), key=repr)


def vectors(seed, n, scale=1.0):
    rng = random.Random(seed)
    return [(k, [rng.gauss(k % 3, 0.4) * scale for _ in range(64)], 0) for k in range(n)]


def check(spark, rows, k=5, rounds=3):
    got = cluster(crowded(spark.createDataFrame(rows, SCHEMA)), k, rounds, "2")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, k, rounds)


def test_planes_and_products():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-300, 300, (50, 64)), rng.integers(-300, 300, (7, 64))
    pa_, pb = planes_of(a, 10), planes_of(b, 10)
    assert (integers_of(pa_) == a).all() and (dot(pa_, pb) == a @ b.T).all() and (lengths(pa_) == (a * a).sum(axis=1)).all()
    big = np.full((1, 64), -(1 << 27))
    assert nearest(planes_of(big, 28), planes_of(-big - 1, 28))[1][0] == 64 * ((1 << 28) - 1) ** 2


def test_brute(spark):
    check(spark, vectors(1, 200))
    check(spark, vectors(2, 60, 100_000.0), k=9)


def test_odd_vectors(spark):
    ok = vectors(3, 30)
    bad = [(100, None, 0), (101, [], 0), (102, [0.5] * 63, 0), (103, [0.5] * 65, 0), (104, [0.5] * 63 + [None], 0),
           (105, [float("nan")] * 64, 0), (106, [0.1] * 63 + [float("inf")], 0), (107, [0.1] * 63 + [float("-inf")], 0)]
    ties = [(k, [0.25] * 64, 0) for k in range(200, 230)] + [(None, [-0.3] * 64, 0), (None, [0.0] * 64, 1)]
    check(spark, ok + bad + ties + ok[:6])
    check(spark, ties, k=40)
    check(spark, [(None, [0.3] * 64, 0)], k=2)


def test_no_vectors(spark):
    for rows in ([], [(1, None, 0)]):
        df = cluster(spark.createDataFrame(rows, SCHEMA), 4, 2, "2")
        assert df.collect() == [] and df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_too_large(spark):
    with pytest.raises(ValueError):
        cluster(spark.createDataFrame([(1, [1e30] * 64, 0)], SCHEMA), 4, 2, "2")
