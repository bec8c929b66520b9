import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm.shallot import Search, centroid_clusters

SCHEMA = "vec_id long, embedding array<float>, label int, ids string, cluster string, sums string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in rows], SCHEMA)


def brute(rows, k, rounds, d):
    """The contract, one vector at a time in Python integers."""
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(64 * float(np.float32(x))) for x in v]))
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        near = assign()
        for j in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, near) if c == j]
            if own:
                centroids[j] = [sum(column) // len(own) for column in zip(*own)]
    return sorted(((i, c, dist) for (i, _), (dist, c) in zip(kept, assign())), key=repr), centroids


def check(spark, rows, k=16, rounds=3, d=64):
    found = centroid_clusters(frame(spark, rows).repartition(3), k, rounds, d)
    want, centroids = brute(rows, k, rounds, d)
    got = [tuple(r) for r in found.rows.select("vec_id", "cluster", "distance").collect()]
    assert sorted(got, key=repr) == want
    assert found.centroids == centroids
    for j in range(len(centroids)):
        assert found.inertia[j] == sum(dist for _, c, dist in want if c == j)
    return found, want


def test_clumps_ties_and_copies(spark):
    r = random.Random(1)
    clumps = [[r.gauss(0, 1) for _ in range(64)] for _ in range(9)]
    rows = [(i, [x + r.gauss(0, 0.2) for x in r.choice(clumps)]) for i in range(500)]
    rows += [(1000 + i, [0.5] * 64) for i in range(250)] + [(7, rows[7][1])] * 3
    found, want = check(spark, rows)
    # Bounds and balls spare more than half of the four full comparisons.
    assert found.compared < len(want) * 16 * 4 / 2


def test_few_values_make_many_ties(spark):
    r = random.Random(2)
    rows = [(i, [r.choice([-1 / 64, 0.0, 1 / 64]) for _ in range(4)]) for i in range(200)]
    check(spark, rows, k=9, rounds=5, d=4)
    check(spark, rows, k=1, rounds=2, d=4)


def test_odd_rows(spark):
    good = [(i, [i * 0.01 - 0.3, -i * 0.02]) for i in range(5)]
    odd = [(10, None), (11, []), (12, [1.0]), (13, [1.0, None]), (14, [float("nan"), 1.0]), (15, [1.0, float("inf")]), (None, [0.1, 0.2]), (None, None)]
    odd += [(3, [9.0, 9.0]), (3, [9.0, 9.0])]
    _, want = check(spark, good + odd, k=16, d=2)
    assert len(want) == 8


def test_empty_table_and_too_large_components(spark):
    assert check(spark, [])[1] == []
    assert check(spark, [(1, None)])[1] == []
    with pytest.raises(Exception, match="larger than"):
        centroid_clusters(frame(spark, [(1, [1e30] * 64)]))


def test_bounds_never_change_an_answer():
    r = np.random.default_rng(3)
    vectors = r.integers(-20, 20, (400, 5))
    centroids, state, moved = r.integers(-20, 20, (12, 5)), None, None
    for _ in range(6):
        state, _ = Search(centroids).nearest(vectors, state, moved)
        full = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        assert (state[0] == full.argmin(axis=1)).all()
        others = np.where(np.arange(12)[None] == state[0][:, None], np.iinfo(np.int64).max, full)
        assert (state[3] <= np.sqrt(others.min(axis=1)) + 1e-6).all()
        after = centroids + r.integers(-1, 2, centroids.shape)
        moved, centroids = np.sqrt(((after - centroids) ** 2).sum(axis=1).astype(float)), after
