import hashlib
import math
import random

import numpy as np
import pytest

from biblioforge.llm import delta_lloyd


def brute(rows, clusters, rounds, width):
    """Full Lloyd rounds in plain integers: [(vec_id, cluster, distance)] in the order of rows that take part, and the centroids."""
    points = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    centroids = [q for _, q in sorted(points, key=lambda p: (hashlib.sha256(f"2:{'' if p[0] is None else p[0]}".encode()).hexdigest(), p[1]))[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, c)), k) for k, c in enumerate(centroids)) for _, q in points]

    for _ in range(rounds):
        owners = assign()
        for k in range(len(centroids)):
            mine = [q for (_, q), (_, c) in zip(points, owners) if c == k]
            if mine:
                centroids[k] = [sum(xs) // len(mine) for xs in zip(*mine)]
    return [(i, c, d) for (i, _), (d, c) in zip(points, assign())], centroids


def run(spark, rows, clusters, rounds, width):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return delta_lloyd.cluster(df, clusters, rounds, width).collect()


def vectors(n, width, seed, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    return [(i, [float(np.float32(x + rng.gauss(0, spread))) for x in centres[i % 6]]) for i in range(n)]


@pytest.mark.parametrize("n,width,clusters,rounds,spread", [(300, 8, 12, 5, 1.0), (200, 3, 40, 5, 0.2), (30, 4, 40, 5, 1.0), (200, 2, 5, 0, 1.0), (250, 5, 7, 12, 0.05)])
def test_equals_full_rounds(spark, n, width, clusters, rounds, spread):
    rows = vectors(n, width, n, spread)
    want, centroids = brute(rows, clusters, rounds, width)
    got = run(spark, rows, clusters, rounds, width)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted(want)
    inertia = {}
    for _, c, d in want:
        inertia[c] = inertia.get(c, 0) + d
    for r in got:
        assert (r.cluster_inertia, r.inertia) == (inertia[r.cluster], sum(inertia.values()))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_ties_repeats_and_odd_vectors(spark):
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.0]), (3, [0.5, 0.0]), (3, [0.25, 0.0]), (None, [0.5, 0.5]), (4, None), (5, [1.0]), (6, [None, 1.0]), (7, [math.nan, 1.0]), (8, [math.inf, 0.0])]
    rows += [(10 + i, [float(i % 3), float(i % 2)]) for i in range(40)]
    for clusters in (2, 3, 9):
        want, _ = brute(rows, clusters, 5, 2)
        key = lambda r: tuple((x is None, x or 0) for x in r)
        assert sorted(((r.vec_id, r.cluster, r.distance) for r in run(spark, rows, clusters, 5, 2)), key=key) == sorted(want, key=key)
    assert run(spark, [], 4, 5, 2) == [] and run(spark, [(1, None)], 4, 5, 2) == []


def test_large_components_are_exact_or_refused(spark):
    rows = [(i, [float((i * 37 % 11) * 40_000), float(-(i * 53 % 7) * 40_000)]) for i in range(60)]  # beyond EXACT after scaling
    want, _ = brute(rows, 5, 3, 2)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in run(spark, rows, 5, 3, 2)) == sorted(want)
    with pytest.raises(Exception, match="components beyond"):
        run(spark, [(1, [1e30, 0.0])], 1, 1, 2)


def test_rounds_touch_what_changed(spark):
    """Transfers carry the vectors that moved alone, and rounds end when nothing changes."""
    points = delta_lloyd.quantised(spark.createDataFrame(vectors(300, 4, 9, 0.1), "vec_id long, embedding array<float>"), 4)
    found = delta_lloyd.delta_lloyd(points, delta_lloyd.first_centroids(points, 6, 4), 50)
    moved, changed = zip(*found.history)
    assert moved[0] == 300 and changed[-1] == 0 and len(changed) < 50 and sum(moved[1:]) < 300
    seen = []
    real = delta_lloyd.distances
    q = np.array([r.q for r in points.collect()], np.int64)
    cluster, distance = delta_lloyd.nearest(q, np.full(len(q), -1), np.zeros(len(q), np.int64), found.centroids, np.arange(6))
    delta_lloyd.distances = lambda p, c: seen.append((len(p), len(c))) or real(p, c)
    try:
        centroids = found.centroids.copy()
        centroids[2] += 40
        again = delta_lloyd.nearest(q, cluster, distance, centroids, np.array([2]))
    finally:
        delta_lloyd.distances = real
    mine = int((cluster == 2).sum())
    assert seen == [(mine, 6), (len(q) - mine, 1)]  # all centroids for those whose owner moved, one for the rest
    full = real(q, centroids)
    assert (again[0] == full.argmin(1)).all() and (again[1] == full.min(1)).all()
