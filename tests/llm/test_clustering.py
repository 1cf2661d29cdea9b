"""Integer k-means against plain loops, and the bounds that spare it most comparisons."""

import hashlib
import math
import random

import numpy as np
import pytest
from riskloom.llm import clustering

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=8, rounds=10, dimension=64):
    """(key, cluster, distance) and centroids of rows (key, vector), in Python integers."""
    kept = [(key, v) for key, v in rows if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v)]
    whole = [[int(x) * 1024 if abs(x) >= 2**53 else math.floor(1024 * x) for x in map(float, np.array(v, np.float32))] for _, v in kept]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, hashlib.sha256(f"3:{kept[i][0]}".encode()).hexdigest(), whole[i]))
    centroids = [whole[i] for i in first[:k]]

    def assign():
        far = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids] for v in whole]
        return [(d.index(min(d)), min(d)) for d in far]

    for _ in range(rounds):
        to = assign()
        for c in range(len(centroids)):
            own = [v for v, (t, _) in zip(whole, to) if t == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    return [(key, t, d) for (key, _), (t, d) in zip(kept, assign())], centroids


def plain(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0))


def check(docs, rows, schema=SCHEMA, **how):
    found = clustering.cluster(docs(rows, schema), **how)
    got = plain([(r.vec_id, r.cluster, r.distance) for r in found.rows.collect()])
    want, centroids = brute(rows, **how)
    assert found.centroids == centroids
    assert got == plain([(k, t, d if d < 2**63 else None) for k, t, d in want])


def groups(seed, n, dimension, spread=0.1):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(6, dimension)).astype(np.float32)
    return [(i, (middles[i % 6] + spread * rng.normal(size=dimension)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("dimension,k,rounds", [(64, 8, 10), (3, 5, 4), (1, 2, 3)])
def test_against_plain_loops(docs, dimension, k, rounds):
    check(docs, groups(dimension, 90, dimension), k=k, rounds=rounds, dimension=dimension)


def test_unusable_vectors_are_left_out(docs):
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 2.0]), (104, [nan, 1.0, 1.0]), (105, [1.0, -inf, 1.0]), (106, [1.0] * 4)]
    check(docs, groups(1, 20, 3) + bad, k=4, rounds=3, dimension=3)


def test_null_keys_ties_and_repeats(docs):
    same = [0.5, -0.25, 1.0]
    rows = [(i, same) for i in range(12)] + [(None, same), (None, [2.0, 0.0, 0.0]), (5, same), (7, [2.0, 0.0, 0.0]), (7, [2.0, 0.0, 0.0])]
    check(docs, rows, k=3, rounds=2, dimension=3)
    check(docs, rows[:2], k=8, rounds=2, dimension=3)


def test_components_of_any_size(docs):
    wild = [(50, [3e38, -3e38, 1.0]), (51, [1e30, 0.0, -1e-30]), (52, [131072.5, -70000.25, 9.0]), (53, [0.0, -0.0, 1e-40])]
    check(docs, groups(2, 30, 3) + wild, k=4, rounds=4, dimension=3)


def test_empty_table_and_other_columns(docs):
    assert clustering.with_inertia(clustering.cluster(docs([], SCHEMA))).collect() == []
    names = ["vector", "apex", "found", "n", "low", "r"]
    df = docs([(i, v, *names) for i, v in groups(3, 12, 3)], SCHEMA + "".join(f", {n} string" for n in names))
    found = clustering.cluster(df, k=2, rounds=2, dimension=3)
    assert found.rows.columns == [*df.columns, "cluster", "distance"]
    assert {tuple(r)[2:8] for r in found.rows.collect()} == {tuple(names)}
    with pytest.raises(ValueError):
        clustering.cluster(df.withColumnRenamed("n", "cluster"))


def test_inertia_adds_up(docs):
    rows = groups(4, 60, 3)
    found = clustering.cluster(docs(rows, SCHEMA), k=4, rounds=3, dimension=3)
    want, centroids = brute(rows, k=4, rounds=3, dimension=3)
    for r in clustering.with_inertia(found).collect():
        assert r.inertia == sum(d for *_, d in want) and r.cluster_inertia == sum(d for _, t, d in want if t == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_bounds_enclose_distances_and_keep_the_nearest():
    rng = np.random.default_rng(5)
    for trial in range(30):
        d = int(rng.integers(1, 40))
        points, centres = (rng.integers(-2000, 2000, (n, d)) for n in (200, 9))
        pivots = np.concatenate([rng.integers(-2000, 2000, (int(rng.integers(1, 9)), d)), points[:2], points[:1], centres[:1]])
        simplex = clustering.Simplex.over(pivots)
        assert 1 <= len(simplex.pivots) <= d + 1
        a, b = simplex.apexes(points), simplex.apexes(centres)
        true = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
        low = ((a[:, None] - b[None]) ** 2).sum(axis=2)
        high = low + 4 * a[:, None, -1] * b[None, :, -1]
        assert (low <= true * (1 + 1e-9) + 1).all() and (high >= true * (1 - 1e-9) - 1).all()
        alive = clustering.candidates(a, b)
        assert alive[true == true.min(axis=1, keepdims=True)].all()
        to, exact = clustering.nearest(points, a, centres, b)
        assert (to == true.argmin(axis=1)).all() and (exact == true.min(axis=1)).all()


def test_bounds_spare_most_comparisons():
    rows = groups(6, 600, 64, spread=0.05)
    vectors = clustering._integers(np.array([v for _, v in rows]), 1024)
    simplex = clustering.Simplex.over(vectors[random.Random(1).sample(range(600), 16)])
    centres = np.array([vectors[i::6].mean(axis=0).astype(int) for i in range(6)])
    alive = clustering.candidates(simplex.apexes(vectors), simplex.apexes(centres))
    assert alive.mean() < 0.5
