import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lullcast.llm.clustering import Clustering, centroid_clusters, first_centroids, loosening, usable

SCHEMA = (
    "vec_id bigint, embedding array<float>, label int, cluster string, block string, ids string,"
    " distance string, row string, v string, apart string"
)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, *["x"] * 7) for i, v in rows], SCHEMA)


def brute_force(rows, size, k, rounds=10, seed="3"):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    order = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=order)[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for r in range(rounds + 1):
        own = [min(range(len(centroids)), key=lambda c: (apart(v, centroids[c]), c)) for _, v in kept]
        if r == rounds:
            break
        for c in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own) if o == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    out = []
    distances = [apart(v, centroids[o]) for (_, v), o in zip(kept, own)]
    narrow = lambda n: n if n < 1 << 63 else None
    for (i, _), o, d in zip(kept, own, distances):
        inertia = sum(e for e, p in zip(distances, own) if p == o)
        text = ",".join(map(str, centroids[o]))
        out.append((i, o, narrow(d), narrow(inertia), narrow(sum(distances)), hashlib.sha256(text.encode()).hexdigest()))
    return out


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("seed, k", [(1, 8), (2, 3), (3, 1)])
def test_equals_brute_force(spark, seed, k):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, 5)) * 2
    rows = [(i, (centres[i % 6] + r.normal(size=5) * 0.5).tolist()) for i in range(400)]
    found = centroid_clusters(table(spark, rows).repartition(5), k, size=5).collect()
    assert in_order(found) == in_order(brute_force(rows, 5, k))


def test_odd_vectors(spark):
    r = random.Random(5)
    inf, nan = float("inf"), float("nan")
    rows = [(1, None), (2, []), (3, [1.0, 2.0]), (4, [nan, 0, 0]), (5, [inf, 0, 0]), (6, [None, 0.0, 0.0])]
    rows += [(7, [0.0, 0.0, 0.0])] * 3 + [(None, [1.0, 1.0, 1.0]), (7, [-1.0, 2.0, 0.5])]
    rows = [(i, v and [None if x is None else float(x) for x in v]) for i, v in rows]
    rows += [(100 + i, [r.choice((-1.0, 0.0, 1.0)) for _ in range(3)]) for i in range(40)]  # ties
    found = centroid_clusters(table(spark, rows), 4, size=3).collect()
    assert in_order(found) == in_order(brute_force(rows, 3, 4))


def test_large_numbers(spark):
    r = random.Random(6)
    rows = [(i, [r.uniform(-1, 1) * 10.0 ** r.choice((0, 4, 6, 30)) for _ in range(3)]) for i in range(30)]
    found = centroid_clusters(table(spark, rows), 4, size=3).collect()
    assert in_order(found) == in_order(brute_force(rows, 3, 4))


def test_few_vectors_and_none(spark):
    rows = [(1, [0.0, 1.0]), (2, [5.0, 1.0])]
    found = centroid_clusters(table(spark, rows), 8, size=2).collect()
    assert in_order(found) == in_order(brute_force(rows, 2, 8))
    assert centroid_clusters(table(spark, []), size=2).collect() == []


def test_bounds_save_comparisons(spark):
    """Of separated clusters hardly any vector is compared with all centroids again."""
    r = np.random.default_rng(1)
    centres = r.normal(size=(8, 16)) * 10
    rows = [(i, (centres[i % 8] + r.normal(size=16)).tolist()) for i in range(2000)]
    kept = usable(table(spark, rows).select("vec_id", "embedding"), "embedding", 16)
    found = Clustering(spark, kept, 16, 1024)
    found.start(first_centroids(kept, 8, "3", 1024))
    for _ in range(6):
        found.step()
    assert found.scanned[0] == 2000
    assert sum(found.scanned[1:]) < 0.7 * 6 * 2000
    assert found.scanned[-1] < 1000


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 5))
def test_loosening_holds_in_the_whole_sphere(seed, size):
    r = np.random.default_rng(seed)
    old = r.normal(size=(3, size)) * r.choice((1, 5))
    new = old + r.normal(size=(3, size)) * r.choice((0.1, 1, 5))
    radii = r.uniform(0, 3, 3)
    bound = loosening(old, new, radii)
    drift = np.linalg.norm(new - old, axis=1)
    assert (bound <= drift[None, :] + 1e-12).all()
    for i in range(3):
        way = r.normal(size=(300, size))
        way *= radii[i] * r.uniform(0.9, 1, (300, 1)) / np.linalg.norm(way, axis=1, keepdims=True)
        points = old[i] + way
        for j in range(3):
            falls = np.linalg.norm(points - old[j], axis=1) - np.linalg.norm(points - new[j], axis=1)
            assert falls.max() <= bound[i, j] + 1e-9


def test_loosening_is_less_than_the_drift():
    old = np.array([[0.0, 0.0], [10.0, 0.0]])
    new = np.array([[0.0, 0.0], [10.0, 3.0]])  # sideways
    assert loosening(old, new, np.array([1.0, 1.0]))[0, 1] < 0.8
