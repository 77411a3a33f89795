import hashlib
import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from panelkit.llm import zone_clusters as zc

LONG = 2**63 - 1


def brute(rows, k, rounds, dim):
    kept = [(i, [min(max(math.floor(64 * x), -LONG - 1), LONG) for x in v], v) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    start = sorted(kept, key=lambda r: (name(r[0]), r[0] is not None, r[0] or 0, r[2]))[:k]
    centroids = [list(r[1]) for r in start]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    best = lambda v: min((far(v, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        own = [best(v)[1] for _, v, _ in kept]
        for n in range(len(centroids)):
            members = [v for (_, v, _), o in zip(kept, own) if o == n]
            if members:
                centroids[n] = [sum(x) // len(members) for x in zip(*members)]
    last = [(i, n, min(d, LONG)) for i, v, _ in kept for d, n in [best(v)]]
    spent = Counter()
    for _, n, d in last:
        spent[n] += d
    total = min(sum(spent.values()), LONG)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, n, d, min(spent[n], LONG), total, sha[n]) for i, n, d in last)


def run(spark, rows, k=16, rounds=3, dim=64, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr("*", "1 AS cluster", "'c' AS id", "2 AS x", "3 AS distance")
    got = zc.cluster(df, k=k, rounds=rounds, dim=dim)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return Counter(map(tuple, got.collect()))


def vectors(n, dim, seed, centres=0, spread=0.2):
    rng = random.Random(seed)
    at = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(centres)] or [[0.0] * dim]
    return [(i, [float(np.float32(c + rng.gauss(0, spread))) for c in at[i % len(at)]]) for i in range(n)]


def test_equals_brute_force(spark):
    for rows in (vectors(500, 64, 1), vectors(500, 64, 2, centres=9, spread=0.02)):
        assert run(spark, rows) == brute(rows, 16, 3, 64)


def test_ties_repeats_nulls_and_odd_vectors(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.5]) for _ in range(3)]) for i in range(300)] + [(7, [0.5, 0.5, 0.5])] * 400
    rows += [(1000, None), (1001, []), (1002, [1.0, None, 1.0]), (1003, [float("nan"), 0.0, 0.0]), (1004, [float("inf"), 0.0, 0.0]),
             (1005, [1.0]), (1006, [1.0] * 4), (None, [1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (2**60 + 1, [0.1, 0.2, 0.3])]
    assert run(spark, rows, k=5, dim=3) == brute(rows, 5, 3, 3)


def test_few_vectors_and_none(spark):
    rows = vectors(5, 4, 4)
    assert run(spark, rows, dim=4) == brute(rows, 16, 3, 4)
    assert run(spark, [], dim=4) == Counter() == run(spark, [(1, [1.0]), (2, None)], dim=4)


def test_empty_clusters_keep_their_centroid(spark):
    rows = [(i, [1.0, 2.0]) for i in range(40)] + [(100, [9.0, 9.0])]
    assert run(spark, rows, k=16, dim=2) == brute(rows, 16, 3, 2)


def test_wide_components(spark):
    rows = [(i, [float(10.0 ** (i % 12)), float(-i)]) for i in range(60)] + [(99, [1e30, -1e30]), (98, [1e30, 3.0])]
    assert run(spark, rows, k=4, dim=2, kind="double") == brute(rows, 4, 3, 2)


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = zc.hilbert_keys(points, bits)
    assert sorted(keys.tolist()) == list(range(len(points)))
    along = points[np.argsort(keys)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


def test_boxes_prune_and_lose_nothing():
    rng = np.random.default_rng(5)
    centroids = rng.integers(-60, 60, (16, 8))
    kept = 0
    for _ in range(200):
        v = centroids[rng.integers(16)] + rng.integers(-9, 10, (64, 8))
        among = zc.candidates(v.min(axis=0), v.max(axis=0), centroids)
        d = ((v[:, None] - centroids) ** 2).sum(axis=2)
        assert set(d.argmin(axis=1)) <= set(among)
        assert (zc.compare(v, among, centroids)[0] == d.argmin(axis=1)).all()
        kept += len(among)
    assert kept < 200 * 16 / 3
