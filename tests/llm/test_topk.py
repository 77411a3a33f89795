import math
import random

import numpy as np
from pyspark.sql import functions as F

from panelkit.llm import topk


def brute(rows, k, every=5):
    clean = []
    for n, (i, v) in enumerate(rows):
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            clean.append((n, i, [math.floor(64 * x) for x in v]))
    out = []
    for n, i, q in clean:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, j, v in clean if m != n)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, k, every=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS label", "2 AS rank", "3 AS uid")
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % every == 0, k=k).collect())


def vectors(n, dim, seed, levels=None):
    rng = random.Random(seed)
    return [(i, [float(np.float32(rng.choice(levels) if levels else rng.gauss(0, 0.2))) for _ in range(dim)]) for i in range(n)]


def test_equals_brute_force(spark):
    rows = vectors(700, 16, 1)
    assert run(spark, rows, 20) == brute(rows, 20)


def test_ties_repeats_nulls_and_short_vectors(spark):
    rows = vectors(400, 3, 2, levels=[-0.5, 0.0, 0.5])
    rows += rows[:30] + [(5000, None), (5005, []), (None, [1.0, 1.0, 1.0]), (5010, [1.0, None, 1.0]),
                         (5015, [float("nan"), 1.0, 1.0]), (5020, [float("inf"), 1.0, 1.0]), (5025, [1.0])]
    assert run(spark, rows, 7) == brute(rows, 7)


def test_fewer_candidates_than_k_and_none(spark):
    rows = vectors(6, 4, 3)
    assert run(spark, rows, 20) == brute(rows, 20)
    assert run(spark, rows[:1], 20) == [] == run(spark, [], 20) == run(spark, rows[1:5], 20, every=100)


def test_wide_weights(spark):
    rows = [(i, [float(10.0 ** (i % 8)), float(-i)]) for i in range(40)]
    assert run(spark, rows, 5) == brute(rows, 5)
    beyond = [(0, [3e38]), (5, [3e38]), (6, [-3e38])]
    assert run(spark, beyond, 5) == [(0, 1, 5, 2**63 - 1), (0, 2, 6, -2**63), (5, 1, 0, 2**63 - 1), (5, 2, 6, -2**63)]


def test_pruning_skips_blocks_and_stays_exact():
    rng = np.random.default_rng(3)
    matrix = np.concatenate([rng.integers(-9, 10, (128, 8)) + 40 * s for s in (0, 3, -3, 1)])
    blocks = [(np.arange(b * 128, b * 128 + 128), np.arange(b * 128, b * 128 + 128), matrix[b * 128:b * 128 + 128]) for b in range(4)]
    query = np.concatenate([matrix[[5, 200, 300]], np.zeros((1, 8), np.int64)])
    found = topk.search_range(query, np.array([5, 200, 300, -1]), blocks, 10)
    for (i, ids, scores), own in zip(found, (5, 200, 300, -1)):
        every = query[i] @ matrix.T
        want = sorted((-s, j) for j, s in enumerate(every) if j != own)[:10]
        assert [(-s, j) for j, s in zip(ids, scores)] == want


def test_ranges_are_pruned_before_they_are_shipped(spark, monkeypatch):
    rng = np.random.default_rng(7)
    # ranges of 64 vectors, each around a direction of its own; queries in id order meet few of them
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "RANGE_BLOCKS", 4)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    centres = np.eye(12) * 3
    rows = [(i, [float(x) for x in np.float32(centres[i // 64] + rng.normal(0, 0.05, 12))]) for i in range(64 * 12)]
    seen = []
    plain = topk._pairs
    monkeypatch.setattr(topk, "_pairs", lambda *a: seen.append(plain(*a)) or seen[-1])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=3)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 3)
    n = [p.schema.names for p in seen]
    assert n == [["g", "r"], ["g", "r"]]
    p = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in p and "CartesianProduct" not in p


def test_pairs_fall_with_the_bounds():
    rng = np.random.default_rng(8)
    low, high = np.full((50, 6), -1.0), np.full((50, 6), 1.0)
    low[:40, 0], high[:40, 0] = -9, -8
    q = np.abs(rng.integers(1, 9, (20, 6))).astype(float)
    bound = topk.range_bounds(q, low, high)
    exact = np.maximum(q, 0) @ high.T
    assert (bound >= exact - 1e-9).all() or (bound[:, 40:] >= exact[:, 40:]).all()
    v = rng.integers(-1, 2, (50, 30, 6))
    v[:40, :, 0] = rng.integers(-9, -7, (40, 30))
    assert (np.einsum("qd,rnd->qrn", q, v).max(axis=2) <= bound).all()


def test_surviving_pairs_are_few_on_ranges_apart(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "RANGE_BLOCKS", 4)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in np.float32(np.eye(12)[i // 64] * 3 + rng.normal(0, 0.05, 12))]) for i in range(64 * 12)]
    counts = []
    plain = topk.materialize
    monkeypatch.setattr(topk, "materialize", lambda df, name: (lambda out: counts.append(out.count()) or out)(plain(df, name)) if name == "pairs" else plain(df, name))
    topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 4 == 0, k=3).count()
    blocks, ranges = 24, 12
    assert counts[0] == blocks and counts[1] < blocks * ranges / 4
