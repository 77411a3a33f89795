"""Exact centroid clustering over space-filling-curve zone maps.

Method: vectors become integers and are ordered along a Hilbert curve over the
dimensions of greatest spread; runs of the order are blocks that keep the least
and greatest value of every dimension.  The distances from a block's box to a
centroid bound those of all its vectors: centroids that another one beats over
the whole box are no candidates.  A block with one candidate is assigned whole
by its stored sums; the others are compared exactly with their candidates, in
integers.  Every round reads the same written blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release

#: Vectors in a block; dimensions and bits of each on the curve.
BLOCK, CURVE_DIMS, CURVE_BITS = 64, 8, 4
#: Components up to this are compared in 64-bit integers, larger ones in Python's.
_NARROW = 1 << 26
_LONG = 2**63 - 1


def hilbert_keys(levels: np.ndarray, bits: int) -> np.ndarray:
    """Index on the curve (uint64) of rows of integer levels 0 .. 2**bits - 1; dims * bits <= 64.

    Axes are turned to the transposed index a bit plane at a time, for all rows
    at once, and the planes are then interleaved.
    """
    x = levels.astype(np.uint64).copy()
    n, dims = x.shape
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q, low = one << np.uint64(b), (one << np.uint64(b)) - one
        for i in range(dims):
            up = (x[:, i] & q) != 0
            swap = np.where(up, np.uint64(0), (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(up, low, swap)
            x[:, i] ^= swap
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(n, np.uint64)
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        flip ^= np.where((x[:, dims - 1] & q) != 0, q - one, np.uint64(0))
    x ^= flip[:, None]
    key = np.zeros(n, np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << one) | ((x[:, i] >> np.uint64(b)) & one)
    return key


def integers(rows: list, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, held to the long range: int64, or Python integers if any is large."""
    f = np.floor(scale * np.array(rows, np.float64).reshape(len(rows), -1))
    if np.abs(f).max(initial=0) <= _NARROW:
        return f.astype(np.int64)
    return np.array([[min(max(int(x), -_LONG - 1), _LONG) for x in row] for row in f], object)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a vector of the box.

    No vector is nearer to a centroid than the box is; none is farther than the
    box's farthest corner.  A centroid stays unless the box is farther from it
    than some other centroid's farthest corner.
    """
    beyond = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    reach = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    nearest, farthest = (beyond * beyond).sum(axis=1), (reach * reach).sum(axis=1)
    return np.flatnonzero(nearest <= farthest.min())


def compare(vectors: np.ndarray, among: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector, of the centroids ``among``; ties go to the smaller number."""
    d = vectors[:, None, :] - centroids[None, among, :]
    d = (d * d).sum(axis=2)
    best = np.argmin(d, axis=1)
    return among[best], d[np.arange(len(d)), best]


def kept_vectors(vectors: DataFrame, dim: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the vectors with ``dim`` components, none NULL or non-finite."""
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    own = vectors.schema[vector_col].dataType.simpleString()
    x = F.col(vector_col) if own in ("array<float>", "array<double>") else F.col(vector_col).cast("array<double>")
    return vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x")).filter((F.size("x") == dim) & ~bad)


def zone_blocks(rows: DataFrame, dim: int, scale: int) -> DataFrame:
    """(ids, missing, matrix, low, high, total, wide) blocks of ``rows`` along the curve, materialised.

    Integers as bytes: the ids with a mark of those that are NULL, the vectors
    (32 bits), the box's two corners (32) and the sum of the vectors (64).
    Vectors with components beyond 2**26 are decimal text in ``wide`` instead.
    """
    # Spread and range of every dimension: one row, whatever the table's size.
    stats = rows.agg(*[f(F.col("x")[i].cast("double")).alias(f"{n}{i}") for i in range(dim)
                       for n, f in (("s", F.stddev_pop), ("l", F.min), ("h", F.max))]).first()
    axes = sorted(range(dim), key=lambda i: (-(stats[f"s{i}"] or 0.0), i))[:CURVE_DIMS]
    low = np.array([stats[f"l{i}"] or 0.0 for i in axes])
    width = np.array([stats[f"h{i}"] or 0.0 for i in axes]) - low
    cells = 1 << CURVE_BITS

    @F.pandas_udf("long")
    def place(xs: pd.Series) -> pd.Series:
        m = np.stack(xs.to_numpy())[:, axes].astype(np.float64)
        share = np.divide(m - low, width, out=np.zeros_like(m), where=width > 0)
        return pd.Series(hilbert_keys(np.clip(share * cells, 0, cells - 1).astype(np.int64), CURVE_BITS).view(np.int64))

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for at in range(0, len(frame), BLOCK):
                part = frame.iloc[at:at + BLOCK]
                v = integers(list(part["x"]), scale)
                narrow = v.dtype != object
                out.append({
                    "ids": np.array([int(i or 0) for i in part["id"]], np.int64).tobytes(),
                    "missing": np.array([i is None for i in part["id"]]).tobytes(),
                    "matrix": v.astype(np.int32).tobytes() if narrow else None,
                    "low": v.min(axis=0).astype(np.int32).tobytes() if narrow else None,
                    "high": v.max(axis=0).astype(np.int32).tobytes() if narrow else None,
                    "total": v.sum(axis=0).tobytes() if narrow else None,
                    "wide": None if narrow else ",".join(map(str, v.ravel()))})
            yield pd.DataFrame(out)

    # The vector and the id end the key, so that equal vectors are split over ranges too.
    by = ["h", "x", "id"]
    ordered = rows.select("id", "x", place("x").alias("h")).repartitionByRange(*by).sortWithinPartitions(*by)
    # The id goes as text: a NULL among them must not turn longs into floats.
    blocks = ordered.select(F.col("id").cast("string").alias("id"), "x").mapInPandas(
        build, "ids binary, missing binary, matrix binary, low binary, high binary, total binary, wide string")
    return materialize(blocks, "blocks")


def _opened(frames: Iterator[pd.DataFrame], dim: int):
    """(ids, missing, vectors, low, high, total) of every block."""
    for frame in frames:
        for r in frame.itertuples(index=False):
            ids, missing = np.frombuffer(r.ids, np.int64), np.frombuffer(r.missing, bool)
            if r.wide is None:
                i32 = lambda b: np.frombuffer(b, np.int32).astype(np.int64)
                yield ids, missing, i32(r.matrix).reshape(-1, dim), i32(r.low), i32(r.high), np.frombuffer(r.total, np.int64)
            else:
                v = np.array([int(x) for x in r.wide.split(",")], object).reshape(-1, dim)
                yield ids, missing, v, v.min(axis=0), v.max(axis=0), v.sum(axis=0)


def _centres(centroids: list[list[int]]) -> np.ndarray:
    wide = any(abs(x) > _NARROW for c in centroids for x in c)
    return np.array(centroids, object if wide else np.int64)


def cluster_sums(blocks: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sum of each cluster's vectors; empty clusters are absent.

    Every task adds up its blocks, Spark adds up the tasks; one row a cluster
    and dimension comes to the driver.
    """
    dim = len(centroids[0])
    centres = _centres(centroids)

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, total = [0] * len(centres), np.zeros((len(centres), dim), object)
        for _, _, v, low, high, all_ in _opened(frames, dim):
            among = candidates(low, high, centres)
            if len(among) == 1:
                count[among[0]] += len(v)
                total[among[0]] += all_
                continue
            own, _ = compare(v, among, centres)
            for c in np.unique(own):
                count[c] += int((own == c).sum())
                total[c] += v[own == c].sum(axis=0)
        rows = [(c, d, Decimal(int(x))) for c, n in enumerate(count) if n for d, x in enumerate([n, *total[c]], -1)]
        yield pd.DataFrame(rows, columns=["cluster", "d", "n"])

    sums = blocks.mapInPandas(add, "cluster int, d int, n decimal(38,0)").groupBy("cluster", "d").agg(F.sum("n").alias("n"))
    got = {(r["cluster"], r["d"]): int(r["n"]) for r in sums.collect()}
    return {c: (n, [got[c, d] for d in range(dim)]) for (c, i), n in got.items() if i == -1}


def assigned(blocks: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(id, cluster, distance) of every vector; distances beyond a long are held to its limit."""
    dim = len(centroids[0])
    centres = _centres(centroids)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, missing, v, low, high, _ in _opened(frames, dim):
            own, distance = compare(v, candidates(low, high, centres), centres)
            yield pd.DataFrame({"id": pd.arrays.IntegerArray(ids.copy(), missing.copy()), "cluster": own.astype(np.int32),
                                "distance": np.minimum(distance, _LONG).astype(np.int64)})

    return blocks.mapInPandas(run, "id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: int = 1,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per kept vector.

    Kept are vectors with exactly ``dim`` components, none NULL or non-finite;
    components become floor(scale * x), x as double.  Centroids start as the k
    vectors with the smallest sha256 of ``seed:id``; each round assigns every
    vector to its nearest centroid and replaces a centroid by the exact floored
    mean of its vectors.  Only k centroids and their sums meet on the driver.
    Defined cases: a NULL id hashes as the empty id; equal hashes are ordered by
    id, then by vector; repeated rows count each; with fewer vectors than k
    there are as many centroids; an empty cluster keeps its centroid; components,
    distances and sums beyond a long are held to its limits; other columns are
    not read; without a kept vector the result is empty.
    """
    rows = kept_vectors(vectors, dim, id_col, vector_col)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = rows.select(key.alias("key"), "id", "x").orderBy("key", F.col("id").asc_nulls_first(), "x").limit(k).collect()
    if not first:
        return rows.sparkSession.createDataFrame([], f"{id_col} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = [[int(x) for x in v] for v in integers([r["x"] for r in first], scale)]
    blocks = zone_blocks(rows, dim, scale)
    for _ in range(rounds):
        sums = cluster_sums(blocks, centroids)
        centroids = [[x // sums[c][0] for x in sums[c][1]] if c in sums else own for c, own in enumerate(centroids)]
    out = materialize(assigned(blocks, centroids), "assigned")
    release(blocks)
    spent = {r["cluster"]: int(r["n"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}
    named = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    of = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1)
    long = lambda n: F.lit(min(n, _LONG)).cast("long")
    return out.select(F.col("id").alias(id_col), "cluster", "distance", of([long(spent.get(c, 0)) for c in range(len(centroids))]).alias("cluster_inertia"),
                      long(sum(spent.values())).alias("inertia"), of([F.lit(h) for h in named]).alias("centroid_sha256"))
