"""Exact top-k inner-product search with block-at-a-time pruning.

Method: vectors are forward-indexed in blocks of a document range; a block
keeps, per term (vector component), the least and the greatest weight.  For a
query the sum of its weights times those maxima bounds every score of a block.
Blocks are scored in descending order of that bound until it falls below the
query's k-th best score.

Ranges are pruned the same way before anything is shipped to them.  A block of
queries first meets the one range with the greatest summed bounds; the k-th
scores found there stand against the bounds of all other ranges, and only those
that some query's bound reaches are joined.  Query blocks and document ranges
meet pairwise, so that no task holds more than one of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import globally_ordered, materialize, ranked, release

#: Vectors in a block, blocks in a document range, queries in a query block.
BLOCK, RANGE_BLOCKS, QUERY_BLOCK = 128, 64, 1024
#: Document ranges at most: their maxima and minima travel to all tasks.  Beyond, ranges have more blocks.
RANGES = 16_384

#: Below this, float64 products are exact and a position fits beside the score.
_EXACT = 2.0**40


def _pack(frame_ids, vectors, uids) -> dict:
    """One block: ids, row numbers and a dense matrix (short vectors end in zeros)."""
    dim = max((len(v) for v in vectors), default=0)
    m = np.zeros((len(vectors), dim), dtype=np.int64)
    for i, v in enumerate(vectors):
        m[i, :len(v)] = v
    return {"ids": np.asarray(frame_ids, np.int64).tobytes(), "uids": np.asarray(uids, np.int64).tobytes(),
            "matrix": m.tobytes(), "dim": dim}


def _blocks(rows: DataFrame, size: int, per_group: int | None, name: str) -> DataFrame:
    """Blocks of ``size`` rows in id order; ``per_group`` blocks make a group (None: as many as RANGES groups need)."""

    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rank")
        return pd.DataFrame([{"grp": key[0], **_pack(part["id"], list(part["v"]), part["uid"])}
                             for _, part in frame.groupby(frame["rank"] // size)])

    ordered = globally_ordered(rows, [F.col("id"), F.col("uid")], name)
    if per_group is None:
        per_group = max(RANGE_BLOCKS, -(-ordered.count() // (size * RANGES)))
    placed = ranked(ordered).select(F.expr(f"_rank div {size * per_group}").alias("grp"), F.col("_rank").alias("rank"), "id", "uid", "v")
    out = materialize(placed.groupBy("grp").applyInPandas(build, "grp long, ids binary, uids binary, matrix binary, dim int"), f"{name}_blocks")
    release(ordered)
    return out


def range_limits(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(range, low, high): least and greatest weight of every term in each range, at most RANGES of them.

    Shorter vectors are continued with zeros, so terms that only some blocks have reach from or to zero.
    """

    def limits(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        dim = int(frame["dim"].max())
        blocks = _unpack(frame, dim)
        return pd.DataFrame([{"r": key[0], "low": np.min([m.min(axis=0) for _, _, m in blocks], axis=0).tolist(),
                              "high": np.max([m.max(axis=0) for _, _, m in blocks], axis=0).tolist()}])

    rows = sorted(docs.groupBy("grp").applyInPandas(limits, "r long, low array<long>, high array<long>").collect(), key=lambda r: r["r"])
    dim = max((len(r["low"]) for r in rows), default=0)
    # a term that a range's vectors all lack is zero there
    pad = lambda a: np.pad(np.array(a, np.float64), (0, dim - len(a)))
    wide = lambda n: np.stack([pad(r[n]) for r in rows]) if rows else np.zeros((0, 0))
    return np.array([r["r"] for r in rows], np.int64), wide("low"), wide("high")


def range_bounds(query: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Bound of every query's score in every range.

    Rounded up by more than float64 can lose, so that no range is left out for want of digits.
    """
    q = np.zeros((len(query), low.shape[1]))
    own = min(query.shape[1], low.shape[1])
    q[:, :own] = query[:, :own]
    bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    size = np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T
    return bound + size * (q.shape[1] + 4) * 2.0**-52


def _unpack(rows: pd.DataFrame, dim: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    out = []
    for ids, uids, matrix, d in zip(rows["ids"], rows["uids"], rows["matrix"], rows["dim"]):
        ids, uids = np.frombuffer(ids, np.int64), np.frombuffer(uids, np.int64)
        m = np.frombuffer(matrix, np.int64).reshape(len(ids), d)
        out.append((ids, uids, np.pad(m, ((0, 0), (0, dim - d)))))
    return sorted(out, key=lambda b: (b[0][0], b[1][0]))


def search_range(query: np.ndarray, query_uid: np.ndarray, blocks: list, k: int, kth_before=None):
    """Best k of one document range for each query: (query index, ids, scores) lists.

    ``blocks``: (ids, uids, matrix) in id order.  Ties go to the smaller id.
    ``kth_before``: k-th scores that the queries have elsewhere (None: fewer
    than k); blocks whose bound lies below are not scored.
    """
    ids = np.concatenate([b[0] for b in blocks])
    uids = np.concatenate([b[1] for b in blocks])
    place = np.argsort(uids)
    at = place[np.minimum(np.searchsorted(uids, query_uid, sorter=place), len(uids) - 1)]
    own = np.where(uids[at] == query_uid, at, -1)
    begin = np.cumsum([0] + [len(b[0]) for b in blocks])
    largest = max(float(np.abs(b[2].astype(np.float64)).max(initial=0)) for b in blocks)
    if np.abs(query.astype(np.float64)).sum(axis=1).max(initial=0) * largest >= _EXACT:
        return _search_wide(query, own, ids, np.concatenate([b[2] for b in blocks]), k)
    q = query.astype(np.float64)
    matrix = [b[2].astype(np.float64) for b in blocks]
    low = np.stack([m.min(axis=0) for m in matrix])
    high = np.stack([m.max(axis=0) for m in matrix])
    bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    order = np.argsort(-bound, axis=1, kind="stable")
    # A key holds score and position: greater is better, and no two are equal.
    wide = np.int64(len(ids) + 1)
    none = np.iinfo(np.int64).min
    best = np.full((len(q), k), none)
    least = np.full(len(q), -np.inf)
    if kth_before is not None:
        least = np.array([-np.inf if x is None or x != x else float(x) for x in kth_before])
    for step in range(len(blocks)):
        block = order[:, step]
        kth = best[:, 0]
        reach = bound[np.arange(len(q)), block]
        open_ = (reach >= least) & ((kth == none) | (reach >= np.floor_divide(kth, wide)))
        if not open_.any():
            break
        for b in np.unique(block[open_]):
            rows = np.flatnonzero(open_ & (block == b))
            score = np.rint(q[rows] @ matrix[b].T).astype(np.int64)
            pos = np.arange(begin[b], begin[b + 1])
            key = score * wide + (wide - 1 - pos)
            key[own[rows][:, None] == pos] = none
            both = np.concatenate([best[rows], key], axis=1)
            best[rows] = np.sort(np.partition(both, both.shape[1] - k, axis=1)[:, -k:], axis=1)
    found = []
    for i, keys in enumerate(best):
        keys = keys[keys != none][::-1]
        found.append((i, ids[wide - 1 - keys % wide], keys // wide))
    return found


def _search_wide(query, own, ids, matrix, k):
    """The same for weights whose products pass float64: Python integers, held to the long range."""
    found = []
    for i, q in enumerate(query):
        score = matrix.astype(object) @ q.astype(object) if matrix.shape[1] else np.zeros(len(ids), object)
        score = [min(max(int(s), -2**63), 2**63 - 1) for s in score]
        order = sorted((j for j in range(len(ids)) if j != own[i]), key=lambda j: (-score[j], ids[j]))[:k]
        found.append((i, ids[order], np.array([score[j] for j in order], np.int64)))
    return found


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k best other rows.

    Components become floor(scale * x), x as double; the score is their integer
    inner product; equal scores go to the smaller id.  Defined cases: rows with
    a NULL id, a NULL vector or a NULL or non-finite component take no part;
    shorter vectors are continued with zeros, an empty one scores 0; a repeated
    row is a row of its own, as query and as candidate; other columns are not
    read; with no queries or candidates the result is empty; products beyond
    a long are held to its limits.
    """
    vec = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    bad = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    clean = (vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("x"), is_query.alias("is_query"))
             .filter(F.col("id").isNotNull() & F.col("x").isNotNull()).filter(~bad)
             .select("id", F.transform("x", lambda x: F.floor(x * scale)).alias("v"),
                     F.coalesce("is_query", F.lit(False)).alias("is_query"),
                     F.monotonically_increasing_id().alias("uid")))
    clean = materialize(clean, "vectors")
    docs = _blocks(clean, BLOCK, None, "ordered")
    asked = _blocks(clean.filter("is_query"), QUERY_BLOCK, 1, "asked")
    release(clean)
    limits = range_limits(docs)

    first = materialize(_meet(docs, asked, _pairs(asked, limits, None), k), "first")
    kth = first.groupBy("quid").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")).filter(F.col("n") == k).select("quid", "kth")
    known = _with_thresholds(asked, kth)
    rest = _meet(docs, known, _pairs(known, limits, k), k)
    out = materialize(first.unionByName(rest), "found")
    release(docs, asked, known, first)
    rank = F.row_number().over(Window.partitionBy("quid").orderBy(F.desc("score"), F.asc("vec_id")))
    return (out.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _with_thresholds(asked: DataFrame, kth: DataFrame) -> DataFrame:
    """Query blocks with the k-th scores of their queries so far (``kth``: NULL for a query that has fewer than k)."""

    def quids(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for grp, uids in zip(frame["grp"], frame["uids"]):
                u = np.frombuffer(uids, np.int64)
                yield pd.DataFrame({"g": grp, "place": np.arange(len(u)), "quid": u})

    listed = asked.mapInPandas(quids, "g long, place int, quid long").join(kth, "quid", "left")
    lists = listed.groupBy("g").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "kth"))), lambda x: x["kth"]).alias("kth"))
    return materialize(asked.join(lists, asked["grp"] == lists["g"]).drop("g"), "known")


def _pairs(asked: DataFrame, limits: tuple, k: int | None) -> DataFrame:
    """(g, r): ranges that each query block meets.

    Without thresholds the one with the greatest sum of the queries' bounds,
    afterwards the others that some query's bound reaches.
    """
    ranges, low, high = limits

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                query = np.frombuffer(row.matrix, np.int64).reshape(-1, row.dim) if row.dim else np.zeros((len(row.ids) // 8, 0), np.int64)
                bound = range_bounds(query.astype(np.float64), low, high)
                best = int(np.argmax(bound.sum(axis=0))) if len(ranges) else -1
                if k is None:
                    chosen = np.array([best] if best >= 0 else [], np.int64)
                else:
                    least = np.array([-np.inf if x is None or x != x else float(x) - abs(float(x)) * 2.0**-52 for x in row.kth])
                    reached = (bound >= least[:, None]).any(axis=0)
                    reached[best] = False
                    chosen = np.flatnonzero(reached)
                yield pd.DataFrame({"g": np.full(len(chosen), row.grp), "r": ranges[chosen]})

    return asked.mapInPandas(choose, "g long, r long")


def _meet(docs: DataFrame, asked: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """(quid, query_id, vec_id, score): best k of each pair's range for each of its queries."""
    pairs = materialize(pairs, "pairs")
    left = docs.join(pairs, docs["grp"] == pairs["r"]).drop("grp")
    other = pairs.select(F.col("r").alias("r2"), F.col("g").alias("g2"))
    if "kth" not in asked.columns:
        asked = asked.withColumn("kth", F.lit(None).cast("array<long>"))
    right = asked.join(other, asked["grp"] == other["g2"]).drop("grp")

    def meet(docs_in: pd.DataFrame, asked_in: pd.DataFrame) -> pd.DataFrame:
        if not len(docs_in) or not len(asked_in):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("quid", "query_id", "vec_id", "score")})
        dim = int(max(docs_in["dim"].max(), asked_in["dim"].max()))
        quid, qid, query = ([x[i] for x in _unpack(asked_in, dim)][0] for i in (1, 0, 2))
        kth = asked_in["kth"].iloc[0]
        found = search_range(query, quid, _unpack(docs_in, dim), k, kth)
        n = [len(f[1]) for f in found]
        return pd.DataFrame({"quid": np.repeat(quid, n), "query_id": np.repeat(qid, n),
                             "vec_id": np.concatenate([f[1] for f in found]),
                             "score": np.concatenate([f[2] for f in found])})

    return left.groupBy("r", "g").cogroup(right.groupBy("r2", "g2")).applyInPandas(
        meet, "quid long, query_id long, vec_id long, score long")
