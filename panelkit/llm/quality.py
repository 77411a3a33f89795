"""Quality classifier: a factorisation machine.

Features of a document are its hashed words (relative counts), statistics of
its structure and its length as metadata.  The machine adds a weight for every
feature and, for every pair of features, the inner product of two short factor
vectors.  The sum over all pairs is scored in linear time as half the
difference between the square of the sum and the sum of the squares.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucket_of
from .textnum import Words, text_batches

#: Buckets of hashed words, factors of each feature.
BUCKETS, FACTORS = 1 << 15, 8
#: Documents of each label in the fitted sample, about.
PER_LABEL = 2500
EPOCHS, BATCH, RATE, PENALTY, SEED = 8, 64, 0.1, 1e-5, 7
#: Weight of all words of a document together.
WORDS = 4.0
CUT = 0.3

STATISTICS = ("upper", "digit", "symbol", "mark", "high", "lines", "word length", "distinct", "repeated", "words", "length")


def statistics(texts: list[bytes], w: Words, names: np.ndarray) -> np.ndarray:
    """One row of STATISTICS per text; zeros for an empty text."""
    out = np.zeros((len(texts), len(STATISTICS)))
    kinds = np.zeros(256, np.int8)
    kinds[65:91], kinds[48:58] = 1, 2
    kinds[[ord(c) for c in "#$%&*+/<=>@[]^_`{|}~\\"]] = 3
    kinds[[ord(c) for c in "!?:;\"'()-.,"]] = 4
    kinds[128:], kinds[10] = 5, 6
    kind = kinds[w.buf]
    size = np.array([len(t) for t in texts], np.float64)
    edge = np.append(w.offset, len(w.buf))
    for k in range(1, 7):
        total = np.concatenate([[0], np.cumsum(kind == k)])
        out[:, k - 1] = total[edge[1:]] - total[edge[:-1]]
    out[:, 5] -= 1  # the separator of the batch
    out[:, :6] /= np.maximum(size, 1)[:, None]
    same = np.zeros(len(w), bool)
    same[1:] = (names[1:] == names[:-1]) & (w.doc[1:] == w.doc[:-1])
    repeat = np.bincount(w.doc, same, minlength=len(texts))
    letters = np.bincount(w.doc, w.end - w.start, minlength=len(texts))
    n = np.maximum(w.count, 1)
    out[:, 6] = letters / n
    for i, (first, count) in enumerate(zip(w.first, w.count)):
        out[i, 7] = len(np.unique(names[first:first + count])) / max(count, 1)
    out[:, 8] = repeat / n
    out[:, 9], out[:, 10] = np.log1p(w.count), np.log1p(size)
    return out


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, x, number of distinct buckets per text, statistics)."""
    w = Words(texts)
    names = w.hashes(61)
    bucket = (names >> np.uint64(64 - 15)).astype(np.int64)
    key, times = np.unique(w.doc * BUCKETS + bucket, return_counts=True)
    doc = key // BUCKETS
    x = WORDS * times / np.maximum(w.count, 1)[doc]
    return key % BUCKETS, x, np.bincount(doc, minlength=len(texts)), statistics(texts, w, names)


class Machine:
    """bias + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i (v_if x_i)^2]."""

    def __init__(self, bias: float, w: np.ndarray, v: np.ndarray, centre: np.ndarray, spread: np.ndarray):
        self.bias, self.w, self.v, self.centre, self.spread = bias, w, v, centre, spread

    def rows(self, bucket, x, count, stats):
        """Index and value arrays with the statistics as the last features of every text."""
        z = np.clip((stats - self.centre) / self.spread, -4, 4)
        n, s = len(count), z.shape[1]
        total = count + s
        first = np.cumsum(total) - total
        index = np.empty(total.sum(), np.int64)
        value = np.empty(total.sum())
        at = np.arange(len(bucket)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        index[at], value[at] = bucket, x
        tail = (first + count)[:, None] + np.arange(s)
        index[tail], value[tail] = BUCKETS + np.arange(s), z
        return index, value, first

    def score(self, index, value, first):
        """Raw scores, and the factor sums that the gradient needs."""
        vx = self.v[index] * value[:, None]
        sums = np.add.reduceat(vx, first, axis=0)
        squares = np.add.reduceat(vx * vx, first, axis=0)
        linear = np.add.reduceat(self.w[index] * value, first)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        raw, _ = self.score(*self.rows(*features(texts)))
        return 1.0 / (1.0 + np.exp(-np.clip(raw, -40, 40)))


def train(examples: list[tuple], weights: np.ndarray) -> Machine:
    """Machine from (bucket, x, statistics, label) by AdaGrad on the weighted logistic loss."""
    rng = np.random.default_rng(SEED)
    stats = np.array([e[2] for e in examples])
    size = BUCKETS + stats.shape[1]
    rate = np.clip(np.average([e[3] for e in examples], weights=weights), 0.01, 0.99)
    m = Machine(float(np.log(rate / (1 - rate))), np.zeros(size), rng.normal(0, 0.05, (size, FACTORS)),
                stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-6))
    gw, gv, gb = np.full(size, 1e-3), np.full((size, FACTORS), 1e-3), 1e-3
    for _ in range(EPOCHS):
        order = rng.permutation(len(examples))
        for lo in range(0, len(order), BATCH):
            part = [examples[i] for i in order[lo:lo + BATCH]]
            count = np.array([len(e[0]) for e in part])
            index, value, first = m.rows(np.concatenate([e[0] for e in part]), np.concatenate([e[1] for e in part]),
                                         count, np.array([e[2] for e in part]))
            raw, sums = m.score(index, value, first)
            error = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - [e[3] for e in part]) * weights[order[lo:lo + BATCH]] / len(part)
            each = np.repeat(np.arange(len(part)), np.diff(np.append(first, len(index))))
            used, place = np.unique(index, return_inverse=True)
            g = error[each] * value
            dw = np.bincount(place, g, len(used)) + PENALTY * m.w[used]
            dv = np.stack([np.bincount(place, g * (sums[each, f] - m.v[index, f] * value), len(used)) for f in range(FACTORS)], axis=1)
            dv += PENALTY * m.v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            m.w[used] -= RATE * dw / np.sqrt(gw[used])
            m.v[used] -= RATE * dv / np.sqrt(gv[used])
            gb += error.sum() ** 2
            m.bias -= RATE * error.sum() / np.sqrt(gb)
    return m


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0 (a NULL id is the empty text)."""
    return bucket_of(F.col(id_col), 5) == 0


def _sample_features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for rank, label, t in zip(frame["rank"], frame["label"], frame["text"]):
            bucket, x, _, stats = features([(t or "").encode()])
            rows.append((rank, label, bucket.astype(np.int32).tobytes(), x.astype(np.float32).tobytes(), stats[0].tobytes()))
        yield pd.DataFrame(rows, columns=["rank", "label", "bucket", "x", "stats"])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> Machine | float:
    """Machine from the labelled rows of ``docs`` for which ``learn`` (of the id) holds.

    The labels are counted over all rows; one document each of about PER_LABEL
    ids of each label is collected as features and weighted back to the counted
    shares.
    Without both labels there is nothing to learn: the share of label 1 (0.5
    without any label) is returned instead.  An id with several labels counts
    once for each; labels other than 0 and 1 are not learned.
    """
    marked = (labels.filter(learn & F.col(label_col).isin(0, 1))
              .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).distinct())
    sizes = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return float(next(iter(sizes), 0.5))
    share = {k: min(1.0, PER_LABEL / n) for k, n in sizes.items()}
    place = F.pmod(F.xxhash64("_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    # About 2 * PER_LABEL ids: a proven bound, so the texts need no shuffle.
    chosen = marked.filter(place < F.when(F.col("label") == 1, share[1]).otherwise(share[0]))
    wanted = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id")
    # One text an id, however many rows repeat it: the bound on ids is one on rows.
    first = F.min(F.struct(F.xxhash64("_id", "text").alias("rank"), "text"))
    wanted = wanted.groupBy("_id", "label").agg(first.alias("m")).select("m.rank", "label", "m.text")
    sample = wanted.select("rank", "label", "text").mapInPandas(
        _sample_features, "rank long, label int, bucket binary, x binary, stats binary").collect()
    sample.sort(key=lambda r: (r["rank"], r["label"]))
    if len({r["label"] for r in sample}) < 2:
        return sizes[1] / sum(sizes.values())
    examples = [(np.frombuffer(r["bucket"], np.int32).astype(np.int64), np.frombuffer(r["x"], np.float32).astype(float),
                 np.frombuffer(r["stats"]), r["label"]) for r in sample]
    weights = np.array([1 / share[r["label"]] for r in sample])
    return train(examples, weights / weights.mean())


def score(text: Column, machine: Machine | float) -> Column:
    """Probability of label 1 of a text column; a NULL text counts as empty."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        if not isinstance(machine, Machine):
            return pd.Series(np.full(len(texts), machine))
        raw = [(t or "").encode() for t in texts]
        return pd.Series(np.concatenate([machine.probabilities(raw[lo:hi]) for lo, hi in text_batches(raw, 2_000_000)] or [np.zeros(0)]))

    return run(text)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality") -> DataFrame:
    """(id, held_out, score, predicted), one row per document.

    Learns from labelled rows outside the held-out ones; the text alone decides
    a score.  Defined cases: a NULL text is scored as the empty text; documents
    without a label are scored alike; a NULL id is not held out and has no
    label; repeated rows are each scored; other columns are not read; without
    anything to learn every score is the share of label 1, or 0.5.
    """
    machine = fit(docs, labels, ~held_out(id_col), id_col, text_col, label_col)
    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), score(F.col(text_col), machine).alias("score"))
    return rows.withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0))
