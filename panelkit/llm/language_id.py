"""Language identification.

Method: sparse multinomial logistic regression on TF-IDF weights of hashed
character n-grams, trained by follow-the-regularised-leader with elastic-net
penalties, then calibrated by one temperature.

Document frequencies are counted over all labelled documents that may be
learned from; the regression is fitted on a bounded sample of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucket_of, spare_prefix

#: Orders of the character n-grams, and hash buckets for all of them.
ORDERS, BUCKETS = (1, 2, 3), 1 << 16
#: Documents of the fitted sample: expected for each language, and in all at most.
PER_LANGUAGE, IN_ALL = 400, 8000
#: Labels learned at most, the most frequent ones: the model travels to all tasks, 256 KB a label.
LANGUAGES = 256
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 0.001, 0.01
#: Weight of all n-grams of a document together.
SCALE = 40.0
UNDETERMINED = "und"

_U32 = np.uint32


def gram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, count per text) of all n-grams of the lower-cased texts, in text order."""
    clean = [t.replace("\0", " ").lower() for t in texts]
    points = np.frombuffer("\0".join([*clean, ""]).encode("utf-32-le"), dtype=_U32)
    length = np.fromiter((len(t) for t in clean), np.int64, len(clean))
    begin = np.cumsum(length + 1) - length - 1
    odd = np.array([2654435761, 2246822519, 3266489917], _U32)
    parts, counts = [], []
    with np.errstate(over="ignore"):
        rolled = np.zeros(len(points), _U32)
        for k in ORDERS:
            rolled = rolled[:len(points) - k + 1] * odd[0] + points[k - 1:] * odd[1]
            h = (rolled ^ (rolled >> _U32(15))) * odd[2] + _U32(k)
            parts.append(((h ^ (h >> _U32(13))) * odd[1]) >> _U32(16))
            counts.append(np.maximum(length - k + 1, 0))
    out = np.empty((int(sum(c.sum() for c in counts))), np.uint16)
    count = sum(counts)
    first = np.cumsum(count) - count
    for part, n in zip(parts, counts):
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(first, n) + at] = part[np.repeat(begin, n) + at]
        first = first + n
    return out, count


def _batches(texts: list[str], limit: int = 1_000_000):
    begin, total = 0, 0
    for i, t in enumerate(texts):
        if i > begin and total + len(t) > limit:
            yield begin, i
            begin, total = i, 0
        total += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def _count_documents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents with each bucket, of one partition; bucket -1: all documents."""
    found = np.zeros(BUCKETS, np.int64)
    seen = np.zeros(BUCKETS, np.int8)
    documents = 0
    for frame in frames:
        texts = list(frame["text"])
        documents += len(texts)
        for lo, hi in _batches(texts):
            buckets, count = gram_buckets(texts[lo:hi])
            for first, n in zip(np.cumsum(count) - count, count):
                own = buckets[first:first + n]
                seen[own] = 1
                found += seen
                seen[own] = 0
    used = np.flatnonzero(found)
    yield pd.DataFrame({"bucket": np.append(used, -1), "n": np.append(found[used], documents)})


def _sparse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sample rows as (rank, lang, distinct buckets, counts)."""
    for frame in frames:
        index, tf = [], []
        for t in frame["text"]:
            buckets, _ = gram_buckets([t])
            own, n = np.unique(buckets, return_counts=True)
            index.append(own.astype(np.uint16).tobytes())
            tf.append(n.astype(np.int32).tobytes())
        yield pd.DataFrame({"rank": frame["rank"].array, "lang": frame["lang"].array, "buckets": index, "counts": tf})


class Ftrl:
    """Follow-the-regularised-leader for a multinomial logistic regression."""

    def __init__(self, features: int, classes: int):
        self.z = np.zeros((features, classes))
        self.n = np.zeros((features, classes))

    def weights(self, index) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, index: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(index)
        error = softmax(x @ w)
        error[label] -= 1.0
        g = x[:, None] * error
        n = self.n[index]
        self.z[index] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[index] = n + g * g


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of least negative log-likelihood on held-back rows (golden section, log scale).

    The targets are smoothed by one count a class, as a sample without an error
    is no proof of certainty.
    """
    if not len(labels):
        return 1.0
    rows, classes = logits.shape
    target = np.full((rows, classes), 1.0 / (rows + classes))
    target[np.arange(rows), labels] = 1.0 - (classes - 1.0) / (rows + classes)

    def loss(t: float) -> float:
        return -(target * np.log(np.maximum(softmax(logits / np.exp(t)), 1e-300))).sum(axis=1).mean()

    lo, hi, g = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


class Model:
    """``table[bucket]``: logit a gram adds to each language, before division by the gram count."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, heat: float):
        self.languages, self.table, self.bias, self.heat = languages, table, bias, heat

    def logits(self, texts: list[str]) -> np.ndarray:
        buckets, count = gram_buckets(texts)
        out = np.tile(self.bias.astype(np.float64), (len(texts), 1))
        rows = np.flatnonzero(count)
        first = (np.cumsum(count) - count)[rows]
        for c in range(len(self.languages) if len(rows) else 0):
            out[rows, c] += np.add.reduceat(self.table[c][buckets], first) / count[rows]
        return out


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model from the rows for which ``learn`` holds and the label is not NULL.

    Collected: the counts of the LANGUAGES most frequent labels, which are those
    learned, BUCKETS frequencies and the sample (about PER_LANGUAGE documents a
    language and IN_ALL in all, never more than twice that, as distinct buckets).
    """
    rows = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("rank"))
    counted = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    sizes = {r["lang"]: r["count"] for r in counted.collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros(0), 1.0)
    counts = rows.select("text").mapInPandas(_count_documents, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    frequency = np.zeros(BUCKETS)
    documents = 0
    for r in counts:
        if r["bucket"] < 0:
            documents = r["n"]
        else:
            frequency[r["bucket"]] = r["n"]
    idf = np.log((1.0 + documents) / (1.0 + frequency)) + 1.0

    wanted = min(PER_LANGUAGE, max(1, IN_ALL // len(languages)))
    share = F.create_map(*[x for lang in languages for x in (F.lit(lang), F.lit(min(1.0, wanted / sizes[lang])))])
    place = F.pmod("rank", F.lit(1_000_003)) / F.lit(1_000_003.0)
    sample = rows.filter(place < share[F.col("lang")]).dropDuplicates(["rank", "lang"]).select("rank", "lang", "text").mapInPandas(
        _sparse, "rank long, lang string, buckets binary, counts binary").orderBy("rank", "lang").limit(2 * IN_ALL).collect()
    sample.sort(key=lambda r: (r["rank"], r["lang"], bytes(r["buckets"])))
    examples = []
    for r in sample:
        index = np.frombuffer(r["buckets"], np.uint16).astype(np.int64)
        tf = np.frombuffer(r["counts"], np.int32)
        if len(index):
            x = SCALE * tf / tf.sum() * idf[index]
            examples.append((np.append(index, BUCKETS), np.append(x, 1.0), languages.index(r["lang"])))
    back = [e for i, e in enumerate(examples) if i % 5 == 4]
    train = [e for i, e in enumerate(examples) if i % 5 != 4]
    ftrl = Ftrl(BUCKETS + 1, len(languages))
    for _ in range(EPOCHS):
        for index, x, label in train:
            ftrl.learn(index, x, label)
    w = ftrl.weights(slice(None))
    logits = np.array([x @ w[index] for index, x, _ in back]).reshape(len(back), len(languages))
    heat = temperature(logits, np.array([e[2] for e in back], int))
    table = np.ascontiguousarray((w[:BUCKETS] * (SCALE * idf)[:, None]).T.astype(np.float32))
    return Model(languages, table, w[BUCKETS], heat)


def predict(text: Column, model: Model) -> Column:
    """struct(lang, score): ``und`` with score 0 for a NULL text, one without a letter, or an empty model."""
    languages, table, bias, heat = model.languages, model.table, model.bias, model.heat

    @F.pandas_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        own = Model(languages, table, bias, heat)
        name, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if languages and t is not None and any(c.isalpha() for c in t)]
        chosen = [texts.iloc[i] for i in known]
        for lo, hi in _batches(chosen):
            p = softmax(own.logits(chosen[lo:hi]) / heat)
            for i, best, s in zip(known[lo:hi], p.argmax(axis=1), p.max(axis=1)):
                name[i], score[i] = languages[best], s
        return pd.DataFrame({"lang": name, "score": score})

    return run(text)


def has_letter(text: Column) -> Column:
    """Whether a text has a letter; false for NULL."""

    @F.pandas_udf("boolean")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([t is not None and any(c.isalpha() for c in t) for t in texts], dtype=bool)

    return run(text)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 4, is 2 (a NULL id is the empty text)."""
    return bucket_of(F.col(id_col), 4) == 2


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score), one row per document.

    Learns from ``docs`` outside the held-out rows; the text alone decides a
    prediction.  Defined cases: a NULL text, one without a letter, and every
    text where nothing could be learned, is ``und`` with score 0; NULL labels
    are not learned; NULL ids are never held out; repeated rows are each
    predicted (alike) and each counted; other columns are not read.
    """
    model = fit(docs, ~held_out(id_col), id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), predict(F.col(text_col), model).alias("p"))
    return rows.select(F.col("id").alias(id_col), "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def keep_known(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` with a predicted language; ``und`` rows go.  All columns as they are.

    Where nothing could be learned, no language tells rows apart: only NULL
    texts and texts without a letter go.
    """
    model = fit(docs, ~held_out(id_col), id_col, text_col, lang_col)
    if not model.languages:
        return docs.filter(has_letter(F.col(text_col)))
    name = f"{spare_prefix(docs)}p"
    return docs.withColumn(name, predict(F.col(text_col), model)).filter(F.col(f"{name}.lang") != UNDETERMINED).drop(name)
