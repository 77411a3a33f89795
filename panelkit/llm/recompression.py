"""Repeated passages across documents, by recompression.

Method: words are symbols named by their hash.  Rounds replace short runs of one
symbol and then pairs of neighbours by new symbols, whose names are hashes of
what they stand for, so that naming is the same in every document without any
exchange.  A pair is merged if its left name falls into one half of a random
split of the names and its right name into the other, so whether a symbol merges
depends on its neighbours alone, and equal word sequences get equal symbols
except near their ends: a round changes at most one symbol at each end.  Merged
weights are limited, which bounds that margin in words.

Every window of WINDOW words keeps at least SYMBOLS whole symbols inside the
margins; of each GROUP phrases of PHRASE consecutive symbols the one with the
least name is an anchor.  Two equal windows thus share an anchor.  Spark rounds
find the anchors that several documents share; only windows in which all groups
of safe symbols have shared anchors are named by a 128-bit hash, and the
smallest document of each window name decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release, spare_prefix
from .textnum import Words, mix, random_words, text_batches

WINDOW = 50
#: (kind, greatest weight of a merged symbol) of each round.
ROUNDS = (("run", 2), ("pair", 2), ("pair", 2), ("pair", 4), ("pair", 4))
#: Words at each end of an equal passage whose symbols its surroundings may change.
MARGIN = sum(cap if kind == "run" else cap - 1 for kind, cap in ROUNDS)
HEAVIEST = max(cap for _, cap in ROUNDS)
SYMBOLS = -(-(WINDOW - 2 * MARGIN) // HEAVIEST)
PHRASE = 3
GROUP = SYMBOLS - PHRASE + 1

_U = np.uint64


class Symbols:
    """Symbols of a batch after all rounds: name, first word, words, document."""

    def __init__(self, name, first, size, doc):
        self.name, self.first, self.size, self.doc = name, first, size, doc

    def _merge(self, head: np.ndarray, count: np.ndarray, name: np.ndarray) -> None:
        """Symbols ``head`` swallow the ``count`` - 1 symbols after them and are renamed."""
        keep = np.ones(len(self.name), bool)
        end = self.first + self.size
        last = head + count - 1
        gone = np.zeros(len(self.name) + 1, np.int64)
        np.add.at(gone, head + 1, 1)
        np.add.at(gone, last + 1, -1)
        keep[np.cumsum(gone[:-1]) > 0] = False
        self.size = self.size.copy()
        self.size[head] = end[last] - self.first[head]
        self.name = self.name.copy()
        self.name[head] = name
        self.name, self.first, self.size, self.doc = (x[keep] for x in (self.name, self.first, self.size, self.doc))

    def run_round(self, cap: int, salt: int) -> None:
        if not len(self.name):
            return
        new = np.ones(len(self.name), bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | (self.doc[1:] != self.doc[:-1])
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(new)))
        pick = (count > 1) & (np.add.reduceat(self.size, head) <= cap)
        head, count = head[pick], count[pick]
        a, b = random_words(2, salt) | _U(1)
        with np.errstate(over="ignore"):
            self._merge(head, count, mix(self.name[head] * a + count.astype(np.uint64) * b))

    def pair_round(self, cap: int, salt: int) -> None:
        a, b, c = random_words(3, salt) | _U(1)
        with np.errstate(over="ignore"):
            right = (mix(self.name ^ c) >> _U(63)).astype(bool)
            both = (~right[:-1] & right[1:] & (self.doc[1:] == self.doc[:-1])
                    & (self.size[:-1] + self.size[1:] <= cap))
            head = np.flatnonzero(both)
            name = mix(self.name[head] * a + self.name[head + 1] * b)
        self._merge(head, np.full(len(head), 2), name)


def recompress(names: np.ndarray, doc: np.ndarray) -> Symbols:
    """All rounds over the word names of a batch (``doc``: document of each word)."""
    s = Symbols(names, np.arange(len(names)), np.ones(len(names), np.int64), doc)
    for salt, (kind, cap) in enumerate(ROUNDS):
        (s.run_round if kind == "run" else s.pair_round)(cap, 100 + salt)
    return s


class Anchors:
    """Groups of GROUP phrases of one document: words [begin, end) and the anchor's name and place."""

    def __init__(self, s: Symbols):
        n = len(s.name) - (PHRASE + GROUP - 1) + 1
        if n <= 0:
            self.name, self.begin, self.end, self.at, self.stop, self.doc = (np.zeros(0, t) for t in (np.uint64, *[np.int64] * 5))
            return
        k = random_words(PHRASE, 300) | _U(1)
        m = n + GROUP - 1
        with np.errstate(over="ignore"):
            total = s.name[:m] * k[0]
            for j in range(1, PHRASE):
                total = total + s.name[j:j + m] * k[j]
        phrase = mix(total)
        least, where = phrase[:n].copy(), np.arange(n)
        for j in range(1, GROUP):
            other = phrase[j:j + n]
            less = other < least
            least[less] = other[less]
            where[less] = np.flatnonzero(less) + j
        whole = s.doc[:n] == s.doc[PHRASE + GROUP - 2:PHRASE + GROUP - 2 + n]
        last = np.arange(n) + PHRASE + GROUP - 2
        end = s.first + s.size
        self.name, self.begin, self.end = least[whole], s.first[:n][whole], end[last][whole]
        self.at, self.stop = s.first[where][whole], end[where + PHRASE - 1][whole]
        self.doc = s.doc[:n][whole]


def _anchors(words: Words) -> Anchors:
    return Anchors(recompress(words.hashes(11), words.doc))


def window_names(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of the WINDOW words that start at each word (end of batch: shorter)."""
    out = []
    for seed in (21, 31):
        part = {1: words.hashes(seed)}
        k = 1
        while 2 * k <= WINDOW:
            part[2 * k] = _joined(part[k], part[k], k, seed)
            k *= 2
        whole, size = part[k], k
        for k in sorted(part, reverse=True)[1:]:
            if size + k <= WINDOW:
                whole, size = _joined(whole, part[k], size, seed), size + k
        out.append(whole)
    return out[0], out[1]


def _joined(left: np.ndarray, right: np.ndarray, shift: int, seed: int) -> np.ndarray:
    a, b = random_words(2, seed + shift) | _U(1)
    n = max(min(len(left), len(right) - shift), 0)
    with np.errstate(over="ignore"):
        return mix(left[:n] * a + right[shift:shift + n] * b)


def _bytes(texts: pd.Series) -> list[bytes]:
    return [(t or "").encode() for t in texts]


def _parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per row: id, k, number of words, digest of the words, names of its anchors."""
    for frame in frames:
        texts = _bytes(frame["text"])
        for lo, hi in text_batches(texts):
            w = Words(texts[lo:hi])
            a = _anchors(w)
            first = np.searchsorted(a.doc, np.arange(hi - lo + 1))
            names = [np.unique(a.name[i:j]).view(np.int64) if n >= WINDOW else np.zeros(0, np.int64)
                     for i, j, n in zip(first[:-1], first[1:], w.count)]
            yield pd.DataFrame({"id": frame["id"].iloc[lo:hi].array, "k": frame["k"].iloc[lo:hi].array, "n_words": w.count,
                                "words_sha": [hashlib.sha256(b" ".join(t.split())).digest() for t in texts[lo:hi]],
                                "anchors": names})


def candidate_windows(words: Words, shared: list[np.ndarray]) -> np.ndarray:
    """First words of the windows that may occur elsewhere, given each document's shared anchors."""
    a = _anchors(words)
    salt = random_words(len(words.count), 500)
    with np.errstate(over="ignore"):
        known = np.concatenate([mix(np.asarray(s, np.int64).view(np.uint64) + salt[i]) for i, s in enumerate(shared)] or [np.zeros(0, np.uint64)])
        found = np.isin(mix(a.name + salt[a.doc]), known)
    n = len(words)
    # A group of safe symbols whose anchor is not shared rules out the windows around it.
    ruled = np.zeros(n + WINDOW + 1, np.int64)
    lo = a.end[~found] - (WINDOW - MARGIN)
    hi = a.begin[~found] - MARGIN
    tight = (lo <= hi) & (hi >= 0)
    np.add.at(ruled, np.maximum(lo[tight], 0), 1)
    np.add.at(ruled, hi[tight] + 1, -1)
    # A window holds a shared anchor.
    holds = np.zeros(n + WINDOW + 1, np.int64)
    lo, hi = np.maximum(a.stop[found] - WINDOW, 0), a.at[found]
    np.add.at(holds, lo, 1)
    np.add.at(holds, hi + 1, -1)
    at = np.arange(n)
    inside = at + WINDOW <= np.repeat(words.first + words.count, words.count)
    return np.flatnonzero(inside & (np.cumsum(ruled)[:n] == 0) & (np.cumsum(holds)[:n] > 0))


def _name_windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = _bytes(frame["text"])
        for lo, hi in text_batches(texts):
            w = Words(texts[lo:hi])
            at = candidate_windows(w, list(frame["shared"].iloc[lo:hi]))
            a, b = window_names(w)
            doc = w.doc[at]
            yield pd.DataFrame({"h1": a[at].view(np.int64), "h2": b[at].view(np.int64),
                                "id": frame["id"].to_numpy()[lo:hi][doc], "k": frame["k"].to_numpy()[lo:hi][doc],
                                "pos": (at - w.first[doc]).astype(np.int32)})


def kept_words(text: str | None, starts) -> tuple[int, list[bytes]]:
    """Number of words, and the words outside the windows that start at ``starts``."""
    words = (text or "").encode().split()
    mark = np.zeros(len(words) + WINDOW + 1, np.int64)
    starts = np.asarray(starts, np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + WINDOW, -1)
    stay = np.cumsum(mark)[:len(words)] == 0
    return len(words), [w for w, s in zip(words, stay) if s]


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Windows to remove: (id, k, n_words, words_sha, whole, starts), one row per row of ``docs``.

    ``starts`` (NULL: none): first words of the windows that also start in a
    document with a smaller id; ``whole``: all words go, because a document with
    a smaller id has the same words.  ``k`` tells rows of a repeated id apart
    (0 where all ids differ).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ids = docs.select(F.col(id_col).alias("id")).filter("id is not null")
    twice = ids.groupBy("id").count().filter("count > 1").limit(1).count() > 0
    key = F.xxhash64("text") if twice else F.lit(0).cast("long")
    rows = rows.withColumn("k", key)
    parsed = materialize(rows.mapInPandas(
        _parse, "id long, k long, n_words long, words_sha binary, anchors array<long>"), "parsed")

    # Equal documents: the smallest id stands for the others.
    classes = (parsed.filter(F.col("id").isNotNull() & (F.col("n_words") >= WINDOW)).groupBy(F.col("words_sha").alias("c"))
               .agg(F.min("id").alias("rep"), F.max("id").alias("top")).filter("rep < top"))
    classes = materialize(classes.select("c", "rep"), "classes")
    known = parsed.join(classes, parsed["words_sha"] == classes["c"], "left")
    known = materialize(known.select("id", "k", "n_words", "words_sha", "anchors",
                                     (F.coalesce(F.col("id") > F.col("rep"), F.lit(False))).alias("whole")), "known")

    # Anchors of two documents or more, then the documents that have some.
    single = known.filter(F.col("id").isNotNull() & ~F.col("whole")).select("id", "k", F.explode("anchors").alias("anchor"))
    shared = materialize(single.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b"))
                         .filter("a < b").select(F.col("anchor").alias("s")), "shared")
    suspects = materialize(single.join(shared, single["anchor"] == shared["s"]).groupBy("id", "k")
                           .agg(F.collect_list("anchor").alias("shared")), "suspects")
    release(shared, parsed, classes)
    suspect = suspects.select(F.col("id").alias("i"), F.col("k").alias("j"), "shared")
    windows = materialize(rows.join(suspect, (rows["id"] == suspect["i"]) & (rows["k"] == suspect["j"]))
                          .select("id", "k", "text", "shared")
                          .mapInPandas(_name_windows, "h1 long, h2 long, id long, k long, pos int"), "windows")
    least = materialize(windows.groupBy(F.col("h1").alias("g1"), F.col("h2").alias("g2"))
                        .agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").drop("b"), "least")
    old = (windows.join(least, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))).filter("id > a")
           .groupBy(F.col("id").alias("i"), F.col("k").alias("j")).agg(F.collect_list("pos").alias("starts")))
    old = materialize(old, "old")
    release(suspects, windows, least)
    return known.join(old, (known["id"] == old["i"]) & (known["k"] == old["j"]), "left").select(
        "id", "k", "n_words", "words_sha", "whole", "starts")


def _rows_with_key(docs: DataFrame, text_col: str, found: DataFrame, name: str) -> DataFrame:
    """``docs`` with column ``name``, the k of :func:`repeats`."""
    keyed = found.filter("k <> 0").limit(1).count() > 0
    return docs.withColumn(name, F.xxhash64(F.col(text_col)) if keyed else F.lit(0).cast("long"))


def dedup_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_words, n_removed, kept_sha256 (kept words joined by one space).

    A word goes if a window of 50 consecutive words covers it that also starts
    in a document with a smaller id; windows are judged on the input.  Defined
    cases: a NULL or empty text has no words; texts of fewer than 50 words have
    no window; a row with a NULL id neither loses words nor makes others lose
    any, as NULL is not smaller; rows of a repeated id do not count against each
    other; other columns are not read; an empty table gives an empty result.
    """
    found = materialize(repeats(docs, id_col, text_col), "found")
    empty = hashlib.sha256(b"").hexdigest()
    plain = found.filter("starts is null").select(
        F.col("id").alias(id_col), "n_words", F.when(F.col("whole"), F.col("n_words")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("whole"), F.lit(empty)).otherwise(F.lower(F.hex("words_sha"))).alias("kept_sha256"))

    def digest(frames):
        for frame in frames:
            out = []
            for i, text, starts in zip(frame["id"], frame["text"], frame["starts"]):
                n, kept = kept_words(text, starts)
                out.append((i, n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield pd.DataFrame(out, columns=[id_col, "n_words", "n_removed", "kept_sha256"])

    cut = found.filter("starts is not null").select(F.col("id").alias("_i"), F.col("k").alias("_j"), "starts").dropDuplicates(["_i", "_j"])
    rows = _rows_with_key(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "text", found, "_k")
    changed = rows.join(cut, (rows["id"] == cut["_i"]) & (rows["_k"] == cut["_j"])).select("id", "text", "starts")
    return plain.unionByName(changed.mapInPandas(digest, f"{id_col} long, n_words long, n_removed long, kept_sha256 string"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without repeated passages: the same rows and columns.

    Rows that lose words have the kept words, joined by one space, as their text
    (empty if all go) and n_chars, if there is such a column, set to match; all
    other rows are unchanged.  Cases as in :func:`dedup_digests`.
    """
    p = spare_prefix(docs)
    found = materialize(repeats(docs, id_col, text_col), "found")
    cut = found.filter("whole or starts is not null").select(
        F.col("id").alias(f"{p}i"), F.col("k").alias(f"{p}j"), F.col("whole").alias(f"{p}whole"), F.col("starts").alias(f"{p}starts"))
    cut = cut.dropDuplicates([f"{p}i", f"{p}j"])

    @F.pandas_udf("string")
    def shorten(texts: pd.Series, starts: pd.Series) -> pd.Series:
        return pd.Series([b" ".join(kept_words(t, s)[1]).decode() for t, s in zip(texts, starts)], dtype=object)

    rows = _rows_with_key(docs, text_col, found, f"{p}k")
    rows = rows.join(cut, (rows[id_col] == cut[f"{p}i"]) & (rows[f"{p}k"] == cut[f"{p}j"]), "left")
    starts = F.coalesce(f"{p}starts", F.array().cast("array<int>"))
    text = (F.when(F.col(f"{p}whole"), F.lit("")).when(F.col(f"{p}starts").isNotNull(), F.col(f"{p}short")).otherwise(F.col(text_col)))
    # Rows without a cut send an empty text to the Python worker.
    rows = rows.withColumn(f"{p}short", shorten(F.when(F.col(f"{p}starts").isNotNull(), F.col(text_col)).otherwise(F.lit("")), starts))
    rows = rows.withColumn(f"{p}new", text)
    names = {text_col: F.col(f"{p}new").alias(text_col)}
    if "n_chars" in docs.columns and "n_chars" not in (id_col, text_col):
        touched = F.coalesce(F.col(f"{p}whole") | F.col(f"{p}starts").isNotNull(), F.lit(False))
        names["n_chars"] = F.when(touched, F.char_length(f"{p}new")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return rows.select(*[names.get(c, F.col(c)) for c in docs.columns])
