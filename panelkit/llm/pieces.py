"""SentencePiece encoding and decoding.

Method: an Aho-Corasick automaton over all pieces reports, at each position,
every piece that ends there (its output links); a single pass relaxes the best
score of the position over them, and the best path is read back (Viterbi).

The vocabulary is read from a model file and never trained.  Its stored scores
are summed, so the result is the best segmentation under them; a model made for
merging (BPE) segments by merge order in its own library, which need not be the
best sum.  Decoding is exact for every text.
"""

from __future__ import annotations

import hashlib
import re
import sys
import types
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = "▁"
#: Stands for a literal U+2581 of a text; no valid text holds a lone surrogate.
_LITERAL = "\udc81"
#: Chunks remembered by a worker before it starts afresh, and the longest one.
CACHE, CACHED_CHARS = 150_000, 48
#: Documents handed back at a time.
ROWS = 256

_WORST = float("-inf")

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


class Pieces:
    """Vocabulary: ``piece[i]`` and ``score[i]`` of ordinary pieces, ``byte`` ids 0-255."""

    def __init__(self, piece: list[str | None], score: list[float], byte: list[int], unknown: int = 0):
        self.piece, self.score, self.byte, self.unknown = piece, score, byte, unknown

    @classmethod
    def read(cls, path: str = MODEL) -> "Pieces":
        """From a model file; read on the driver, of the size of its vocabulary."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        names = [model.id_to_piece(i) for i in range(size)]
        byte = [i for i in range(size) if model.is_byte(i)]
        byte.sort(key=lambda i: int(names[i][1:-1], 16))
        return cls([None if s else n for s, n in zip(special, names)],
                   [model.get_score(i) for i in range(size)], byte, model.unk_id())


class Encoder:
    """Viterbi over the automaton of one vocabulary."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.automaton = ahocorasick.Automaton()
        known = [(p, i) for i, p in enumerate(pieces.piece) if p]
        for p, i in known:
            self.automaton.add_word(p, (len(p), i, pieces.score[i]))
        self.automaton.make_automaton()
        self.single = {p for p, _ in known if len(p) == 1}
        #: A character without a piece costs more than any path of pieces.
        self.fallback = 10 * min([pieces.score[i] for _, i in known], default=0.0) - 10
        # Spaces only begin pieces and no piece holds a line feed: chunks can then be
        # segmented alone, and remembered, without changing the best path.
        self.local = not any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p, _ in known)
        # Two characters side by side in no piece are a safe cut as well.
        self.pairs = {p[i:i + 2] for p, _ in known for i in range(len(p) - 1)}
        self.spaced: dict[str, list[int]] = {}
        self.bare: dict[str, list[int]] = {}
        self.newline = self._fallback_ids("\n")

    def _fallback_ids(self, char: str) -> list[int]:
        if not self.pieces.byte:
            return [self.pieces.unknown]
        return [self.pieces.byte[b] for b in (SPACE if char == _LITERAL else char).encode()]

    def best(self, chunk: str) -> list[int]:
        """Ids of the best segmentation of a chunk; of equals, the one with the longest last piece."""
        if not self.single.issuperset(chunk):
            return self._best_with_fallback(chunk)
        n = len(chunk)
        score = [_WORST] * n
        score.append(0.0)  # the last place is the one before the first
        came: list = [None] * n
        for end, piece in self.automaton.iter(chunk):
            s = score[end - piece[0]] + piece[2]
            if s > score[end]:
                score[end], came[end] = s, piece
        path, at = [], n - 1
        while at >= 0:
            piece = came[at]
            path.append(piece[1])
            at -= piece[0]
        path.reverse()
        return path

    def _best_with_fallback(self, chunk: str) -> list[int]:
        """The same where some character has no piece of its own: it may be written as bytes."""
        n = len(chunk)
        score = [0.0] + [_WORST] * n
        came: list = [None] * (n + 1)
        ends: list[list] = [[] for _ in range(n + 1)]
        for end, piece in self.automaton.iter(chunk):
            ends[end + 1].append(piece)
        for end in range(1, n + 1):
            for piece in ends[end]:
                s = score[end - piece[0]] + piece[2]
                if s > score[end]:
                    score[end], came[end] = s, piece
            if chunk[end - 1] not in self.single and score[end - 1] + self.fallback > score[end]:
                score[end], came[end] = score[end - 1] + self.fallback, (1, -1, 0.0)
        path, at = [], n
        while at:
            size, i, _ = came[at]
            path.append(self._fallback_ids(chunk[at - 1]) if i < 0 else (i,))
            at -= size
        return [i for part in reversed(path) for i in part]

    def _chunk(self, word: str, kept: dict, prefix: str) -> list[int]:
        """Ids of a word: its stem, then one by one the characters at its end that stand in no piece with the one before."""
        cut = len(word)
        while cut > 1 and word[cut - 2:cut] not in self.pairs:
            cut -= 1
        if cut < len(word):
            stem = word[:cut]
            ids = list(kept.get(stem) or self._chunk(stem, kept, prefix))
            for last in word[cut:]:
                ids += self.bare.get(last) or self._chunk(last, self.bare, "")
        else:
            ids = self.best(prefix + word)
        if len(word) <= CACHED_CHARS:
            if len(kept) >= CACHE:
                kept.clear()
            kept[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text (empty for the empty text); one space is put before it."""
        if not text:
            return np.zeros(0, np.int32)
        if SPACE in text:
            text = text.replace(SPACE, _LITERAL)
        if not self.local:
            return np.array(self.best(SPACE + text.replace(" ", SPACE)), np.int32)
        out: list[int] = []
        if "  " in text or text.startswith(" ") or text.endswith(" ") or " \n" in text:
            chunks = re.findall(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+", SPACE + text.replace(" ", SPACE))
            for c in chunks:
                out += self.newline if c == "\n" else self.best(c)
            return np.array(out, np.int32)
        spaced, bare = self.spaced, self.bare
        for n, line in enumerate(text.split("\n")):
            words = line.split(" ")
            if n:
                out += self.newline
                first = words[0]
                if first:
                    out += bare.get(first) or self._chunk(first, bare, "")
                del words[0]
            for w in words:
                out += spaced.get(w) or self._chunk(w, spaced, SPACE)
        return np.array(out, np.int32)


class Decoder:
    def __init__(self, pieces: Pieces):
        self.text = [p.replace(SPACE, " ").encode() if p else b"" for p in pieces.piece]
        self.text[pieces.unknown] = "⁇".encode()
        for value, i in enumerate(pieces.byte):
            self.text[i] = bytes([value])

    def decode(self, ids) -> str:
        """Text of ids; ids that the vocabulary does not have raise IndexError."""
        whole = b"".join([self.text[i] for i in ids]).decode("utf-8", errors="replace")
        return whole[1:] if whole.startswith(" ") else whole


def _worker_encoder(values: tuple) -> Encoder:
    """The encoder of this worker process: tasks that follow one another share its memory."""
    held = sys.modules.setdefault("_pieces_of_this_worker", types.ModuleType("_pieces_of_this_worker"))
    key = hashlib.sha256(repr(values).encode()).digest()
    if getattr(held, "key", None) != key:
        held.key, held.encoder = key, Encoder(Pieces(*values))
    return held.encoder


def _shipped(spark: SparkSession, path: str):
    """The vocabulary as plain values: its size does not grow with the data."""
    p = Pieces.read(path)
    return spark.sparkContext.broadcast((p.piece, p.score, p.byte, p.unknown))


def encode(text: Column, spark: SparkSession, path: str = MODEL) -> Column:
    """array<int> of a text column; NULL stays NULL, the empty text has no ids."""
    shared = _shipped(spark, path)

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _worker_encoder(shared.value)
        for texts in batches:
            yield pd.Series([None if t is None else encoder.encode(t) for t in texts], dtype=object)

    return run(text)


def decode(ids: Column, spark: SparkSession, path: str = MODEL) -> Column:
    """Text of an array<int> column; NULL stays NULL, no ids are the empty text."""
    shared = _shipped(spark, path)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(Pieces(*shared.value))
        for rows in batches:
            yield pd.Series([None if r is None else decoder.decode(r) for r in rows], dtype=object)

    return run(ids)


def encode_documents(docs: DataFrame, path: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_pieces, ids, decoded_sha256, round_trip), one row per document.

    Every text is encoded, and its ids decoded again, in one pass that hands back
    a few hundred documents at a time.  Defined cases: a NULL text has NULL ids,
    n_pieces 0 and round_trip true; a literal U+2581 is written as bytes, so it
    comes back; a character without a piece is written as its bytes; NULL ids
    and repeated rows are kept; other columns are not read.  A text is encoded
    whole.
    """
    shared = _shipped(docs.sparkSession, path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, decoder = _worker_encoder(shared.value), Decoder(Pieces(*shared.value))
        for frame in frames:
            for lo in range(0, len(frame), ROWS):
                part = frame.iloc[lo:lo + ROWS]
                ids = [None if t is None else encoder.encode(t) for t in part["text"]]
                back = [None if i is None else decoder.decode(i.tolist()) for i in ids]
                yield pd.DataFrame({
                    id_col: part["id"].array, "n_pieces": [0 if i is None else len(i) for i in ids], "ids": ids,
                    "decoded_sha256": [None if b is None else hashlib.sha256(b.encode()).hexdigest() for b in back],
                    "round_trip": [b == t for b, t in zip(back, part["text"])]})

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"{id_col} {id_type}, n_pieces int, ids array<int>, decoded_sha256 string, round_trip boolean")
