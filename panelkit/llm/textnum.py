"""Words of a batch of texts as numpy arrays.

Texts are joined into one byte buffer with separators, so that word limits,
word hashes and shingle hashes of thousands of documents are a few array
passes instead of a Python loop over words.
"""

from __future__ import annotations

import numpy as np

#: space, tab, line feed, vertical tab, form feed, carriage return
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_U = np.uint64
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)  # splitmix64 finaliser


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection of 64-bit words."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _M1
        x = (x ^ (x >> _U(27))) * _M2
        return x ^ (x >> _U(31))


def random_words(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit words: splitmix64 of seed, seed + 1, ..."""
    with np.errstate(over="ignore"):
        i = np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
        return mix(i + _U(seed * 0x2545F4914F6CDD1D % 2**64))


class Words:
    """Word limits of a list of encoded texts (``bytes``).

    ``start``/``end``: byte limits in ``buf``; ``doc``: index of the text;
    ``first``/``count``: first word and number of words of each text.
    """

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join(texts) + b"\n"
        self.buf = np.frombuffer(self.raw, dtype=np.uint8)
        size = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.offset = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        white = _SPACE[self.buf]
        edge = np.flatnonzero(white[1:] != white[:-1]) + 1
        if len(self.buf) and not white[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.offset)
        self.count = np.diff(np.append(self.first, len(self.start)))
        self.doc = np.repeat(np.arange(len(texts)), self.count)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, seed: int) -> np.ndarray:
        """A 64-bit multilinear hash of every word."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        length = self.end - self.start
        longest = int(length.max())
        symbol, place = random_words(256, seed), random_words(max(longest, 1), seed + 1) | _U(1)
        at = np.flatnonzero(~_SPACE[self.buf])
        begin = np.cumsum(length) - length
        pos = np.arange(len(at)) - np.repeat(begin, length)
        with np.errstate(over="ignore"):
            total = np.add.reduceat(symbol[self.buf[at]] * place[pos], begin)
            return mix(total + length.astype(np.uint64))


def shingle_hashes(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words (positions that cross texts included)."""
    n = len(word) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    odd = random_words(k, 977) | _U(1)
    with np.errstate(over="ignore"):
        total = word[:n] * odd[0]
        for j in range(1, k):
            total = total + word[j:j + n] * odd[j]
    return mix(total)


def text_batches(texts: list[bytes], limit: int = 1_500_000):
    """Index ranges of texts of about ``limit`` bytes in all (one long text alone)."""
    begin, total = 0, 0
    for i, t in enumerate(texts):
        if i > begin and total + len(t) > limit:
            yield begin, i
            begin, total = i, 0
        total += len(t) + 1
    if begin < len(texts):
        yield begin, len(texts)
