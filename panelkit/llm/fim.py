"""Fill-in-the-middle rearrangement by block rotation in place.

Method: one scan over a text's bytes finds the byte offsets of its two cuts
(given in code points); sentinels are inserted into the bytearray before its
three segments; segments change places by rotations, each made of three
reversals inside the same buffer.  A rotation is undone by the rotation back,
so the text is restored exactly from the output and its form.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Bytes that the scan for a cut looks at together.
_SCAN = 1 << 16


def offsets(buf: bytearray, cuts: tuple[int, ...]) -> list[int]:
    """Byte offset of each code point in ``cuts`` (ascending; the end counts too) of UTF-8 bytes."""
    found, seen, at = [], 0, 0
    bytes_ = np.frombuffer(buf, np.uint8)
    while len(found) < len(cuts):
        lead = (bytes_[at:at + _SCAN] & 0xC0) != 0x80
        here = int(lead.sum())
        first = None
        while len(found) < len(cuts) and cuts[len(found)] < seen + here:
            first = np.flatnonzero(lead) if first is None else first
            found.append(at + int(first[cuts[len(found)] - seen]))
        seen, at = seen + here, at + _SCAN
        if at >= len(bytes_):
            found += [len(bytes_)] * (len(cuts) - len(found))
    return found


def reverse(view: np.ndarray, i: int, j: int) -> None:
    """Reverse ``view[i:j]`` in place; half of it is held beside."""
    half = (j - i) // 2
    left = view[i:i + half].copy()
    view[i:i + half] = view[j - half:j][::-1]
    view[j - half:j] = left[::-1]


def rotate(buf: bytearray, i: int, j: int, k: int) -> None:
    """Exchange the neighbours ``buf[i:j]`` and ``buf[j:k]`` by three reversals."""
    view = np.frombuffer(buf, np.uint8)
    reverse(view, i, j)
    reverse(view, j, k)
    reverse(view, i, k)


def arrange(buf: bytearray, first: int, second: int, form: str) -> None:
    """Turn a text, cut at two byte offsets, into its ``psm`` or ``spm`` output in place."""
    buf[second:second] = SUFFIX
    buf[first:first] = MIDDLE
    buf[0:0] = PREFIX
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    # prefix, middle, suffix stand in the text's order; the suffix moves before one or both.
    rotate(buf, middle if form == "psm" else 0, suffix, len(buf))


def restore(output: str, form: str) -> str:
    """The text of which ``arrange`` made ``output``: rotations turned back, sentinels taken out."""
    if form == "plain":
        return output
    buf = bytearray(output.encode())
    if form == "psm":
        start = buf.find(SUFFIX)
        split = buf.find(MIDDLE, start)
    else:
        start = 0
        split = buf.find(PREFIX)
    if min(start, split) < 0:
        raise ValueError(f"no {form} output: {output[:40]!r}")
    rotate(buf, start, split, len(buf))
    suffix = start + len(buf) - split
    middle = start if form == "psm" else buf.find(MIDDLE)
    del buf[suffix:suffix + len(SUFFIX)]
    del buf[middle:middle + len(MIDDLE)]
    del buf[:len(PREFIX)]
    return buf.decode()


def draw(seed: int, doc_id: str) -> list[int]:
    """The first four 8-digit groups of the hex sha256 of ``seed:doc_id``."""
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * i:4 * i + 4], "big") for i in range(4)]


def rearrange_one(text: str, doc_id: str, seed: int, plain_from: int, spm_below: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    n = len(text)
    h = draw(seed, doc_id)
    if not text or any(s.decode() in text for s in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= plain_from:
        return n, "plain", None, None, text
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    form = "spm" if h[3] % 100 < spm_below else "psm"
    buf = bytearray(text.encode())
    arrange(buf, *offsets(buf, (first, second)), form)
    return n, form, first, second - first, buf.decode()


def rearrange(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
              plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output), one row per document.

    The cuts and the form are drawn from a hash of the id: of 100 drawn values
    those from ``plain_from`` on stay plain, of the others those below
    ``spm_below`` put the suffix first.  A whole text is cut, of any length, at
    any code point.  Defined cases: a NULL text counts as empty; an empty text
    and one that contains a sentinel stay plain, with NULL lengths; a NULL id
    draws as the empty id; rows of one id draw alike; repeated rows are kept;
    other columns are not read; an empty table gives an empty result.
    """

    @F.pandas_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def run(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = [rearrange_one(t, i, seed, plain_from, spm_below) for i, t in zip(ids, texts)]
        out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
        return out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    text = F.coalesce(F.col(text_col), F.lit(""))
    made = run(F.coalesce(F.col(id_col).cast("string"), F.lit("")), text)
    return docs.select(F.col(id_col), made.alias("fim")).select(id_col, "fim.*")


def restored(output: str = "output", form: str = "form"):
    """Column: the original text of a row of :func:`rearrange`."""

    @F.pandas_udf("string")
    def run(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([restore(o, f) for o, f in zip(outputs, forms)], dtype=object)

    return run(F.col(output), F.col(form))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
            plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256):
    the outputs of :func:`rearrange` and the texts rebuilt from them, hashed
    where they are made, so that a task holds one output at a time; cases as there."""

    @F.pandas_udf("n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")
    def run(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        rows = []
        for i, t in zip(ids, texts):
            n, form, prefix, middle, output = rearrange_one(t, i, seed, plain_from, spm_below)
            rows.append((n, form, prefix, middle, sha(output), sha(restore(output, form))))
        out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])
        return out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    made = run(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.col(id_col), made.alias("fim")).select(id_col, "fim.*")
