"""Schema operators: regex selection/renaming, name cleaning, all-missing drop.

Name operations run on the driver over ``df.columns`` (metadata only, no job).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sqltext import ident


def matching(df: DataFrame, pattern: str, ignore_case: bool = True) -> list[str]:
    """Column names containing a match of ``pattern`` (case-insensitive by default)."""
    rx = re.compile(pattern, re.I if ignore_case else 0)
    return [c for c in df.columns if rx.search(c)]


def select_matching(df: DataFrame, pattern: str, keep: Sequence[str] = (), ignore_case: bool = True) -> DataFrame:
    cols = list(keep) + [c for c in matching(df, pattern, ignore_case) if c not in keep]
    return df.select(*cols)


def drop_matching(df: DataFrame, pattern: str, ignore_case: bool = True) -> DataFrame:
    return df.drop(*matching(df, pattern, ignore_case))


def rename_with(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    mapping = {c: fn(c) for c in df.columns if fn(c) != c}
    new = [mapping.get(c, c) for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"renaming creates duplicate names: {new}")
    return df.withColumnsRenamed(mapping) if mapping else df


def rename_matching(df: DataFrame, pattern: str, replacement: str = "") -> DataFrame:
    """Replace the first match of ``pattern`` in every column name."""
    rx = re.compile(pattern)
    return rename_with(df, lambda c: rx.sub(replacement, c, count=1))


#: Signs that a cleaned name spells out or leaves out.
SPELLED = {"%": "_percent_", "#": "_number_", "'": "", '"': ""}


def clean_name(name: str) -> str:
    """snake_case: ``%`` and ``#`` spelled out, quotes left out, accents off, camelCase
    split, other signs to ``_``, lower case; ``x`` before a digit or alone."""
    for sign, word in SPELLED.items():
        name = name.replace(sign, word)
    s = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_").lower()
    if not s:
        s = "x"
    if s[0].isdigit():
        s = "x" + s
    return s


def clean_names(df: DataFrame) -> DataFrame:
    """snake_case every column; duplicates get ``_2``, ``_3`` ... suffixes."""
    seen: dict[str, int] = {}
    out = []
    for c in df.columns:
        n = clean_name(c)
        if n in seen:
            seen[n] += 1
            n = f"{n}_{seen[n]}"
        else:
            seen[n] = 1
        out.append(n)
    return df.toDF(*out)


def all_null_columns(df: DataFrame) -> list[str]:
    """Names of the columns without a single non-missing value (one aggregate job)."""
    cols = df.columns
    # one global aggregate; the count list is generated as SQL text (one parse)
    counts = df.selectExpr(*[f"count({ident(c)}) AS c{i}" for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if counts[f"c{i}"] == 0]


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop columns that are entirely missing (data-dependent schema)."""
    return df.drop(*all_null_columns(df))


def columns_between(df: DataFrame, first: str, last: str) -> list[str]:
    """Positional column range ``first:last`` (inclusive)."""
    cols = df.columns
    return cols[cols.index(first): cols.index(last) + 1]
