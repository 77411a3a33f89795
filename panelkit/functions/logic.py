"""Flag, recode and arithmetic Column builders with explicit missing-value rules."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _c


def case_when(branches: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Ordered branches; the first true condition wins, a NULL condition is false."""
    expr = None
    for cond, value in branches:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return expr.otherwise(d) if expr is not None else d


def in_set(c: ColumnOrName, values: Iterable) -> Column:
    """Membership that is FALSE (never NULL) for a missing value."""
    return F.coalesce(_c(c).isin(list(values)), F.lit(False))


def as_int(c: ColumnOrName) -> Column:
    """Logical as number (TRUE=1, FALSE=0, NULL=NULL)."""
    return _c(c).cast("int")


def flag_sum(cols: Sequence[ColumnOrName]) -> Column:
    """Row-wise sum of logical flags; NULL if any flag is NULL (strict)."""
    total = None
    for c in cols:
        v = as_int(c)
        total = v if total is None else total + v
    return total


def none_of(cols: Sequence[ColumnOrName]) -> Column:
    """``sum(flags) == 0`` with strict NULL propagation."""
    return flag_sum(cols) == 0


def count_present(cols: Sequence[ColumnOrName]) -> Column:
    """Row-wise number of non-missing values (never NULL)."""
    total = F.lit(0)
    for c in cols:
        total = total + _c(c).isNotNull().cast("int")
    return total


def cap(c: ColumnOrName, upper) -> Column:
    """``pmin(x, upper)`` keeping NULL (``least`` would skip the NULL)."""
    col = _c(c)
    return F.when(col > upper, F.lit(upper)).otherwise(col)


def right_closed_bands(c: ColumnOrName, breaks: Sequence, labels: Sequence[str]) -> Column:
    """Label of the bin (b[i], b[i+1]] holding the value, NULL outside every bin."""
    if len(labels) != len(breaks) - 1:
        raise ValueError("need one label per bin")
    col = _c(c)
    return case_when([((col > lo) & (col <= hi), lab)
                      for lo, hi, lab in zip(breaks[:-1], breaks[1:], labels)])


def block_means(items: Sequence[ColumnOrName], blocks: Sequence[tuple[str, int, int]],
                strict: bool = True) -> list[Column]:
    """Block-weighted linear combination: mean of items lo..hi (1-based) per block.

    ``strict`` reproduces a matrix product: any missing item (in any block)
    makes every block score missing.
    """
    cols = [_c(i) for i in items]
    guard = None
    if strict:
        for c in cols:
            cond = c.isNull()
            guard = cond if guard is None else guard | cond
    out = []
    for name, lo, hi in blocks:
        part = cols[lo - 1:hi]
        total = part[0]
        for c in part[1:]:
            total = total + c
        score = total / float(len(part))
        if guard is not None:
            score = F.when(~guard, score)
        out.append(score.alias(name))
    return out


def fill_default(c: ColumnOrName, default) -> Column:
    return F.coalesce(_c(c), default if isinstance(default, Column) else F.lit(default))


def label_map(mapping: dict) -> Column:
    """A literal map Column; ``label_map(m)[col]`` is NULL for unmapped keys."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def lookup(c: ColumnOrName, mapping: dict) -> Column:
    return label_map(mapping)[_c(c)]
