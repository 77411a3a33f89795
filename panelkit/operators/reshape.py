"""Reshape operators: unpivot (optionally parsing names), pivot with explicit
levels, label splitting, nesting and unnesting.

Pivots always take an explicit level list (from the codebook): Spark then
needs no extra job to discover the levels, and the output schema is fixed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sqltext import ident as q
from ..functions.sqltext import string_lit as lit


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None,
            name_col: str = "var", value_col: str = "val", order_col: str | None = None) -> DataFrame:
    """Wide -> long; NULL values are kept.  ``order_col`` adds the column's
    position (first-appearance order of the names)."""
    values = list(values) if values is not None else [c for c in df.columns if c not in ids]
    if order_col is None:
        return df.unpivot(list(ids), values, name_col, value_col)
    arr = F.array(*[F.struct(F.lit(v).alias(name_col), F.lit(i + 1).alias(order_col),
                             F.col(v).alias(value_col)) for i, v in enumerate(values)])
    return df.select(*ids, F.inline(arr))


def unpivot_pattern(df: DataFrame, ids: Sequence[str], pattern: str, names_to: Sequence[str],
                    value_col: str = "value") -> DataFrame:
    """Unpivot the columns matching ``pattern``; its capture groups become
    ``names_to`` columns (greedy, as in the pattern)."""
    rx = re.compile(pattern)
    cols = [c for c in df.columns if rx.fullmatch(c)]

    structs = []
    for c in cols:
        fields = [f"{lit(n)}, {lit(p)}" for p, n in zip(rx.fullmatch(c).groups(), names_to)]
        structs.append(f"named_struct({', '.join(fields)}, {lit(value_col)}, {q(c)})")
    # one generated Generate expression (a single parse instead of a driver
    # round trip per literal)
    return df.selectExpr(*[q(i) for i in ids], f"inline(array({', '.join(structs)}))")


def listed(c: str, levels: Sequence, what: str) -> Column:
    """Column ``c``; a value that is NULL or not among ``levels`` stops the job,
    as it would otherwise be missing from the wide table without a sign."""
    shown = F.coalesce(F.col(c).cast("string"), F.lit("NULL"))
    stop = F.raise_error(F.concat(F.lit(f"{what}: level of {c} without a column: "), shown))
    known = F.coalesce(F.col(c).isin(list(levels)), F.lit(False))
    return F.when(known, F.col(c)).otherwise(stop)


def pivot_named(df: DataFrame, ids: Sequence[str], names_from: str, levels: Sequence,
                agg: Column, template: str = "{}") -> DataFrame:
    """Long -> wide with explicit levels; output columns ``template.format(level)``.

    Values of unlisted levels are refused, see :func:`listed`.
    """
    wide = df.withColumn(names_from, listed(names_from, levels, "pivot_named")).groupBy(*ids).pivot(names_from, list(levels)).agg(agg)
    return wide.withColumnsRenamed({str(lv): template.format(lv) for lv in levels})


def pivot_cells(df: DataFrame, ids: Sequence[str], names_from: str, levels: Sequence[str],
                value: str, fill: str | None = None) -> DataFrame:
    """Pivot one already-unique cell per (ids, level) -- crosstab layout.

    Conditional ``max`` per level in one aggregate; ``fill`` replaces absent cells.
    Cells of unlisted levels are refused, see :func:`listed`.
    """
    df = df.withColumn(names_from, listed(names_from, levels, "pivot_cells"))
    aggs = []
    for lv in levels:
        cell = F.max(F.when(F.col(names_from) == lv, F.col(value)))
        if fill is not None:
            cell = F.coalesce(cell, F.lit(fill))
        aggs.append(cell.alias(str(lv)))
    return df.groupBy(*ids).agg(*aggs)


def nest(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """One row per key with the other columns as a sorted array of structs.

    Only for inputs whose groups are bounded by construction (e.g. one row per
    participant x wave after consolidation): the whole group lands in one row.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [c for c in order] + [c for c in rest if c not in order]
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*ordered))).alias(name))


def unnest(df: DataFrame, name: str, keep_empty: bool = False) -> DataFrame:
    """Array of structs -> one row per element, struct fields as columns."""
    others = [c for c in df.columns if c != name]
    gen = F.inline_outer(name) if keep_empty else F.inline(name)
    return df.select(*others, gen)
