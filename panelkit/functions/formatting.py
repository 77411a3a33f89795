"""Report-cell formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _c


def whole_percent(n: ColumnOrName, total: ColumnOrName) -> Column:
    """100*n/N rounded half-to-even to a whole number (12.5 -> 12, 37.5 -> 38).

    ``n * 100.0 / N`` is exact enough that a true .5 is represented exactly.
    NULL when N is 0 or NULL.
    """
    return F.bround(F.try_divide(_c(n) * 100.0, _c(total)), 0).cast("int")


def pct_cell(n: ColumnOrName, total: ColumnOrName) -> Column:
    """``"p% (n/N)"`` cell; NULL when there is no denominator."""
    nn, tt = _c(n), _c(total)
    return F.when(
        tt > 0,
        F.concat(whole_percent(nn, tt).cast("string"), F.lit("% ("),
                 nn.cast("string"), F.lit("/"), tt.cast("string"), F.lit(")")),
    )
