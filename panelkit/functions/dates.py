"""Date Column builders: construction from parts, completed years, periods, fiscal quarters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _c

# Average month and year used when a calendar period is turned into a duration.
DAYS_PER_MONTH = 30.4375
DAYS_PER_YEAR = 365.25


def date_from_parts(year: ColumnOrName, month: ColumnOrName, day: int = 1) -> Column:
    """Date from year and month (day fixed), NULL for missing or invalid parts.

    ``make_date`` raises under ANSI on month 13; the try_ variant of the
    timestamp builder returns NULL instead.
    """
    y = _c(year).cast("string").try_cast("int")
    m = _c(month).cast("string").try_cast("int")
    return F.to_date(F.try_make_timestamp(y, m, F.lit(day), F.lit(0), F.lit(0), F.lit(0)))


def completed_years(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole years from ``start`` to ``end``, truncated toward zero (an age)."""
    return (F.months_between(_c(end), _c(start)) / 12).cast("int")


def completed_months(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole calendar months from ``start`` to ``end``, truncated toward zero."""
    return F.months_between(_c(end), _c(start)).cast("int")


def period_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Days left after the whole months of the calendar period start -> end."""
    return F.datediff(_c(end), F.add_months(_c(start), completed_months(start, end)))


def period_weeks(start: ColumnOrName, end: ColumnOrName, exact: bool = False) -> Column:
    """Length of the period in weeks.

    Default: a calendar period of m months + d days counts each month as an
    average month (30.4375 days).  ``exact=True`` uses the day difference.
    """
    if exact:
        return F.datediff(_c(end), _c(start)) / 7.0
    months = completed_months(start, end)
    return (months * F.lit(DAYS_PER_MONTH) + period_days(start, end)) / 7.0


def year_of(c: ColumnOrName) -> Column:
    return F.year(_c(c))


def fiscal_year(c: ColumnOrName, fiscal_start: int) -> Column:
    """Fiscal year label: the calendar year in which the fiscal year ends."""
    d = _c(c)
    if fiscal_start == 1:
        return F.year(d)
    return F.year(d) + F.when(F.month(d) >= fiscal_start, 1).otherwise(0)


def fiscal_quarter(c: ColumnOrName, fiscal_start: int) -> Column:
    """Quarter 1..4 within the fiscal year that starts in month ``fiscal_start``."""
    d = _c(c)
    return (F.pmod(F.month(d) - fiscal_start, F.lit(12)) / 3).cast("int") + 1


def date_between(c: ColumnOrName, lo: str, hi: str) -> Column:
    """Inclusive date window flag."""
    return _c(c).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
