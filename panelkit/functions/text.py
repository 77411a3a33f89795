"""String Column builders (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def str_sub(c: ColumnOrName, start: int, stop: int) -> Column:
    """1-based inclusive substring, like ``substr(x, start, stop)``."""
    return F.substring(_c(c), start, stop - start + 1)


def str_trim(c: ColumnOrName) -> Column:
    return F.trim(_c(c))


def str_extract(c: ColumnOrName, pattern: str) -> Column:
    """First match of ``pattern`` or NULL when there is none (not '')."""
    return F.regexp_substr(_c(c), F.lit(pattern))


def str_remove(c: ColumnOrName, pattern: str) -> Column:
    """Remove the first match of ``pattern``; later matches stay."""
    col, rx = _c(c), F.lit(pattern)
    at, found = F.regexp_instr(col, rx), F.regexp_substr(col, rx)
    rest = F.concat(F.substring(col, F.lit(1), at - 1), F.substr(col, at + F.length(found)))
    return F.when(found.isNull() | (found == ""), col).otherwise(rest)


def str_detect(c: ColumnOrName, pattern: str, negate: bool = False) -> Column:
    """Case-sensitive regex test; NULL input gives NULL (Kleene)."""
    hit = _c(c).rlike(pattern)
    return ~hit if negate else hit


def nchar(c: ColumnOrName) -> Column:
    return F.length(_c(c))


def parse_integer(c: ColumnOrName) -> Column:
    """Integer parse that yields NULL (not an error) on junk, ANSI-safe."""
    return _c(c).cast("string").try_cast("int")


# Characters kept when reading the first number out of free text.
NUMBER_PATTERN = r"-?[0-9][0-9,]*(\.[0-9]+)?|-?\.[0-9]+"


def parse_number(c: ColumnOrName) -> Column:
    """First number in free text, grouping marks dropped: '$45,000.50 CAD' -> 45000.5.

    NULL when the text holds no number.
    """
    first = F.regexp_substr(_c(c), F.lit(NUMBER_PATTERN))
    return F.regexp_replace(first, ",", "").try_cast("double")
