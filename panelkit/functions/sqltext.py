"""Quoting for generated SQL expression text (``selectExpr`` / ``F.expr``).

Bulk-generated expressions (hundreds of aggregates, wide unpivots) are built
as SQL text: the JVM parses them once, instead of one driver round trip per
Column node.
"""

from __future__ import annotations


def ident(name: str) -> str:
    """Back-quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def string_lit(value: str) -> str:
    """Single-quoted Spark SQL string literal (backslash escapes)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
