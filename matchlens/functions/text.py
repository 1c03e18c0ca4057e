"""SQL text for expressions that are repeated over many columns.

A wide table needs hundreds of small expressions. As text each output column is handed to Spark
in one call, where the same tree of ``Column`` objects would take dozens.
"""

from __future__ import annotations


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if value is None else f"{float(value)!r}D"


def rounded(expression: str, digits: int) -> str:
    """Halves go to the even neighbour, judged on the binary double; never negative zero."""
    return f"rint(({expression}) * {double(10 ** digits)}) / {double(10 ** digits)} + 0D"


def quotient(part: str, whole: str) -> str:
    return f"try_divide(CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE))"
