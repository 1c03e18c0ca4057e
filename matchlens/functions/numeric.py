"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def half_even(value: Column | str, digits: int) -> Column:
    """Round to ``digits`` decimals, halves to the even neighbour, on the binary double; never negative
    zero."""
    scale = float(10 ** digits)
    return F.rint(_column(value) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def ratio(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` as double; NULL when the denominator is zero or NULL."""
    return F.try_divide(_column(part).cast("double"), _column(whole).cast("double"))
