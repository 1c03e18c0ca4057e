"""Exact quantiles with linear interpolation by radix selection; no value is sorted or exchanged.

A double becomes a 64-bit integer of the same order. A scan counts, for every column at once, how
many values share each choice of the next leading bits; the counts tell which choice holds a wanted
rank, and the next scan looks inside that one only. Five scans of 13 bits settle all bits, for any
data. What moves are histograms of a fixed size, at most two per column and probability. The input
is read once per scan: pass a table.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from matchlens.functions import text
from matchlens.operators.partial_sums import summed

BITS = 13  # settled by one scan
SKETCH_ACCURACY = 10_000
_SIGN = np.uint64(1 << 63)


def _value(column: str) -> str:
    return f"CAST({text.name(column)} AS DOUBLE)"


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles; both zeros are one, NaN is the greatest."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def double_of(bits: int) -> float:
    raw = np.uint64(bits)
    return float(np.array([raw ^ _SIGN if raw & _SIGN else ~raw]).view(np.float64)[0])


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                    bits: int = BITS) -> dict[str, list[float | None]]:
    """Quantiles of the non-null values of each column; ``None`` where there are none. NaN counts
    as the greatest value. ``bits`` trades scans for the size of a histogram."""
    columns = list(columns)
    if not columns or not probabilities:
        return {c: [] for c in columns}
    numbers = df.selectExpr(*[f"{_value(c)} AS c{i}" for i, c in enumerate(columns)])
    # (column, rank) to the leading bits found so far and the rank among the values that share them
    held: dict[tuple[int, int], tuple[int, int]] = {}
    sizes = [0] * len(columns)
    left = 64
    while left:
        width = min(bits, left)
        first, left = left == 64, left - width
        inside = [[0] if first else sorted({prefix for (c, _), (prefix, _) in held.items()
                                            if c == i}) for i in range(len(columns))]
        counts = summed(numbers, _histograms(inside, width, left))
        if first:
            for i, _ in enumerate(columns):
                sizes[i] = int(counts[f"{i}:0"].sum()) if f"{i}:0" in counts else 0
                for p in probabilities if sizes[i] else ():
                    place = (sizes[i] - 1) * p
                    for rank in (math.floor(place), math.ceil(place)):
                        held[i, rank] = (0, rank)
        for (i, rank), (prefix, among) in held.items():
            upto = np.cumsum(counts[f"{i}:{prefix}"])
            digit = int(np.searchsorted(upto, among, "right"))
            before = int(upto[digit - 1]) if digit else 0
            held[i, rank] = (prefix << width | digit, among - before)
    result: dict[str, list[float | None]] = {}
    for i, column in enumerate(columns):
        result[column] = []
        for p in probabilities:
            if not sizes[i]:
                result[column].append(None)
                continue
            place = (sizes[i] - 1) * p
            low, high = (double_of(held[i, rank][0])
                         for rank in (math.floor(place), math.ceil(place)))
            share = place - math.floor(place)
            result[column].append(low + (high - low) * share if share else low)
    return result


def _histograms(inside: Sequence[Sequence[int]], width: int, left: int):
    """Per column and prefix, the counts of the next ``width`` bits; ``left`` bits follow them."""

    def partial(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        found = {}
        for i, prefixes in enumerate(inside):
            values = ordered_bits(batch.column(i).drop_null().to_numpy())
            if not len(values):
                continue
            values = values >> np.uint64(left)
            digits = (values & np.uint64((1 << width) - 1)).astype(np.int64)
            leading = values >> np.uint64(width) if left + width < 64 else np.zeros_like(values)
            for prefix in prefixes:
                found[f"{i}:{prefix}"] = np.bincount(
                    digits[leading == np.uint64(prefix)], minlength=1 << width)
        return found

    return partial


def approximate_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                          accuracy: int = SKETCH_ACCURACY) -> dict[str, list[float | None]]:
    """One sketch pass; the rank error is at most ``1 / accuracy`` of the rows."""
    if not columns:
        return {}
    shares = ", ".join(text.double(p) for p in probabilities)
    row = df.selectExpr(*[f"percentile_approx({_value(c)}, array({shares}), {accuracy}) AS q{i}"
                          for i, c in enumerate(columns)]).first()
    return {c: list(row[f"q{i}"] or [None] * len(probabilities)) for i, c in enumerate(columns)}


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
              exact: bool = True) -> dict[str, list[float | None]]:
    chosen = exact_quantiles if exact else approximate_quantiles
    return chosen(df, columns, probabilities)
