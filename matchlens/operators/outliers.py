"""Tukey fences, outlier counts, box-plot statistics and descriptive statistics.

The quartiles arrive as literals, so the counting pass is one aggregation without a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.functions import text
from matchlens.operators.quantiles import quantiles
from matchlens.operators.shape import aggregate_per_column, present

# Fixed value: fence distance in interquartile ranges
FENCE_FACTOR = 1.5


def _fences(first: float | None, third: float | None) -> tuple[float | None, float | None]:
    if first is None:
        return None, None
    spread = third - first
    return first - FENCE_FACTOR * spread, third + FENCE_FACTOR * spread


def _constant(value: float | None) -> str:
    return f"first({text.double(value)})"


def iqr_outliers(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Fences per column, and the count and percent of non-null values strictly outside."""
    columns = present(df, columns)
    quartiles = quantiles(df, columns, (0.25, 0.75), exact)
    measures = {}
    for c in columns:
        low, high = _fences(*quartiles[c])
        value = text.name(c)
        outside = f"{value} < {text.double(low)} OR {value} > {text.double(high)}"
        measures[c] = {"lower": _constant(low), "upper": _constant(high),
                       "outlier_count": f"count_if({outside})", "filled": f"count({value})"}
    share = f"100D * {text.quotient('outlier_count', 'filled')}"
    return (aggregate_per_column(df, measures).orderBy("position")
            .selectExpr("column_name", f"{text.rounded('lower', 2)} AS lower_fence",
                        f"{text.rounded('upper', 2)} AS upper_fence", "outlier_count",
                        f"{text.rounded(share, 2)} AS outlier_pct"))


def selected_outliers(report: DataFrame, columns: Sequence[str]) -> DataFrame:
    return report.filter(F.col("column_name").isin(list(columns)))


def boxplot_statistics(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Quartiles, whisker ends (the extreme values inside the fences) and outside points."""
    columns = present(df, columns)
    quartiles = quantiles(df, columns, (0.25, 0.5, 0.75), exact)
    measures = {}
    for c in columns:
        first, median, third = quartiles[c]
        low, high = _fences(first, third)
        value = text.name(c)
        inside = f"{value} BETWEEN {text.double(low)} AND {text.double(high)}"
        measures[c] = {
            "q1": _constant(first), "median": _constant(median), "q3": _constant(third),
            "whisker_low": f"min(CASE WHEN {inside} THEN {value} END)",
            "whisker_high": f"max(CASE WHEN {inside} THEN {value} END)",
            "flier_count": f"count_if(NOT ({inside}))"}
    return aggregate_per_column(df, measures).orderBy("position").drop("position")


def describe(df: DataFrame, columns: Sequence[str], exact: bool = True,
             digits: int = 3) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum, one row per column."""
    columns = present(df, columns)
    quartiles = quantiles(df, columns, (0.25, 0.5, 0.75), exact)
    measures = {}
    for c in columns:
        value = f"CAST({text.name(c)} AS DOUBLE)"
        first, median, third = quartiles[c]
        measures[c] = {
            "count": f"CAST(count({value}) AS DOUBLE)", "mean": f"avg({value})",
            "std": f"stddev_samp({value})", "min": f"min({value})", "p25": _constant(first),
            "p50": _constant(median), "p75": _constant(third), "max": f"max({value})"}
    names = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")
    return (aggregate_per_column(df, measures).orderBy("position")
            .selectExpr("column_name", *[f"{text.rounded(n, digits)} AS {n}" for n in names]))
