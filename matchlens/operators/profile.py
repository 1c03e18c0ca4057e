"""Column profile and missing-value reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens.functions import text
from matchlens.functions.numeric import half_even, ratio
from matchlens.operators.shape import aggregate_per_column


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.lit(len(df.columns)).cast("bigint").alias("column_count"))


def _null_pct(nulls: str, rows: str) -> Column:
    return half_even(100.0 * ratio(nulls, rows), 2)


def column_profile(df: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """Type, filled and missing counts, missing percent and distinct count of every column.

    Exact: values become (column, value) rows and are counted once; filled, missing and distinct
    counts all follow from that one exchange, whose map side already merges repeated values.
    ``exact_distinct=False`` uses a mergeable sketch and exchanges a single row.
    """
    kinds = dict(df.dtypes)
    if exact_distinct:
        cells = ", ".join(f"{i}, {_distinct_text(c, kinds[c])}" for i, c in enumerate(df.columns))
        counted = (df.selectExpr(f"stack({len(kinds)}, {cells}) AS (position, value)")
                   .groupBy("position", "value").agg(F.count(F.lit(1)).alias("copies")))
        filled = F.when(F.col("value").isNotNull(), F.col("copies")).otherwise(0)
        per_column = counted.groupBy("position").agg(
            F.sum("copies").alias("row_count"),
            F.sum(filled).alias("non_null_count"),
            F.count("value").alias("distinct_count"))
    else:
        per_column = aggregate_per_column(df, {
            c: {"row_count": "count(1)", "non_null_count": f"count({text.name(c)})",
                "distinct_count": f"approx_count_distinct({text.name(c)})"} for c in kinds})
    names = ", ".join(text.string(c) for c in kinds)
    types = ", ".join(text.string(kind) for kind in kinds.values())
    return (per_column.orderBy("position")
            .withColumn("null_count", F.col("row_count") - F.col("non_null_count"))
            .select(F.expr(f"array({names})[position]").alias("column_name"),
                    F.expr(f"array({types})[position]").alias("data_type"),
                    "non_null_count", "null_count",
                    _null_pct("null_count", "row_count").alias("null_pct"), "distinct_count"))


def _distinct_text(column: str, kind: str) -> str:
    """Text that differs exactly where values differ; negative zero counts as zero.

    Long texts are exchanged as their SHA-256 digest, so a column of documents moves 64 bytes
    per distinct value.
    """
    value = text.name(column)
    if kind in ("double", "float"):
        return f"CAST({value} + CAST(0 AS {kind}) AS STRING)"
    if kind.startswith(("array", "struct", "map")):
        value = f"to_json({value})"
    elif kind != "string":
        return f"CAST({value} AS STRING)"
    return f"CASE WHEN length({value}) > 64 THEN sha2({value}, 256) ELSE {value} END"


def missing_report(df: DataFrame) -> DataFrame:
    """Missing count and percent per column, worst first."""
    per_column = aggregate_per_column(df, {
        c: {"null_count": f"count_if({text.name(c)} IS NULL)", "row_count": "count(1)"}
        for c in df.columns})
    return (per_column
            .select("column_name", "null_count",
                    _null_pct("null_count", "row_count").alias("null_pct"))
            .orderBy(F.desc("null_pct"), "column_name"))


def missing_severity(report: DataFrame) -> DataFrame:
    """Columns with gaps, least first, banded at 20 and 50 percent."""
    share = F.col("null_pct")
    band = F.when(share > 50, "high").when(share > 20, "medium").otherwise("low")
    return (report.filter(share > 0).withColumn("severity", band)
            .orderBy("null_pct", "column_name"))


def worst_missing(report: DataFrame, rows: int = 8) -> DataFrame:
    """The first rows of the missing report that have gaps."""
    return (report.filter("null_pct > 0")
            .orderBy(F.desc("null_pct"), "column_name").limit(rows))


def retention_funnel(df: DataFrame, complete: Column, usable: Column,
                     feature_count: int) -> DataFrame:
    """Rows at the start, complete rows and their share, rows the modelling frame keeps.

    ``complete`` and ``usable`` are row conditions, so all counts come from one pass.
    """
    return (df.agg(F.count(F.lit(1)).alias("start_rows"),
                   F.count_if(complete).alias("complete_rows"),
                   F.count_if(complete & usable).alias("final_rows"))
            .select("start_rows", "complete_rows",
                    half_even(100.0 * ratio("complete_rows", "start_rows"), 1)
                    .alias("complete_pct"),
                    (F.col("start_rows") - F.col("complete_rows")).alias("dropped_rows"),
                    "final_rows", F.lit(feature_count).cast("bigint").alias("feature_count")))
