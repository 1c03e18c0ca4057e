"""Pearson correlation between all columns of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame

from matchlens.functions import text
from matchlens.operators.shape import aggregate_per_column

_SCHEMA = "row_position int, column_position int, row_name string, column_name string, r double"


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairs of a table without missing values, from one distributed Gramian.

    A label code among the columns is treated as an ordinal number. A constant column has no
    correlation: NULL. Only the columns x columns matrix reaches the driver.
    """
    columns = list(columns)
    vectors = VectorAssembler(inputCols=columns, outputCol="vector",
                              handleInvalid="error").transform(df).select("vector")
    matrix = Correlation.corr(vectors, "vector").head()[0].toArray()
    spread = df.selectExpr(*[f"max({text.name(c)}) > min({text.name(c)}) AS v{i}"
                             for i, c in enumerate(columns)]).first()
    varies = [bool(spread[f"v{i}"]) for i in range(len(columns))]
    rows = [(i, j, a, b, float(matrix[i, j]) if varies[i] and varies[j] else None)
            for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, _SCHEMA)


def pairwise_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lower triangle for tables with gaps: each pair uses the rows where both are present."""
    columns = list(columns)
    measures = {}
    for i, first in enumerate(columns):
        for j, second in enumerate(columns[:i]):
            a, b = text.name(first), text.name(second)
            spread = " * ".join(f"stddev_pop(CASE WHEN {other} IS NOT NULL THEN {own} END)"
                                for own, other in ((a, b), (b, a)))
            measures[f"{i},{j}"] = {"r": text.quotient(f"covar_pop({a}, {b})", spread)}
    names = f"array({', '.join(text.string(c) for c in columns)})"
    return (aggregate_per_column(df, measures)
            .selectExpr("CAST(split(column_name, ',')[0] AS INT) AS row_position",
                        "CAST(split(column_name, ',')[1] AS INT) AS column_position", "r")
            .selectExpr("row_position", "column_position", f"{names}[row_position] AS row_name",
                        f"{names}[column_position] AS column_name", "r"))


def lower_triangle(correlations: DataFrame) -> DataFrame:
    """Pairs strictly below the diagonal."""
    return correlations.filter("row_position > column_position")
