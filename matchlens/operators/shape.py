"""Turning one wide row of aggregates into one row per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from matchlens.functions import text


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The listed columns that exist; the others are skipped."""
    return [c for c in columns if c in df.columns]


def aggregate_per_column(df: DataFrame,
                         measures: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Evaluate several aggregates for every column in ONE pass, then turn them into rows.

    ``measures[column][measure]`` is an aggregate as SQL text. The aggregation is partial per task
    and only one row is exchanged. Rows come out with ``position`` and ``column_name`` first.
    """
    wide, rows = [], []
    for i, (column, aggregates) in enumerate(measures.items()):
        wide += [f"{sql} AS a{i}_{j}" for j, sql in enumerate(aggregates.values())]
        fields = [f"{i} AS position", f"{text.string(column)} AS column_name",
                  *[f"a{i}_{j} AS {text.name(m)}" for j, m in enumerate(aggregates)]]
        rows.append(f"struct({', '.join(fields)})")
    return df.selectExpr(*wide).selectExpr(f"inline(array({', '.join(rows)}))")
