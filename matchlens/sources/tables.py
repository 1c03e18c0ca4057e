"""Writing result tables and reading them back."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from matchlens.operators.models import RESULT_SCHEMA

# Result tables by name, with the schema they are read back under.
SCHEMAS = {
    "column_profile": "column_name string, data_type string, non_null_count bigint, "
                      "null_count bigint, null_pct double, distinct_count bigint",
    "missing_report": "column_name string, null_count bigint, null_pct double",
    "iqr_outliers": "column_name string, lower_fence double, upper_fence double, "
                    "outlier_count bigint, outlier_pct double",
    "describe": "column_name string, count double, mean double, std double, min double, "
                "p25 double, p50 double, p75 double, max double",
    "feature_importance": "feature string, anova_f double, rf_importance double, "
                          "anova_norm double, rf_norm double, combined_score double",
    "model_results": RESULT_SCHEMA,
    "accuracy_pivot": "algorithm string, selected_features double, all_features double, "
                      "diff double",
    "class_report": "class_label string, precision double, recall double, f1_score double, "
                    "support double",
}


def save_table(df: DataFrame, folder: str, name: str, kind: str = "csv") -> str:
    """Write a table, replacing an earlier one. Partitions are written in parallel."""
    path = f"{folder}/{name}"
    writer = df.write.mode("overwrite").format(kind)
    (writer.option("header", True) if kind == "csv" else writer).save(path)
    return path


def load_tables(spark: SparkSession, folder: str,
                names: Iterable[str] = tuple(SCHEMAS)) -> dict[str, DataFrame]:
    """The saved CSV result tables by name."""
    return {name: spark.read.schema(SCHEMAS[name]).csv(f"{folder}/{name}", header=True)
            for name in names}
