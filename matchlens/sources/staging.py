"""Derived tables written once and read many times.

Profiling and modelling pass over the same frame again and again. Writing it as parquet cuts the
lineage, survives the loss of executors, and keeps column pruning and filter push-down, which a
cached or checkpointed frame does not.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from matchlens import config
from matchlens.operators.preparation import modelling_frame
from matchlens.session import new_shared_path
from matchlens.sources.matches import matches

_written: dict[tuple[str, str, str], str] = {}


def staged(spark: SparkSession, name: str, origin: str,
           build: Callable[[], DataFrame]) -> DataFrame:
    """The table ``name`` derived from ``origin``, written at its first use in this application."""
    key = (spark.sparkContext.applicationId, name, origin)
    if key not in _written:
        path = new_shared_path(spark, name)
        build().write.parquet(path)
        _written[key] = path
    return spark.read.parquet(_written[key])


def staged_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, "matches", sf_dir, lambda: matches(spark, sf_dir))


def staged_modelling_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modelling frame with its row key."""
    return staged(spark, "modelling", sf_dir, lambda: modelling_frame(
        staged_matches(spark, sf_dir), keys=(config.ROW_KEY,)))
