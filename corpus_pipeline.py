"""Cleans, deduplicates, masks and packs ``documents``.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``.
Results are written as Parquet and read again between stages, so a lost executor costs the tasks
of one stage at most.

In every stage a null text counts as an empty one, which has no near copies and no personal data
and packs to its end mark; null and repeated ids are rows of their own, equal texts are copies of
each other whatever their ids, very long texts are processed as a whole, an empty table gives an
empty result, and other columns are carried along by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchlens.llm import exact, packing, pii, quality, setsketch
from matchlens.llm.columns import stored, table

ORACLE_SQL = None  # the first stage fits a model, the last one packs with a tokenizer


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the greatest id stays."""
    return exact.without_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles link at 0.8 or more, the smallest id stays."""
    return setsketch.without_near_copies(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data; ``n_chars`` follows the text."""
    return pii.redact(docs, length_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece of a document, with its ids."""
    return packing.pack(docs)


STAGES = [("quality", good_documents), ("exact_dedup", without_exact_copies),
          ("near_dedup", without_near_copies), ("pii", without_personal_data), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        frame = stored(stage(spark, frame, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, frame, sf_dir)
