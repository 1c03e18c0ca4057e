"""A repeatable pseudo-random row order that any engine can recompute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_text(keys: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in keys])


def key_hash(keys: Sequence[str]) -> Column:
    """md5 of the row key as 32 hex digits: uniform, and independent of partitioning."""
    return F.md5(key_text(keys))
