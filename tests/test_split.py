import hashlib
import math

import pytest
from pyspark.sql import functions as F

from matchlens.operators import split


@pytest.fixture(scope="module")
def frame(spark):
    """One class holds most rows."""
    return spark.range(3001).select(
        F.col("id").alias("match_id"),
        F.when(F.col("id") % 10 < 7, 1).when(F.col("id") % 10 < 9, 0).otherwise(2).alias("result"))


def by_class(frame):
    groups = {}
    for row in frame.collect():
        key = str(row["match_id"])
        groups.setdefault(row["result"], []).append(
            (hashlib.md5(key.encode()).hexdigest(), key))
    return {c: [key for _, key in sorted(rows)] for c, rows in groups.items()}


@pytest.mark.parametrize("sort_rows", [1, 20, 10 ** 6])
def test_test_rows_are_the_first_of_each_class(frame, sort_rows):
    marked = split.mark_test_rows(frame, sort_rows=sort_rows)
    quotas = split.test_quotas(split.class_counts(frame, "result"))
    expected = {key for c, keys in by_class(frame).items() for key in keys[:quotas[c]]}
    assert {str(r["match_id"]) for r in marked.filter("is_test").collect()} == expected
    assert marked.count() == 3001 and len(expected) == math.ceil(3001 * 0.2)


@pytest.mark.parametrize("sort_rows", [1, 10 ** 6])
def test_folds_are_consecutive_ranges(frame, sort_rows):
    rows = split.mark_folds(frame, folds=5, sort_rows=sort_rows).collect()
    fold = {str(r["match_id"]): r["fold"] for r in rows}
    sizes = split.fold_sizes(split.class_counts(frame, "result"), 5)
    for c, keys in by_class(frame).items():
        expected = [f for f, n in enumerate(sizes[c]) for _ in range(n)]
        assert [fold[key] for key in keys] == expected


def test_quotas():
    counts = {0: 2791 + 11164, 1: 24797, 2: 16610}
    quotas = split.test_quotas(counts)
    assert sum(quotas.values()) == 11073
    for c, n in counts.items():
        assert abs(quotas[c] - 11073 * n / sum(counts.values())) < 1


@pytest.mark.parametrize("counts", [{0: 7, 1: 11, 2: 5}, {0: 1, 1: 1}, {0: 10, 1: 3, 2: 2}])
def test_fold_sizes_are_even(counts):
    sizes = split.fold_sizes(counts, 5)
    assert all(sum(sizes[c]) == n for c, n in counts.items())
    totals = [sum(sizes[c][f] for c in counts) for f in range(5)]
    assert max(totals) - min(totals) <= 1
    assert all(max(s) - min(s) <= 1 for s in sizes.values())


def test_class_smaller_than_the_folds(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 1)], "match_id bigint, result int")
    rows = split.mark_folds(df, folds=3).collect()
    assert len(rows) == 4 and {r["fold"] for r in rows} <= {0, 1, 2}


def test_hash_split_is_near_the_share(frame):
    share = split.mark_test_rows_by_hash(frame).filter("is_test").count() / 3001
    assert abs(share - 0.2) < 0.03
