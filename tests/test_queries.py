"""Every registered query with SQL agrees with it; the others return rows."""

import pytest

import compare
import __spark_entry__ as registry

# Several minutes of fits; covered on smaller settings in test_models.py.
SLOW = {"model_comparison", "accuracy_pivot", "best_model"}


@pytest.fixture(scope="module")
def database(sf_dir):
    return compare.connect(sf_dir)


def test_entry(spark):
    rows = registry.entry(spark).collect()
    assert [r["class_code"] for r in rows] == [1, 0, 2]
    assert [r["class_count"] for r in rows] == [617, 475, 408]


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - SLOW))
def test_query(spark, sf_dir, database, name):
    assert compare.difference(spark, database, name, sf_dir) is None
