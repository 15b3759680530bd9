import pytest

import __spark_entry__ as entry_point
from workloads.catalog import ENTRIES
from workloads.check import differs, views


@pytest.fixture(scope="module")
def tables(sf_dir):
    return views(sf_dir)


@pytest.mark.parametrize("name", [name for name, item in ENTRIES.items() if item.sql is not None])
def test_query_agrees_with_sql(spark, tables, sf_dir, name):
    assert differs(spark, tables, sf_dir, name) is None


def test_entry_points(spark):
    assert entry_point.entry(spark).columns == ["grade", "safe", "risky"]
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
