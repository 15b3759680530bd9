"""Queries with SQL against DuckDB on the smallest tables; entry points."""

import pytest

import __spark_entry__ as entry_point
from llm.queries import QUERIES, SQL
from workloads.check import duck_rows, sorted_rows, views


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    assert sorted_rows(frame.columns, frame.collect()) == duck_rows(views(sf_dir), SQL[name])


def test_all_operators_are_registered():
    names = [name for name in entry_point.queries() if name.startswith("op")]
    assert {int(name[2:].split("_")[0]) for name in names if name[2].isdigit()} == set(range(1, 14))
    assert "pipeline" in entry_point.queries()
