"""Every registered query against its DuckDB twin."""

import pytest

import __spark_entry__ as entry
from cartwheel.plans import oracle, registry
from parity import difference

QUERIES, SQL = registry.queries(), oracle.oracle_sql()


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, folder, duck):
    assert difference(QUERIES[name](spark, folder), duck, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["Category", "OrderCount", "TotalRevenue"]
