"""Every query against its SQL twin."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from acceptance.compare import connect, difference
from acceptance.oracle import all_sql
from acceptance.registry import all_queries

SF = "/root/testdata/sf0.001"
@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, duck, name):
    assert difference(spark, duck, name, all_queries()[name], all_sql()[name], SF) is None


def test_every_query_has_a_twin():
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(queries()) and set(all_sql()) <= set(oracle_sql())


def test_entry_returns_the_open_stages(spark):
    assert [r.display_order for r in entry(spark).collect()] == [1, 2, 3, 4, 5]
