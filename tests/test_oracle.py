"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    assert compare(spark, duck, FOLDER, name, queries()[name], oracle_sql().get(name)) is None


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_of_the_workload_has_an_oracle():
    from millrace.workload import all_queries

    assert set(all_queries()) <= set(oracle_sql())
