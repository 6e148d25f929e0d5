"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from queryset import ORACLES, QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    rows, problem = compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert problem is None


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["custkey", "status", "price", "priority", "Diff"]
