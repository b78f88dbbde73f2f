"""Every registered query against its DuckDB equivalent."""

from __future__ import annotations

import pytest
from compare import differences, duckdb_over

import __spark_entry__ as entry_points
from wattledger.plans.oracles import ORACLES
from wattledger.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_over(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    assert differences(result, con, entry_points.oracle_sql()[name]) == []


def test_every_query_has_an_oracle():
    assert ORACLES.keys() == QUERIES.keys() <= entry_points.queries().keys()
