"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry_points
from conftest import SF_DIR
from oracle import connect, differences
from vulnlake.plans.oracle import SQL
from vulnlake.plans.queries import REGISTRY as QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert rows and sum(r["cve_count"] for r in rows) == 1458
