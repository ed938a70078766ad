"""Every registered query against its DuckDB twin."""

import pytest

from gridloom.plans.catalog import ORACLE, QUERIES
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_twin(spark, folder, con, name):
    assert differences(QUERIES[name](spark, folder), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_gives_rows(spark, folder, name):
    assert len(QUERIES[name](spark, folder).collect()) > 0
