"""Every registered query of the subpackage runs; those with a twin equal it."""

import pytest

from gridloom.llm.catalog import LLM_ORACLE, LLM_QUERIES
from tests.oracle import connect, differences


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_query(spark, folder, name):
    df = LLM_QUERIES[name](spark, folder)
    if name in LLM_ORACLE:
        assert differences(df, connect(folder), LLM_ORACLE[name]) is None
    else:
        assert df.count() > 0
