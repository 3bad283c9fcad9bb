"""Every query of the training-data operators that has SQL, on the smallest tables."""

import os

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_queries_agree_with_sql(agree):
    from corpusloom.llm import queries, sql

    assert not agree(queries.queries(), sql.oracle_sql(), DATA)
