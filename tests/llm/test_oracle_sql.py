"""Queries of the subpackage that have oracle SQL, against DuckDB on a whole small table."""

import pytest

from rivulet.llm.catalog import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    frame = QUERIES[name](spark, "/root/testdata/sf0.001")
    want = duck.sql(SQL[name])
    assert frame.columns == want.columns
    assert sorted(map(tuple, frame.collect()), key=str) == sorted(want.fetchall(), key=str)
