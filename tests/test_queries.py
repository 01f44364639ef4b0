"""Every registered query of the core library runs on the smallest tables and agrees with its SQL where it has one."""

import pytest

from cartoscope.plans import all_queries, all_sql
from tests import oracle

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connection()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    columns, rows = oracle.rows_of(QUERIES[name](spark, oracle.SF))
    if name in SQL:
        expected_columns, expected = oracle.sql_rows(con, SQL[name])
        assert columns == expected_columns
        assert oracle.same(rows, expected)
    else:
        assert columns
